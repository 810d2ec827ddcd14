"""Sampling and inference as table work: requests, cached answers, rollouts and what is read from their results."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from parley.functions import messages as M


def row_key(columns: list[str], left_out: tuple[str, ...] = ("choices",)) -> Column:
    """md5 of a row's columns in the order of their names, without its answers; nulls count."""
    return F.md5(F.to_json(F.struct(*sorted(c for c in columns if c not in left_out)), {"ignoreNullFields": "false"}).cast("binary"))


def cached(answers: DataFrame, key: str, answer: str, order: str) -> DataFrame:
    """The answers of each key in order as ``choices``."""
    held = F.transform(F.sort_array(F.collect_list(F.struct(order, answer))), lambda x: x[answer])
    return answers.groupBy(key).agg(held.alias("choices"))


def reused(requests: DataFrame, cache: DataFrame, key: str, n: int) -> tuple[DataFrame, DataFrame]:
    """Requests with their cached choices, where there are just ``n``, and the others, which must be asked."""
    whole = cache.where(F.size("choices") == n)
    return requests.join(whole, key), requests.join(whole, key, "left_anti")


def expanded(df: DataFrame, n: int, system: str | None = None, messages: str = "messages") -> DataFrame:
    """``n`` requests of each row, numbered by ``choice`` from 0: a final answer goes, and a system prompt replaces what there is."""
    asked = M.without_response(F.col(messages))
    if system is not None:
        asked = F.concat(F.array(M.message(F.lit("system"), F.lit(system))), F.filter(asked, lambda m: m["role"] != "system"))
    return df.withColumn(messages, asked).withColumn("choice", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def distilled(thinking: Column, answer: Column) -> Column:
    """Thinking and answer between their marks; an answer alone stays as it is."""
    both = F.concat(F.lit("<think>"), thinking, F.lit("</think>\n\n<answer>"), answer, F.lit("</answer>"))
    return F.when(F.coalesce(thinking, F.lit("")) == "", answer).otherwise(both)


def answered(df: DataFrame, request: str, infer: Callable[[list[str]], list[str]], batch: int = 64, name: str = "response") -> DataFrame:
    """``name`` by a user's function from a list of requests to one of answers; ``batch`` at a time, in Arrow batches of the tasks.

    The function is sent to the executors; one that gives other than one answer for each request raises.
    """
    schema = StructType([*df.schema.fields, StructField(name, StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                found = list(infer(part[request].tolist()))
                if len(found) != len(part):
                    raise ValueError(f"{len(found)} answers for {len(part)} requests")
                yield part.assign(**{name: found})

    return df.mapInPandas(run, schema)


def scored_results(results: DataFrame, response: str, label: str) -> DataFrame:
    """One row of a results table: exact matches, and rows."""
    return results.agg(F.avg((F.col(response) == F.col(label)).cast("double")).alias("acc"), F.count("*").alias("n"))


def candidates_with_truth(df: DataFrame, group: str, answer: str, truth: str, order: str) -> DataFrame:
    """Candidates of each group and its ground truth as one more, which comes last."""
    own = df.select(group, F.col(answer).alias("answer"), F.col(order).cast("long").alias("at"), F.lit(False).alias("is_truth"))
    known = df.groupBy(group).agg(F.max(truth).alias("answer")).where("answer is not null")
    return own.unionByName(known.select(group, "answer", F.lit(2**62).alias("at"), F.lit(True).alias("is_truth")))


def hard_groups(df: DataFrame, group: str, outcome: str, n: int, easy: float) -> DataFrame:
    """Rows of the groups that are not too easy: of ``n`` candidates and the truth fewer than that share of ``n`` are right besides the truth."""
    right = df.groupBy(group).agg(F.sum((F.col(outcome) > 0).cast("long")).alias("_right")).where(F.col("_right") - 1 < int(n * easy))
    return df.join(right.select(group), group, "left_semi")


def finished(turns: DataFrame, session: str, turn: str, reason: str, max_turns: int) -> DataFrame:
    """Rows of each session up to the turn that ends it: the first cut for its length, or the ``max_turns``-th."""
    w = Window.partitionBy(session).orderBy(turn)
    before = F.coalesce(F.max((F.col(reason) == "length").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return turns.withColumn("_n", F.row_number().over(w)).withColumn("_cut", before).where((F.col("_n") <= max_turns) & (F.col("_cut") == 0)).drop("_n", "_cut")


def rollouts(turns: DataFrame, session: str, turn: str, ids: str, mask: str, logprobs: str) -> DataFrame:
    """The token ids, masks and log probabilities of each session's turns in order, and their number; log probabilities of which any turn lacks some are left out."""
    held = F.sort_array(F.collect_list(F.struct(turn, ids, mask, logprobs)))
    rows = turns.groupBy(session).agg(held.alias("_t"))
    whole = F.forall("_t", lambda t: F.coalesce(F.size(t[logprobs]) == F.size(t[ids]), F.lit(False)))
    joined = lambda c: F.flatten(F.transform("_t", lambda t: t[c]))
    return rows.select(session, F.size("_t").alias("turns"), joined(ids).alias(ids), joined(mask).alias(mask), F.when(whole, joined(logprobs)).alias(logprobs))


def before_marks(text: Column, marks: tuple[str, ...] = ("<answer>", "</think>")) -> Column:
    """The text up to the first of the marks; without any, all of it."""
    places = F.array(*[F.instr(text, m) for m in marks])
    first = F.array_min(F.filter(places, lambda p: p > 0))
    return F.when(first.isNull(), text).otherwise(F.substring(text, F.lit(1), first - 1))


def top_logprobs(entries: Column, n: int) -> Column:
    """The ``n`` most probable of (token, logprob) entries, most probable first; ties by token."""
    ordered = F.array_sort(F.transform(entries, lambda e: F.struct((-e["logprob"]).alias("x"), e["token"].alias("token"))))
    return F.transform(F.slice(ordered, 1, n), lambda e: F.struct(e["token"].alias("token"), (-e["x"]).alias("logprob")))


def finish_reason(n_tokens: Column, max_tokens: Column, ended: Column) -> Column:
    """'length' where the limit was reached, 'stop' where the text has ended, else null."""
    return F.when(n_tokens >= max_tokens, "length").when(ended, "stop")


def clamped_tokens(asked: Column, prompt: Column, limit: int) -> Column:
    """Tokens that may be made: what is asked for, at most what the model's length leaves, which is all where nothing is asked for."""
    return F.least(F.coalesce(asked, F.lit(limit) - prompt), F.lit(limit) - prompt)


def candidate_scores(df: DataFrame, group: str, reward: str, threshold: float, name: str = "score") -> DataFrame:
    """``name`` and ``mask`` of candidates: a list of rewards counts by its least; the mask tells whether that exceeds the threshold.

    Scores are scaled within the group, (x - min) / (max - min + 1e-5); equal ones give min(1, x), and 0 if they are 0.
    """
    from parley.operators.advantages import scaled_scores

    least = F.array_min(reward) if df.schema[reward].dataType.typeName() == "array" else F.col(reward)
    rows = df.withColumn(name, least.cast("double")).withColumn("mask", F.col(name) > threshold)
    return rows.withColumn(name, scaled_scores(name, group))
