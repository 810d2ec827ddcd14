"""Metrics: vectors, rankings, correlations, streaks and text overlap."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _fold(a: Column, b: Column, one: Callable[[Column, Column], Column]) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: one(x.cast("double"), y.cast("double"))), F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    """Inner product in doubles."""
    return _fold(a, b, lambda x, y: x * y)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null if a length is 0."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def manhattan(a: Column, b: Column) -> Column:
    """Sum of the components' distances."""
    return _fold(a, b, lambda x, y: F.abs(x - y))


def euclidean(a: Column, b: Column) -> Column:
    """Length of the difference."""
    return F.sqrt(_fold(a, b, lambda x, y: (x - y) * (x - y)))


def stats(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Mean, population deviation, extremes and count."""
    return df.groupBy(*by).agg(
        F.round(F.avg(value), 6).alias("mean"), F.round(F.stddev_pop(value), 6).alias("std"), F.min(value).alias("low"), F.max(value).alias("high"), F.count(value).alias("n")
    )


def ranking(df: DataFrame, group: str, score: str, relevance: str, key: str) -> DataFrame:
    """One row: mean reciprocal rank and NDCG over the groups of two or more rows with a relevant one; ties go to the smaller key."""
    w = Window.partitionBy(group)
    ranked = df.withColumn("rk", F.row_number().over(w.orderBy(F.desc(score), key))).withColumn("ideal", F.row_number().over(w.orderBy(F.desc(relevance), F.desc(score), key)))
    gain = lambda at: F.sum((F.pow(F.lit(2.0), relevance) - 1) / F.log2(F.col(at) + 1))
    groups = ranked.groupBy(group).agg(
        F.max(F.when(F.col(relevance) > 0, 1.0 / F.col("rk"))).alias("mrr"), gain("rk").alias("dcg"), gain("ideal").alias("idcg"), F.count("*").alias("n")
    )
    return groups.where("n > 1 and idcg > 0").agg(F.round(F.avg("mrr"), 8).alias("mrr"), F.round(F.avg(F.col("dcg") / F.col("idcg")), 8).alias("ndcg"), F.count("*").alias("n_groups"))


def average_ranks(df: DataFrame, value: str, name: str) -> DataFrame:
    """Ranks from 1, equal values sharing their mean rank. Values are counted first, so that the running sum goes over range partitions' distinct values."""
    from parley.operators.algebra import numbered

    counts = df.groupBy(value).agg(F.count("*").alias("__c"))
    parts = numbered(counts, [value], "__rn").withColumn("__p", F.floor(F.col("__rn") / 65536))
    inside = F.sum("__c").over(Window.partitionBy("__p").orderBy("__rn").rowsBetween(Window.unboundedPreceding, 0))
    parts = parts.withColumn("__upto", inside)
    sums = parts.groupBy("__p").agg(F.sum("__c").alias("__s"))
    # a row per 65536 distinct values
    offsets = sums.select(F.col("__p").alias("__q"), F.coalesce(F.sum("__s").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__o"))
    ranks = parts.join(F.broadcast(offsets), F.col("__p") == F.col("__q")).select(F.col(value).alias("__v"), (F.col("__o") + F.col("__upto") - (F.col("__c") - 1) / 2).alias(name))
    return df.join(ranks, df[value] == ranks["__v"]).drop("__v")


def correlations(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: Pearson's and Spearman's correlation of two columns."""
    ranked = average_ranks(average_ranks(df, a, "__ra"), b, "__rb")
    return ranked.agg(F.round(F.corr(a, b), 6).alias("pearson"), F.round(F.corr("__ra", "__rb"), 6).alias("spearman"))


def contrastive_loss(sims: DataFrame, group: str, score: str, positive: Column) -> DataFrame:
    """InfoNCE loss of each group with one positive: log of the sum of exponentials, less the positive's score."""
    top = F.max(F.when(positive, F.col(score)))
    high = F.max(score)
    groups = sims.groupBy(group).agg(F.collect_list(score).alias("all"), high.alias("high"), top.alias("pos"))
    total = F.aggregate("all", F.lit(0.0), lambda acc, s: acc + F.exp(s - F.col("high")))
    return groups.where("pos is not null").select(group, F.round(F.col("high") + F.ln(total) - F.col("pos"), 6).alias("loss"))


def streaks(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """``longest`` run of rows of a key since its value last improved on all before."""
    w = Window.partitionBy(key).orderBy(*order)
    best = F.max(value).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = df.withColumn("__new", F.when(best.isNull() | (F.col(value) > best), 1).otherwise(0)).withColumn("__island", F.sum("__new").over(w))
    runs = rows.groupBy(key, "__island").agg((F.count("*") - 1).alias("__n"))
    return runs.groupBy(key).agg(F.max("__n").alias("longest"))


def smoothed(values: Column, factor: float) -> Column:
    """Running exponential mean, normalised for its start."""
    start = F.struct(F.array().cast("array<double>").alias("out"), F.lit(0.0).alias("x"), F.lit(0.0).alias("n"))

    def step(acc: Column, v: Column) -> Column:
        x, n = acc["x"] * factor + v, acc["n"] * factor + 1.0
        return F.struct(F.concat(acc["out"], F.array(x / n)).alias("out"), x.alias("x"), n.alias("n"))

    return F.aggregate(values, start, step)["out"]


def shifted_hits(predictions: Column, labels: Column, counted: Callable[[Column], Column]) -> Column:
    """1 or 0 for each counted label but the first: whether the prediction one place earlier is it."""
    pairs = F.zip_with(F.slice(predictions, F.lit(1), F.greatest(F.size(predictions) - 1, F.lit(0))), F.slice(labels, F.lit(2), F.greatest(F.size(labels) - 1, F.lit(0))), lambda p, y: F.struct(p.alias("p"), y.alias("y")))
    return F.transform(F.filter(pairs, lambda x: counted(x["y"])), lambda x: (x["p"] == x["y"]).cast("int"))


def share(hits: Column) -> Column:
    """Mean of an array of numbers; null if it is empty."""
    return F.when(F.size(hits) > 0, F.aggregate(hits, F.lit(0.0), lambda acc, x: acc + x) / F.size(hits))


def words_of(text: str) -> list[str]:
    """Words of a text: what blanks part, and each ideograph and kana on its own, since they are written without blanks."""
    return re.findall(r"[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]|[^\s\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]+", text)


def common_length(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, a row of the table at a time as the bits of one number."""
    places: dict[str, int] = {}
    for i, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(b)) - 1
    open_ = full
    for x in a:
        hit = open_ & places.get(x, 0)
        open_ = ((open_ + hit) | (open_ - hit)) & full
    return len(b) - open_.bit_count()


def overlap(hypothesis: list[str], reference: list[str]) -> tuple[float, float, float, float]:
    """ROUGE-1, ROUGE-2 and ROUGE-L (F values) and smoothed BLEU-4 of two lists of words, from 0 to 1."""
    import math
    from collections import Counter

    def grams(words: list[str], n: int) -> Counter:
        return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))

    def f_value(hits: float, found: float, wanted: float) -> float:
        p, r = hits / found if found else 0.0, hits / wanted if wanted else 0.0
        return 2 * p * r / (p + r) if p + r else 0.0

    rouge = []
    for n in (1, 2):
        a, b = set(grams(hypothesis, n)), set(grams(reference, n))
        rouge.append(f_value(len(a & b), len(a), len(b)))
    rouge.append(f_value(common_length(hypothesis, reference), len(hypothesis), len(reference)))
    logs, missing = 0.0, 1
    for n in range(1, 5):
        a, b = grams(hypothesis, n), grams(reference, n)
        hits, total = sum(min(c, b[g]) for g, c in a.items()), max(1, sum(a.values()))
        if n == 1 and not hits:
            return rouge[0], rouge[1], rouge[2], 0.0
        if not hits:
            hits = 1 / 2**missing
            missing += 1
        logs += math.log(hits / total) / 4
    brevity = 1.0 if len(hypothesis) > len(reference) else math.exp(1 - len(reference) / len(hypothesis))
    return rouge[0], rouge[1], rouge[2], brevity * math.exp(logs)


def text_overlap(df: DataFrame, key: str, hypothesis: str, reference: str) -> DataFrame:
    """``rouge_1, rouge_2, rouge_l, bleu_4`` in percent of each row; an empty hypothesis scores 0, rows with an empty reference are left out."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for k, h, r in zip(pdf[key], pdf[hypothesis], pdf[reference], strict=True):
                h, r = words_of(h or ""), words_of(r or "")
                if r:
                    rows.append((k, *(round(100 * x, 6) for x in (overlap(h, r) if h else (0.0,) * 4))))
            yield pd.DataFrame(rows, columns=[key, "rouge_1", "rouge_2", "rouge_l", "bleu_4"])

    kind = dict(df.dtypes)[key]
    return df.select(key, hypothesis, reference).mapInPandas(run, f"{key} {kind}, rouge_1 double, rouge_2 double, rouge_l double, bleu_4 double")


#: Metrics of a table's columns by name, as aggregates; more can be registered.
METRICS: dict[str, Callable[..., Column]] = {
    "acc": lambda predicted, label: F.avg((F.col(predicted) == F.col(label)).cast("double")),
    "mean": lambda value: F.avg(value),
    "std": lambda value: F.stddev_pop(value),
    "nan_std": lambda value: F.coalesce(F.stddev_samp(value), F.lit(float("nan"))),
    "pearson": lambda a, b: F.corr(a, b),
}
