"""Losses, masks and diagnostics over rows of tokens, pairs and ranked candidates, as aggregates.

Token rows hold a sequence, a 0/1 ``mask`` and what a function names; sums are partial on the map side,
and only per-sequence, per-group or one-row results are joined back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parley.operators import advantages


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def softplus(x: Column) -> Column:
    """log(1 + exp(x)) without overflow."""
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


# --- advantages ------------------------------------------------------------------------------


def dynamic_advantage(df: DataFrame, reward: str, prompt: str, request: str, order: str, baseline: str = "mean", scale: str = "group", name: str = "advantage") -> DataFrame:
    """Advantages where a request may have several rows: its last row by ``order`` counts once in its prompt's group, and all its rows get its value.

    ``scale`` divides by the sample deviation of rewards in the ``group`` or the whole ``batch``, or of
    the centred values for the baseline ``reinforce_plus_plus``; ``none`` does not.
    """
    last = df.groupBy(request).agg(F.max(F.struct(order, prompt, reward)).alias("x")).select(request, F.col(f"x.{prompt}").alias(prompt), F.col(f"x.{reward}").alias(reward))
    own = "rloo" if baseline == "rloo" else "mean"
    centred = last.withColumn(name, advantages.advantage(reward, prompt, own, "none"))
    of = name if baseline == "reinforce_plus_plus" else reward
    if scale == "group":
        spread = F.coalesce(F.stddev_samp(of).over(Window.partitionBy(prompt)), F.lit(0.0))
        centred = centred.withColumn(name, F.col(name) / (spread + F.lit(advantages.EPSILON)))
    elif scale == "batch":
        whole = centred.agg(F.coalesce(F.stddev_samp(of), F.lit(0.0)).alias("_std"))  # one row
        centred = centred.join(F.broadcast(whole)).withColumn(name, F.col(name) / (F.col("_std") + F.lit(advantages.EPSILON)))
    elif scale != "none":
        raise ValueError(f"unknown scale {scale!r}")
    return df.join(centred.select(request, name), request)


def rank_share(df: DataFrame, number: str, rank: int, size: int) -> DataFrame:
    """The ``size`` consecutive rows of a rank."""
    return df.where((F.col(number) >= rank * size) & (F.col(number) < (rank + 1) * size))


# --- token weights and masks -----------------------------------------------------------------


def with_importance(df: DataFrame, new: str, old: str, sequence: str, mask: str = "mask", level: str = "token", name: str = "log_ratio") -> DataFrame:
    """The log ratio of both policies: of each token, or for ``sequence`` the mean over the sequence's masked-in tokens."""
    ratio = F.col(new) - F.col(old)
    if level == "token":
        return df.withColumn(name, ratio)
    if level not in ("sequence", "sequence_token"):
        raise ValueError(f"unknown level {level!r}")
    means = df.where(F.col(mask) != 0).groupBy(sequence).agg(F.avg(ratio).alias(name))
    return df.join(means, sequence, "left").withColumn(name, F.coalesce(name, F.lit(0.0)))


def soft_gate(log_ratio: Column, advantage: Column, tau_up: float = 1.0, tau_down: float = 1.05) -> Column:
    """Loss of one token with a smooth gate in place of the clip; its sharpness depends on the advantage's sign."""
    gate = lambda tau: sigmoid(F.lit(tau) * (F.exp(log_ratio) - 1)) * F.lit(4.0 / tau)
    return -F.when(advantage > 0, gate(tau_up)).otherwise(gate(tau_down)) * advantage


def contrast_loss(df: DataFrame, new: str, old: str, advantage: str, sequence: str, group: str, mask: str = "mask", tau: float = 0.5) -> DataFrame:
    """One row, ``loss``: sequences' mean log ratios, pushed up where the advantage is positive and down elsewhere.

    Of each group with both kinds log(1 + sum exp(s / tau)) of the bad and log(1 + sum exp(-s / tau)) of
    the good; the sum over all groups' number, and 0 without such a group.
    """
    kept = df.where(F.col(mask) != 0).groupBy(group, sequence).agg((F.avg(F.col(new) - F.col(old)) / F.lit(tau)).alias("s"), F.avg(advantage).alias("a"))
    good = F.col("a") > 0
    sums = kept.groupBy(group).agg(
        F.sum(F.when(~good, F.exp("s"))).alias("down"), F.sum(F.when(good, F.exp(-F.col("s")))).alias("up")
    )
    both = F.when(F.col("down").isNotNull() & F.col("up").isNotNull(), F.log1p("down") + F.log1p("up")).otherwise(0.0)
    return sums.agg(F.coalesce(F.sum(both) / F.count("*"), F.lit(0.0)).alias("loss"))


def top_entropy(df: DataFrame, entropy: str, share: float, mask: str = "mask", name: str = "kept") -> DataFrame:
    """``name``: whether a token's entropy reaches the quantile above which ``share`` of the masked-in tokens lie; the threshold is one row."""
    threshold = df.where(F.col(mask) != 0).agg(F.percentile(entropy, F.lit(1 - share)).alias("_at"))
    return df.join(F.broadcast(threshold)).withColumn(name, (F.col(mask) != 0) & (F.col(entropy) >= F.col("_at"))).drop("_at")


def entropy_logs(df: DataFrame, entropy: str, sequence: str, mask: str = "mask") -> DataFrame:
    """One row: mean, greatest and least of the sequences' mean entropies."""
    means = df.where(F.col(mask) != 0).groupBy(sequence).agg(F.avg(entropy).alias("m"))
    return means.agg(F.avg("m").alias("entropy_mean"), F.max("m").alias("entropy_max"), F.min("m").alias("entropy_min"))


def without_overlong(df: DataFrame, reason: str, mask: str = "mask") -> DataFrame:
    """The mask is 0 for all of a completion that was cut for its length."""
    return df.withColumn(mask, F.when(F.col(reason) == "length", F.lit(0)).otherwise(F.col(mask)))


def clip_ratios(df: DataFrame, log_ratio: str, advantage: str, mask: str = "mask", low: float = 0.2, high: float = 0.2) -> DataFrame:
    """One row: shares of masked-in tokens whose ratio is clipped from below, from above, and either."""
    ratio, a = F.exp(log_ratio), F.col(advantage)
    down, up = (ratio < 1 - low) & (a < 0), (ratio > 1 + high) & (a > 0)
    share = lambda c: F.avg(c.cast("double"))
    return df.where(F.col(mask) != 0).agg(share(down).alias("low"), share(up).alias("high"), share(down | up).alias("region"))


def correction_metrics(df: DataFrame, log_ratio: str, mask: str = "mask", cap: float = 2.0) -> DataFrame:
    """One row on importance weights truncated at ``cap``: mean, deviation, least and greatest, the share that is truncated, and the effective sample's share."""
    weight = F.least(F.exp(log_ratio), F.lit(cap))
    ess = F.pow(F.sum(weight), F.lit(2)) / F.sum(weight * weight) / F.count("*")
    return df.where(F.col(mask) != 0).agg(
        F.avg(weight).alias("mean"), F.stddev_pop(weight).alias("std"), F.min(weight).alias("min"), F.max(weight).alias("max"),
        F.avg((F.exp(log_ratio) > cap).cast("double")).alias("truncated"), ess.alias("ess"),
    )


MODES = ("token-mean", "seq-mean-token-sum", "seq-mean-token-mean")


def gated_distillation(df: DataFrame, teacher: str, student: str, sequence: str, mask: str = "mask", beta: float = 5.0, mode: str = "token-mean") -> DataFrame:
    """One row: the teacher-student gap, gated by its own sigmoid, as ``loss``, with the gate's mean, the share of open gates and the mean gap."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    gap = F.col(teacher) - F.col(student)
    gate = sigmoid(F.lit(beta) * gap)
    on = F.col(mask) != 0
    rows = df.select(sequence, on.alias("on"), gap.alias("gap"), gate.alias("gate"), (gate * gap).alias("l"))
    parts = rows.groupBy(sequence).agg(
        F.sum(F.when(F.col("on"), F.col("l")).otherwise(0.0)).alias("l"), F.sum(F.col("on").cast("long")).alias("n"),
        F.sum(F.when(F.col("on"), F.col("gate")).otherwise(0.0)).alias("gate"), F.sum(F.when(F.col("on"), F.col("gap")).otherwise(0.0)).alias("gap"),
        F.sum((F.col("on") & (F.col("gate") > 0.5)).cast("long")).alias("open"),
    )
    n = F.greatest(F.sum("n"), F.lit(1))
    loss = {"token-mean": F.sum("l") / n, "seq-mean-token-sum": F.avg("l"), "seq-mean-token-mean": F.avg(F.col("l") / F.greatest("n", F.lit(1)))}[mode]
    return parts.agg(loss.alias("loss"), (F.sum("gate") / n).alias("gate_mean"), (F.sum("open") / n).alias("gate_active"), (F.sum("gap") / n).alias("gap_mean"))


def channel_loss(df: DataFrame, loss: str, channel: str, mask: str = "mask") -> DataFrame:
    """Mean loss of the masked-in tokens of each channel, and their number."""
    return df.where(F.col(mask) != 0).groupBy(channel).agg(F.avg(loss).alias("loss"), F.count("*").alias("n"))


# --- pairs and ranked candidates -------------------------------------------------------------


def cosine_loss(df: DataFrame, similarity: str, label: str) -> DataFrame:
    """One row: the mean squared difference of similarities and labels."""
    return df.agg(F.avg(F.pow(F.col(similarity) - F.col(label), F.lit(2))).alias("loss"))


def contrastive_loss(df: DataFrame, similarity: str, label: str, margin: float = 0.5) -> DataFrame:
    """One row: like pairs by their squared distance, unlike ones by what they lack of the margin, halved and averaged."""
    d = 1 - F.col(similarity)
    return df.agg(F.avg(0.5 * F.when(F.col(label) == 1, d * d).otherwise(F.pow(F.greatest(F.lit(margin) - d, F.lit(0.0)), F.lit(2)))).alias("loss"))


def online_contrastive_loss(df: DataFrame, similarity: str, label: str, margin: float = 0.5) -> DataFrame:
    """One row: the same sums over hard pairs only: unlike pairs nearer than the farthest like one, like ones farther than the nearest unlike one.

    With at most one pair of the other kind, the bound is the own kind's mean.
    """
    rows = df.select((1 - F.col(similarity)).alias("d"), (F.col(label) == 1).alias("like"))
    like, unlike = F.when(F.col("like"), F.col("d")), F.when(~F.col("like"), F.col("d"))
    near = F.when(F.count(like) > 1, F.max(like)).otherwise(F.avg(unlike))
    far = F.when(F.count(unlike) > 1, F.min(unlike)).otherwise(F.avg(like))
    bounds = rows.agg(near.alias("near"), far.alias("far"))  # one row
    hard = rows.join(F.broadcast(bounds))
    good = F.sum(F.when(F.col("like") & (F.col("d") > F.col("far")), F.col("d") * F.col("d")).otherwise(0.0))
    bad = F.sum(F.when(~F.col("like") & (F.col("d") < F.col("near")), F.pow(F.greatest(F.lit(margin) - F.col("d"), F.lit(0.0)), F.lit(2))).otherwise(0.0))
    return hard.agg((good + bad).alias("loss"))


def infonce(scores: DataFrame, query: str, kind: str, score: str, temperature: float = 0.1, margin: float | None = None) -> DataFrame:
    """One row: mean cross entropy of each query's positive among its candidates.

    ``scores`` has a row per query and candidate; ``kind`` is ``positive`` once per query, else ``document``,
    ``query`` or ``pair`` (of two documents). With a ``margin``, documents and queries that score above the
    positive by more than it are taken for unmarked positives and left out; pairs never are.
    """
    best = scores.where(F.col(kind) == "positive").groupBy(query).agg(F.max(score).alias("_positive"))
    rows = scores.join(best, query)
    if margin is not None:
        rows = rows.where(F.col(kind).isin("positive", "pair") | (F.col(score) <= F.col("_positive") + F.lit(margin)))
    s, top = F.col(score) / F.lit(temperature), F.col("_top")
    tops = rows.groupBy(query).agg((F.max(score) / F.lit(temperature)).alias("_top"))
    each = rows.join(tops, query).groupBy(query).agg((F.max("_top") + F.log(F.sum(F.exp(s - top))) - F.max("_positive") / F.lit(temperature)).alias("l"))
    return each.agg(F.avg("l").alias("loss"))


def pointwise_loss(df: DataFrame, logit: str, label: str) -> DataFrame:
    """One row: mean binary cross entropy of logits."""
    return df.agg(F.avg(softplus(F.col(logit)) - F.col(logit) * F.col(label)).alias("loss"))


def listwise_loss(df: DataFrame, logit: str, label: str, group: str, temperature: float = 1.0, least: int = 2) -> DataFrame:
    """One row: mean cross entropy of the positive in each group of at least ``least`` rows; 0 without any."""
    s = F.col(logit) / F.lit(temperature)
    tops = df.groupBy(group).agg(F.max(s).alias("_top"), F.count("*").alias("_n"), F.sum(F.when(F.col(label) == 1, s)).alias("_own")).where((F.col("_n") >= least) & F.col("_own").isNotNull())
    each = df.join(tops, group).groupBy(group).agg((F.max("_top") + F.log(F.sum(F.exp(s - F.col("_top")))) - F.max("_own")).alias("l"))
    return each.agg(F.coalesce(F.avg("l"), F.lit(0.0)).alias("loss"))


#: Losses of pairs and candidates by name; more can be registered.
LOSSES: dict[str, Callable] = {
    "cosine": cosine_loss, "contrastive": contrastive_loss, "online_contrastive": online_contrastive_loss, "infonce": infonce,
    "pointwise_reranker": pointwise_loss, "listwise_reranker": listwise_loss,
}


def inference_stats(requests: DataFrame, request: str, order: str, prompt_tokens: str, generated_tokens: str, seconds: float) -> DataFrame:
    """One row: totals over requests, of each of which the last row counts, and rates over the time that all took."""
    last = requests.groupBy(request).agg(F.max(F.struct(order, prompt_tokens, generated_tokens)).alias("x"))
    n, p, g = F.count("*"), F.sum(f"x.{prompt_tokens}"), F.sum(f"x.{generated_tokens}")
    return last.agg(n.alias("num_samples"), p.alias("num_prompt_tokens"), g.alias("num_generated_tokens"), (n / F.lit(seconds)).alias("samples_s"), (g / F.lit(seconds)).alias("tokens_s"))


def infonce_metrics(scores: DataFrame, query: str, kind: str, score: str) -> DataFrame:
    """One row: mean of the positives' scores, of all other documents' scores, and of the positive less the highest of the others.

    ``kind`` is as in ``infonce``; scores of queries and pairs don't count. A query without others has no margin.
    """
    rows = scores.where(F.col(kind).isin("positive", "document"))
    positive, other = F.when(F.col(kind) == "positive", F.col(score)), F.when(F.col(kind) == "document", F.col(score))
    each = rows.groupBy(query).agg(F.max(positive).alias("p"), F.sum(other).alias("s"), F.count(other).alias("n"), F.max(other).alias("h"))
    return each.agg(F.avg("p").alias("mean_pos"), (F.sum("s") / F.sum("n")).alias("mean_neg"), F.avg(F.col("p") - F.col("h")).alias("margin"))
