"""Policy-gradient arithmetic over tokens: ratios, divergences and losses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOSSES = ("grpo", "bnpo", "dr_grpo", "dapo", "cispo")


def tokens(df: DataFrame, *arrays: str) -> DataFrame:
    """One row per token: the other columns, ``t`` from 0, and each array's element."""
    rest = [c for c in df.columns if c not in arrays]
    out = df.select(*rest, F.posexplode(F.arrays_zip(*arrays)).alias("t", "__x"))
    return out.select(*rest, "t", *[F.col("__x")[a].alias(a) for a in arrays])


def k3(new: Column, reference: Column, clamp: float | None = None) -> Column:
    """exp(d) - d - 1 of d = reference - new; ``clamp`` bounds it, and d to twice that."""
    d = reference - new
    if clamp is None:
        return F.exp(d) - d - 1
    d = F.greatest(F.least(d, F.lit(2 * clamp)), F.lit(-2 * clamp))
    return F.greatest(F.least(F.exp(d) - d - 1, F.lit(clamp)), F.lit(-clamp))


def clipped(log_ratio: Column, advantage: Column, low: float = 0.2, high: float = 0.2, kind: str = "grpo") -> Column:
    """Loss of one token: the clipped surrogate, or for ``cispo`` the bounded ratio as a constant weight of the log probability's gradient."""
    ratio = F.exp(log_ratio)
    bounded = F.greatest(F.least(ratio, F.lit(1 + high)), F.lit(1 - low))
    if kind == "cispo":
        return -F.least(ratio, F.lit(1 + high)) * advantage * log_ratio
    return -F.least(ratio * advantage, bounded * advantage)


def loss(df: DataFrame, token_loss: str, mask: str, sequence: str, kind: str = "grpo", max_length: int = 1) -> DataFrame:
    """One row, ``loss``, of token rows: the mean of sequences' means (grpo), the mean of tokens (bnpo, dapo, cispo), or a sum over a constant (dr_grpo)."""
    if kind not in LOSSES:
        raise ValueError(f"unknown loss {kind!r}")
    kept = df.where(F.col(mask) != 0)
    if kind == "grpo":
        return kept.groupBy(sequence).agg(F.avg(token_loss).alias("l")).agg(F.avg("l").alias("loss"))
    if kind == "dr_grpo":
        n = df.agg(F.count_distinct(sequence).alias("n"))
        return kept.agg(F.sum(token_loss).alias("s")).join(F.broadcast(n)).select((F.col("s") / (F.col("n") * max_length)).alias("loss"))
    return kept.agg(F.avg(token_loss).alias("loss"))


def future_sums(values: Column, gamma: float) -> Column:
    """For each element, the sum of itself and the later ones, each weighed by gamma to the power of its distance."""
    def step(acc: Column, v: Column) -> Column:
        return F.concat(F.array(v + F.lit(gamma) * F.coalesce(F.get(acc, F.lit(0)), F.lit(0.0))), acc)

    return F.aggregate(F.reverse(values), F.array().cast("array<double>"), step)


def sequence_kept(df: DataFrame, old: str, new: str, advantage: str, sequence: str, delta: float, order: str) -> DataFrame:
    """Token rows without the sequences that have a negative advantage and whose mean log ratio old - new exceeds ``delta``.

    A sequence's log ratios are added in the order of ``order``. A sum of doubles depends on it, and
    where a mean lies at ``delta`` itself a sequence would else stay in one run and go in the next.
    """
    whole = Window.partitionBy(sequence).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bad = (F.avg(F.col(old) - F.col(new)).over(whole) > delta) & (F.max(advantage).over(whole) < 0)
    # a mean that is null exceeds nothing
    return df.withColumn("_bad", F.coalesce(bad, F.lit(False))).where("not _bad").drop("_bad")


def diagnostics(df: DataFrame, old: str, new: str, mask: str) -> DataFrame:
    """One row over masked-in tokens: KL, its k3 estimate, perplexities of both policies, and chi-square."""
    d = F.col(new) - F.col(old)
    return df.where(F.col(mask) != 0).agg(
        F.avg(-d).alias("kl"), F.avg(F.exp(d) - d - 1).alias("k3_kl"), F.exp(-F.avg(old)).alias("old_ppl"), F.exp(-F.avg(new)).alias("new_ppl"), (F.avg(F.exp(2 * d)) - 1).alias("chi2")
    )


def reweighed(teacher: Column, student: Column, advantage: Column, clip: float, strength: float) -> Column:
    """Token advantages weighed by the clipped teacher-student ratio in the advantage's direction; strength 0 leaves them."""
    def one(t: Column, s: Column) -> Column:
        ratio = F.exp(F.signum(advantage) * (t - s))
        bounded = F.greatest(F.least(ratio, F.lit(1 + clip)), F.lit(1 - clip))
        return advantage * (F.lit(1 - strength) + F.lit(strength) * bounded)

    return F.zip_with(teacher, student, one)


def with_teacher(df: DataFrame, teacher: str, student: str, advantage: str, mask: str, strength: float) -> DataFrame:
    """Token advantages plus ``strength`` times the teacher's log ratio to the student, on the masked-in tokens."""
    gap = F.when(F.col(mask) != 0, F.col(teacher) - F.col(student)).otherwise(0.0)
    return df.withColumn(advantage, F.col(advantage) + F.lit(strength) * gap)


def masked_k3(new: Column, reference: Column, mask: Column, clamp: float | None = None) -> Column:
    """``k3`` of masked-in tokens, 0 of others: the mask comes before the exponential, which padding could overflow."""
    return F.when(mask != 0, k3(new, reference, clamp)).otherwise(0.0)


def influence(log_ratios: Column, advantages: Column, gamma: float, clip: float, dual: float = 10.0) -> Column:
    """Weights of a sequence's tokens by what they lead to: exp of the discounted sum of later log ratios, kept within 1 - clip and 1 + clip.

    Tokens whose ratio exceeds ``dual`` at a negative advantage are left out of the sums. The sums come from
    running ones from the end, so the work is linear in the length.
    """
    kept = F.zip_with(log_ratios, advantages, lambda x, a: F.when((a < 0) & (F.exp(x) > dual), F.lit(0.0)).otherwise(x))
    return F.transform(future_sums(kept, gamma), lambda s: F.greatest(F.least(F.exp(s), F.lit(1 + clip)), F.lit(1 - clip)))
