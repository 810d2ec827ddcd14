"""Group-relative advantages of scored completions, as windows over the prompt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

EPSILON = 1e-4


def total_reward(rewards: dict[str, float], kl: str | None = None, beta: float = 0.0) -> Column:
    """Weighted sum of reward columns, where null counts as none, less ``beta`` times ``kl``."""
    out = sum((F.coalesce(F.col(c), F.lit(0.0)) * F.lit(float(w)) for c, w in rewards.items()), F.lit(0.0))
    return out - F.lit(beta) * F.col(kl) if kl else out


def advantage(reward: str, group: str, baseline: str = "mean", scale: str = "group") -> Column:
    """A row's reward against its group's.

    ``baseline`` is ``mean``, or ``rloo``, the mean of the others (a lone row is centred). ``scale``
    divides by the sample deviation plus EPSILON of rewards in the ``group``, or not at all (``none``);
    a lone row has deviation 0.
    """
    w = Window.partitionBy(group)
    n, mean = F.count(reward).over(w), F.avg(reward).over(w)
    centred = F.col(reward) - mean
    out = F.when(n > 1, centred * n / (n - 1)).otherwise(centred) if baseline == "rloo" else centred
    if scale == "none":
        return out
    return out / (F.coalesce(F.stddev_samp(reward).over(w), F.lit(0.0)) + F.lit(EPSILON))


def batch_scaled(df: DataFrame, reward: str, group: str, name: str = "advantage") -> DataFrame:
    """Centred by group, scaled by the deviation of all rewards, which is one broadcast row."""
    spread = df.agg(F.coalesce(F.stddev_samp(reward), F.lit(0.0)).alias("__std"))
    centred = df.withColumn(name, F.col(reward) - F.avg(reward).over(Window.partitionBy(group)))
    return centred.join(F.broadcast(spread)).withColumn(name, F.col(name) / (F.col("__std") + F.lit(EPSILON))).drop("__std")


def reinforce_plus_plus(df: DataFrame, reward: str, group: str, name: str = "advantage") -> DataFrame:
    """Centred by group, scaled by the deviation of all centred values."""
    centred = df.withColumn(name, F.col(reward) - F.avg(reward).over(Window.partitionBy(group)))
    spread = centred.agg(F.coalesce(F.stddev_samp(name), F.lit(0.0)).alias("__std"))
    return centred.join(F.broadcast(spread)).withColumn(name, F.col(name) / (F.col("__std") + F.lit(EPSILON))).drop("__std")


def decoupled(df: DataFrame, rewards: dict[str, float], group: str, name: str = "advantage") -> DataFrame:
    """Each reward normalised in its group on its own, summed by weight, then whitened over all rows."""
    w = Window.partitionBy(group)
    parts = [
        F.coalesce((F.col(c) - F.avg(c).over(w)) / (F.coalesce(F.stddev_samp(c).over(w), F.lit(0.0)) + F.lit(1e-8)), F.lit(0.0)) * F.lit(float(weight))
        for c, weight in rewards.items()
    ]
    summed = df.withColumn(name, sum(parts, F.lit(0.0)))
    whole = summed.agg(F.avg(name).alias("__mean"), F.coalesce(F.stddev_samp(name), F.lit(0.0)).alias("__std"))
    white = (F.col(name) - F.col("__mean")) / (F.col("__std") + F.lit(1e-8))
    return summed.join(F.broadcast(whole)).withColumn(name, white).drop("__mean", "__std")


def informative(df: DataFrame, reward: str, group: str) -> DataFrame:
    """Rows of the groups whose rewards differ."""
    groups = df.groupBy(group).agg(F.min(reward).alias("__low"), F.max(reward).alias("__high")).where("__low < __high").select(group)
    return df.join(groups, group, "left_semi")


def reward_metrics(df: DataFrame, reward: str, group: str) -> DataFrame:
    """One row: mean of group means, mean of group deviations, share of groups without any."""
    groups = df.groupBy(group).agg(F.avg(reward).alias("m"), F.coalesce(F.stddev_samp(reward), F.lit(0.0)).alias("s"), (F.min(reward) == F.max(reward)).alias("flat"))
    return groups.agg(F.avg("m").alias("reward"), F.avg("s").alias("reward_std"), F.avg(F.col("flat").cast("double")).alias("frac_zero_std"))


def scaled_scores(score: str, group: str) -> Column:
    """(x - min) / (max - min + 1e-5) in the group; equal scores give min(1, x), and 0 if they are 0."""
    w = Window.partitionBy(group)
    low, high = F.min(score).over(w), F.max(score).over(w)
    return F.when(low == high, F.when(low == 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), low))).otherwise((F.col(score) - low) / (high - low + F.lit(1e-5)))


def best_of_n(df: DataFrame, group: str, key: str, score: str, good: str, n_best: int = 1) -> DataFrame:
    """Pairs of a chosen and a rejected candidate: the ``n_best`` highest scores that are ``good``, each against the lowest; groups with no good candidate give none."""
    up = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(score), key))
    worst = df.groupBy(group).agg(F.max(F.struct((-F.col(score)).alias("s"), F.col(key).alias("k")))["k"].alias("rejected"))
    chosen = df.withColumn("pick", up).where((F.col("pick") <= n_best) & F.col(good))
    return chosen.join(worst, group).where(F.col(key) != F.col("rejected")).select(group, F.col(key).alias("chosen"), "rejected", F.col("pick").cast("long").alias("pick"))


def filled(rounds: list[DataFrame], reward: str, group: str, size: int) -> DataFrame:
    """Rows of the first ``size`` groups whose rewards differ, taken from the rounds in turn until there are enough; too few in all of them give the first round as it is."""
    found = None
    for rows in rounds:
        good = informative(rows, reward, group)
        found = good if found is None else found.unionByName(good)
        chosen = found.select(group).distinct().orderBy(group).limit(size)
        if chosen.count() == size:
            return found.join(chosen, group, "left_semi")
    return rounds[0]


def function_metrics(df: DataFrame, rewards: list[str]) -> DataFrame:
    """One row: mean and sample deviation of each reward column over the rows that have it."""
    return df.agg(*[f(c).alias(f"{c}_{name}") for c in rewards for name, f in (("mean", F.avg), ("std", F.stddev_samp))])
