"""Samples of episodes: by hash, and evenly over a range of values."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sample_random(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows without replacement: the least of a seeded hash. The same rows however the table is dealt."""
    return df.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(n)


def candidates(keyed: DataFrame, low: float, high: float, n: int) -> DataFrame:
    """Rows (g, k, v) that n evenly spaced targets can take: of what lies between two targets, the n first and the n last.

    A target takes one row, so a side of a stretch between targets loses n rows at most. Only these leave a task.
    """
    step = (high - low) / (n - 1) if n > 1 and high > low else None
    slot = keyed.withColumn("slot", F.floor((F.col("v") - low) / step) if step else F.lit(0).cast("long"))

    def first(*order):
        rank = F.row_number().over(Window.partitionBy("g", "slot").orderBy(*order))
        return slot.withColumn("r", rank).where(F.col("r") <= n).select("g", "k", "v")

    return first("v", "k").union(first(F.desc("v"), "k")).distinct()


def sample_uniform(df: DataFrame, key: str, value: str, low: float, high: float, n: int, by: str | None = None) -> DataFrame:
    """n rows evenly over [low, high]: each of n evenly spaced targets, in order, takes the nearest row not yet taken; ties go to the first by key.

    The choice is greedy, each step depending on those before; it runs over the at most 2 n * n rows of a group that the
    targets can reach. by: a column of groups that are sampled each.
    """
    keyed = df.where(F.col(value).between(low, high)).select(F.col(key).alias("k"), F.col(value).cast("double").alias("v"), (F.col(by) if by else F.lit(0)).cast("long").alias("g"))

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        free, out = pdf.sort_values("k").reset_index(drop=True), []
        for place in range(min(n, len(free))):
            target = low + (high - low) * place / (n - 1) if n > 1 else low
            at = (free.v - target).abs().idxmin()  # the first by key of the nearest
            out.append((place, free.k[at], free.v[at], free.g[at]))
            free = free.drop(at)
        return pd.DataFrame(out, columns=["place", "k", "v", "g"])

    out = candidates(keyed, low, high, n).groupBy("g").applyInPandas(pick, "place int, k bigint, v double, g bigint")
    return out.select(*([F.col("g").alias(by)] if by else []), "place", F.col("k").alias(key), F.col("v").alias(value))
