"""Exact quantiles of columns of any length, without a map of all values in one task.

Sketches first tell, for each group and quantile, a narrow range that must hold its rank. A second pass counts what lies
below that range and each value inside it; a running sum over these few values finds the rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rank error of the sketches, as a part of the rows.
ACCURACY = 10_000


def sketch(x: str, shares: dict[str, float], accuracy: int = ACCURACY) -> list[Column]:
    """Aggregates that refine() needs of a column: a sketch's marks around each quantile, and number and ends of its values."""
    share = list(shares.values())
    marks = [max(0.0, s - 6.0 / accuracy) for s in share] + [min(1.0, s + 6.0 / accuracy) for s in share]
    return [F.count(x).alias("__n"), F.min(x).alias("__low"), F.max(x).alias("__high"), F.percentile_approx(x, F.array(*map(F.lit, marks)), accuracy).alias("__b")]


def refine(rows: DataFrame, bounds: DataFrame, by: list[str], x: str, shares: dict[str, float], accuracy: int = ACCURACY, few: bool = False) -> DataFrame:
    """The quantiles of quantiles(), from rows without null values and bounds with sketch()'s columns for each group."""
    keys = [f"__k{i}" for i in range(len(by))] or ["__k"]
    named = lambda df, *more: df.select(*([F.col(b).alias(k) for b, k in zip(by, keys)] or [F.lit(0).alias("__k")]), *more)
    # a sketch's rank error, and the two ranks around a quantile; groups of up to `accuracy` rows are one range
    margin, share = 6.0 / accuracy, list(shares.values())
    n, low, high, b = (F.col(f"__{c}") for c in ("n", "low", "high", "b"))
    ranges = F.array(*[F.struct(F.lit(i).alias("q"), F.when((n > accuracy) & F.lit(s > margin), b[i]).otherwise(low).alias("lo"), F.when((n > accuracy) & F.lit(s < 1.0 - margin), b[i + len(share)]).otherwise(high).alias("hi"), (F.lit(s) * (n - 1)).alias("pos")) for i, s in enumerate(share)])
    marks = named(bounds, ranges.alias("ranges")).withColumnsRenamed({k: f"b{k}" for k in keys})
    near = named(rows, F.col(x).cast("double").alias("x")).join(F.broadcast(marks) if few else marks, [F.col(k).eqNullSafe(F.col(f"b{k}")) for k in keys])
    near = near.select(*keys, "x", F.explode(F.filter("ranges", lambda r: F.col("x") <= r["hi"])).alias("r"))
    counted = near.groupBy(*keys, "r.q", "r.pos", F.when(F.col("x") >= F.col("r.lo"), F.col("x")).alias("v")).agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.partitionBy(*keys, "q").orderBy(F.asc_nulls_first("v")))
    # a value's NaN is greater than any number in Spark's order, too
    at = lambda rank: F.min(F.when(F.col("upto") > rank, F.col("v")))
    low, high = F.floor("pos"), F.ceil("pos")
    found = counted.withColumn("upto", upto).groupBy(*keys, "q", "pos").agg(at(low).alias("a"), at(high).alias("b"), F.count_if(F.col("v").isNull() & (F.col("upto") > low)).alias("missed"))
    value = F.when((F.col("missed") > 0) | F.col("a").isNull() | F.col("b").isNull(), F.raise_error(F.lit("a sketch missed its quantile"))).otherwise(F.col("a") + (F.col("b") - F.col("a")) * (F.col("pos") - low))
    out = found.select(*keys, "q", value.alias("v")).groupBy(*keys).agg(*[F.max(F.when(F.col("q") == i, F.col("v"))).alias(name) for i, name in enumerate(shares)])
    return out.select(*[F.col(k).alias(b) for b, k in zip(by, keys)], *shares)


def quantiles(df: DataFrame, by: list[str], x: str, shares: dict[str, float], accuracy: int = ACCURACY, few: bool = False) -> DataFrame:
    """Rows (by, a column for each share): quantiles, linear between ranks. Null values don't count; NaN is the largest.

    Groups without a value have no row. few: the groups are dimensions, features or the like, whose bounds are sent to every
    task. A range that misses its rank, which the sketches' bound rules out, is an error.
    """
    rows = df.select(*by, F.col(x).cast("double").alias("__x")).where("__x is not null")
    return refine(rows, rows.groupBy(*by).agg(*sketch("__x", shares, accuracy)), by, "__x", shares, accuracy, few or not by)


#: Bins of a round of weighted_quantiles().
BINS = 4096


def weighted_quantiles(df: DataFrame, by: list[str], x: str, weight: str, shares: dict[str, float], rounds: int = 2) -> DataFrame:
    """Rows (by, a column for each share): quantiles of the column in which each value comes `weight` times, a whole number.

    Rounds narrow each rank's range to one of BINS bins of equal width, by sums of weights; a last pass over the values in
    there finds it. Groups are few, as dimensions are. Null values and weights that aren't positive don't count.
    """
    keys = [f"__k{i}" for i in range(len(by))]
    rows = df.select(*[F.col(b).alias(k) for b, k in zip(by, keys)], F.lit(0).alias("__k"), F.col(x).cast("double").alias("x"), F.col(weight).cast("long").alias("w")).where("x is not null and w > 0")
    keys = [*keys, "__k"]
    total = rows.groupBy(*keys).agg(F.sum("w").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    ranks = F.array(*[F.struct(F.lit(f"{name}{end}").alias("q"), f(F.lit(s) * (F.col("n") - 1)).alias("rank")) for name, s in shares.items() for end, f in (("-", F.floor), ("+", F.ceil))])
    # a row a group and rank: the range that holds it, and the weight below
    ranges = total.select(*keys, "n", "lo", "hi", F.lit(0).cast("long").alias("below"), F.inline(ranks))
    inside = lambda r: rows.join(F.broadcast(r.withColumnsRenamed({k: f"r{k}" for k in keys})), [F.col(k).eqNullSafe(F.col(f"r{k}")) for k in keys]).where("x between lo and hi").drop(*[f"r{k}" for k in keys])
    for _ in range(rounds):
        group = [*keys, "q", "rank", "n", "below"]
        bin_ = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(BINS - 1), F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BINS))).otherwise(F.lit(0))
        sums = inside(ranges).groupBy(*group, bin_.alias("bin")).agg(F.sum("w").alias("w"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        upto = F.sum("w").over(Window.partitionBy(*keys, "q").orderBy("bin"))
        sums = sums.withColumn("upto", F.col("below") + upto).where(F.col("upto") > F.col("rank"))
        first = sums.groupBy(*group).agg(F.min_by(F.struct("lo", "hi", (F.col("upto") - F.col("w")).alias("under")), "bin").alias("f"))
        ranges = first.select(*keys, "n", "f.lo", "f.hi", F.col("f.under").alias("below"), "q", "rank")
    values = inside(ranges).groupBy(*keys, "q", "rank", "n", "below", "x").agg(F.sum("w").alias("w"))
    upto = F.col("below") + F.sum("w").over(Window.partitionBy(*keys, "q").orderBy("x"))
    found = values.withColumn("upto", upto).where(F.col("upto") > F.col("rank")).groupBy(*keys, "n").agg(*[F.min(F.when(F.col("q") == f"{name}{end}", F.col("x"))).alias(f"{name}{end}") for name in shares for end in "-+"])
    value = lambda name, s: F.col(f"`{name}-`") + (F.col(f"`{name}+`") - F.col(f"`{name}-`")) * (F.lit(s) * (F.col("n") - 1) - F.floor(F.lit(s) * (F.col("n") - 1)))
    return found.select(*[F.col(k).alias(b) for b, k in zip(by, keys)], *[value(name, s).alias(name) for name, s in shares.items()])
