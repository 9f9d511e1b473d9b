"""Per-dimension statistics, their merges, mixtures of sources, rate limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quantiles import quantiles, refine, sketch, weighted_quantiles

#: Size of the sketches that merge, and the rank error that they keep (99 %), before and after a merge.
SKETCH_K, SKETCH_ERROR = 1000, 0.005
QUANTILES = {"q01": 0.01, "q10": 0.1, "q50": 0.5, "q90": 0.9, "q99": 0.99}


def vector_stats(df: DataFrame, v: str, by: list[str] | None = None, approximate: bool = False, small: bool = False, sketches: bool = False) -> DataFrame:
    """Rows (by, dim, count, min, max, mean, population std, quantiles) of each dimension.

    Quantiles are exact (linear between ranks) in a second pass; small=True takes them in the first, from a map of each
    group's values, for groups of bounded length such as episodes; approximate=True takes sketches of bounded size instead. sketches=True adds
    a column sketch, from which merge_sketched() makes the quantiles of several groups together.
    """
    by = by or []
    rows = df.select(*by, F.posexplode(v).alias("dim", "x"))
    plain = [F.count("x").alias("count"), F.min("x").alias("min"), F.max("x").alias("max"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std")]
    names, more = ["count", "min", "max", "mean", "std"], ["sketch"] if sketches else []
    if sketches:
        plain.append(F.kll_sketch_agg_double(F.col("x").cast("double"), SKETCH_K).alias("sketch"))
    if approximate or small:
        out = rows.groupBy(*by, "dim").agg(*plain, (F.percentile_approx if approximate else F.percentile)("x", F.array(*map(F.lit, QUANTILES.values()))).alias("q"))
        return out.select(*by, "dim", *names, *[F.col("q")[i].alias(n) for i, n in enumerate(QUANTILES)], *more)
    # statistics and sketches in one pass, and one more over the values near the quantiles
    one = rows.groupBy(*by, "dim").agg(*plain, *sketch("x", QUANTILES))
    q = refine(rows.where("x is not null"), one, [*by, "dim"], "x", QUANTILES, few=by in ([], ["feature"]))
    same = [F.col(f"o.{k}").eqNullSafe(F.col(f"q.{k}")) for k in (*by, "dim")]
    return one.select(*by, "dim", *names, *more).alias("o").join(q.alias("q"), same, "left").select(*[f"o.{c}" for c in (*by, "dim", *names)], *[f"q.{n}" for n in QUANTILES], *[f"o.{c}" for c in more])


def feature_stats(df: DataFrame, columns: list[str], by: list[str] | None = None, approximate: bool = False, small: bool = False, sketches: bool = False) -> DataFrame:
    """Rows (by, feature, dim, statistics) of several columns in one pass: vectors, and scalars (index columns) as one dimension."""
    by = by or []
    vector = lambda c: F.col(f"`{c}`").cast("array<double>") if isinstance(df.schema[c].dataType, T.ArrayType) else F.array(F.col(f"`{c}`").cast("double"))
    rows = df.select(*by, F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), vector(c).alias("x")) for c in columns])))
    return vector_stats(rows, "x", [*by, "feature"], approximate, small, sketches)


def as_arrays(stats: DataFrame, by: list[str]) -> DataFrame:
    """One row for each group with an array for each statistic, in the order of dimensions."""
    names = [c for c in stats.columns if c not in (*by, "dim")]
    rows = stats.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("dim", *names))).alias("s"))
    return rows.select(*by, *[F.col(f"s.{n}").alias(n) for n in names])


def merge_stats(parts: DataFrame, by: list[str]) -> DataFrame:
    """Statistics of parts merged by count; quantiles become count-weighted means of the parts' (not exact)."""
    w = F.col("count") / F.sum("count").over(Window.partitionBy(*by))
    rows = parts.withColumn("w", w).groupBy(*by)
    mean = F.sum(F.col("w") * F.col("mean"))
    second = F.sum(F.col("w") * (F.col("std") * F.col("std") + F.col("mean") * F.col("mean")))
    out = rows.agg(F.sum("count").alias("count"), F.min("min").alias("min"), F.max("max").alias("max"), mean.alias("mean"), second.alias("m2"), *[F.sum(F.col("w") * F.col(q)).alias(q) for q in QUANTILES if q in parts.columns])
    return out.withColumn("std", F.sqrt(F.greatest(F.col("m2") - F.col("mean") * F.col("mean"), F.lit(0.0)))).drop("m2")


def merge_sketched(parts: DataFrame, by: list[str]) -> DataFrame:
    """Statistics of parts with sketches merged: as merge_stats(), but quantiles from the merged sketch, whose rank is off by SKETCH_ERROR at most."""
    out = merge_stats(parts.drop(*QUANTILES), by)
    q = F.kll_sketch_get_quantile_double("s", F.array(*map(F.lit, QUANTILES.values())))
    sketches = parts.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("s")).select(*[F.col(b).alias(f"__{b}") for b in by], F.col("s").alias("sketch"), q.alias("q"))
    same = [F.col(b).eqNullSafe(F.col(f"__{b}")) for b in by]
    return out.join(sketches, same).select(*by, "count", "min", "max", "mean", "std", *[F.col("q")[i].alias(n) for i, n in enumerate(QUANTILES)], "sketch")


def mixture_quantiles(rows: DataFrame, lengths: DataFrame, v: str) -> DataFrame:
    """Exact quantiles of each dimension over a weighted mixture, without making its copies: those of virtual_mixture()'s rows.

    rows: source, local (its place in the source) and the vector; lengths: source, n, weight.
    """
    s = slots(lengths).where("n > 0").select("source", "n", "slots")
    copies = F.greatest(F.lit(0).cast("long"), F.ceil((F.col("slots") - F.col("local")) / F.col("n"))).cast("long")
    mixed = rows.join(F.broadcast(s), "source")  # a mixture names its few sources
    return weighted_quantiles(mixed.select(copies.alias("w"), F.posexplode(v).alias("dim", "x")), ["dim"], "x", "w", QUANTILES)


def mixture_stats(stats: DataFrame, weights: DataFrame, by: list[str], source: str = "source") -> DataFrame:
    """Sources' statistics mixed by weight, not count; keys that some source lacks are left out, and so are quantiles that some source lacks."""
    n = weights.count()
    joined = stats.join(F.broadcast(weights), source)  # a mixture names its few sources
    qs = [q for q in QUANTILES if q in stats.columns]
    w, mean, std = F.col("weight"), F.col("mean"), F.col("std")
    out = joined.groupBy(*by).agg(F.count("*").alias("sources"), F.sum("count").alias("count"), F.min("min").alias("min"), F.max("max").alias("max"), F.sum(w * mean).alias("mean"), F.sum(w * (std * std + mean * mean)).alias("m2"), *[F.when(F.count(q) == n, F.sum(w * F.col(q))).alias(q) for q in qs])
    out = out.where(F.col("sources") == n)
    return out.withColumn("std", F.sqrt(F.greatest(F.col("m2") - F.col("mean") * F.col("mean"), F.lit(0.0)))).drop("m2", "sources")


def normalise_weights(weights: DataFrame) -> DataFrame:
    """Positive weights divided by their sum."""
    total = weights.where("weight > 0").agg(F.sum("weight").alias("total"))
    return weights.where("weight > 0").join(F.broadcast(total)).withColumn("weight", F.col("weight") / F.col("total")).drop("total")


def slots(lengths: DataFrame) -> DataFrame:
    """Slots of each source in a weighted mixture: every row of every source is covered. lengths: source, n, weight (sums to 1)."""
    total = lengths.agg(F.max(F.ceil(F.col("n") / F.col("weight"))).alias("size"))
    return lengths.join(F.broadcast(total)).withColumn("slots", F.greatest(F.lit(1).cast("long"), F.bround(F.col("size") * F.col("weight")).cast("long"))).drop("size")


def virtual_mixture(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """Rows (source, slot, local) of a mixture: local is slot modulo the source's length; rows: source, local and payload.

    Each row makes its own copies, every n-th slot from its place on, so that no source's slots are one list.
    """
    s = slots(lengths).where("n > 0").select("source", "n", "slots")
    copies = F.explode(F.sequence(F.col("local"), F.col("slots") - 1, F.col("n"))).alias("slot")
    return rows.join(s, "source").where("local < slots").select(*rows.columns, copies)


def realized_weights(mixed: DataFrame) -> DataFrame:
    counts = mixed.groupBy("source").agg(F.count("*").alias("n"))
    return counts.join(F.broadcast(counts.agg(F.sum("n").alias("total")))).select("source", "n", (F.col("n") / F.col("total")).alias("realized"))


def rate_limits(frames: DataFrame, p: float, v: str = "action") -> DataFrame:
    """Percentiles of the sizes of first and second differences inside an episode, for each dimension."""
    w = Window.partitionBy("episode_index").orderBy("frame_index")
    d1 = F.zip_with(F.col(v), F.lag(v, 1).over(w), lambda a, b: a - b)
    rows = frames.withColumn("d1", d1).withColumn("d2", F.zip_with(F.col("d1"), F.lag("d1", 1).over(w), lambda a, b: a - b))
    rows = rows.select(F.posexplode(F.arrays_zip("d1", F.coalesce("d2", F.array().cast("array<double>")).alias("d2"))).alias("dim", "d"))
    rows = rows.select("dim", F.inline(F.array(*[F.struct(F.lit(n).alias("which"), F.abs(f"d.{d}").alias("d")) for n, d in (("first", "d1"), ("second", "d2"))])))
    q = quantiles(rows, ["dim", "which"], "d", {"p": p}, few=True)
    return q.groupBy("dim").agg(*[F.max(F.when(F.col("which") == n, F.col("p"))).alias(n) for n in ("first", "second")])


def norm_stats(windows: DataFrame, state: str, chunk: str, relative: bool) -> DataFrame:
    """Statistics of state rows and of actions: the first step (absolute) or the chunk less the state, steps merged (relative)."""
    part = lambda name, x: F.struct(F.lit(name).alias("feature"), x.alias("x"))
    if relative:
        actions = F.transform(F.col(chunk), lambda step: part("action", F.zip_with(step, F.col(state), lambda x, s: x - s)))
    else:
        actions = F.array(part("action", F.col(chunk)[0]))
    return vector_stats(windows.select(F.inline(F.concat(F.array(part("state", F.col(state))), actions))), "x", ["feature"])


def describe_dims(frames: DataFrame, v: str, dims: list[int]) -> DataFrame:
    rows = frames.select(F.posexplode(v).alias("dim", "x")).where(F.col("dim").isin(*dims))
    out = rows.groupBy("dim").agg(F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("min"), F.max("x").alias("max"))
    return out.join(quantiles(rows, ["dim"], "x", {"median": 0.5}, few=True), "dim").select("dim", "count", "mean", "std", "min", "median", "max")


def loss_by_source(log: DataFrame) -> DataFrame:
    return log.groupBy("step", "source").agg(F.avg("loss").alias("loss"))


def majority_width(df: DataFrame, v: str) -> DataFrame:
    """Rows of the most common vector width; a tie takes the smaller."""
    top = df.groupBy(F.size(v).alias("w")).agg(F.count("*").alias("n")).agg(F.max_by("w", F.struct("n", -F.col("w"))).alias("w"))
    return df.join(F.broadcast(top), F.size(v) == F.col("w")).drop("w")
