"""As-of alignment. One engine: union targets and samples, one shuffle by episode, and the samples on both sides.

No range join and no pairs: an episode's rows are sorted in either direction and passed once each, so that the work grows
with their number. With bucket_us set, an
episode is cut into time buckets that are sorted apart; each bucket's ends are carried to the next ones over a table of
one row a bucket, so that no episode, however long, is one task's work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

E = "episode_id"


def samples(messages: DataFrame, topic: str, clock: str = "header_us", payload: tuple[str, ...] = ("values", "header_us")) -> DataFrame:
    """A topic as (episode_id, s_us, seq, payload struct)."""
    return messages.where(F.col("topic") == topic).select(E, F.col(clock).alias("s_us"), "seq", F.struct(*payload).alias("payload"))


def bracket(targets: DataFrame, src: DataFrame, bucket_us: int | None = None) -> DataFrame:
    """Targets with `before`, the newest sample at or before t_us, and `after`, the oldest sample later than that.

    Both are structs (s_us, seq, payload), null where there is none. Of equal stamps the last arrival is before, the first
    after.
    """
    sample = F.struct("s_us", "seq", "payload")
    kind = src.select(sample.alias("s")).schema["s"].dataType
    names = targets.columns
    left = targets.select(E, F.col("t_us").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("ord"), F.lit(None).cast(kind).alias("s"), F.struct(*names).alias("row"))
    right = src.select(E, F.col("s_us").alias("at"), F.lit(0).alias("kind"), F.col("seq").cast("long").alias("ord"), sample.alias("s"), F.lit(None).cast(left.schema["row"].dataType).alias("row"))
    both = left.union(right)
    by = [E]
    if bucket_us:
        both = both.withColumn("bucket", F.floor(F.col("at") / bucket_us))
        by = [E, "bucket"]
    # two running values, one over each direction: a frame that shrinks from the front would be read anew for every row
    past = Window.partitionBy(*by).orderBy("at", "kind", "ord").rowsBetween(Window.unboundedPreceding, 0)
    future = Window.partitionBy(*by).orderBy(F.desc("at"), F.desc("kind"), F.desc("ord")).rowsBetween(Window.unboundedPreceding, -1)
    out = both.withColumns({"before": F.last("s", True).over(past), "after": F.last("s", True).over(future)}).where("kind = 1")
    if bucket_us:
        order = F.when(F.col("kind") == 0, F.struct("at", "ord"))
        ends = both.groupBy(*by).agg(F.min_by("s", order).alias("first"), F.max_by("s", order).alias("last"))
        carried = Window.partitionBy(E).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        coming = Window.partitionBy(E).orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
        ends = ends.select(*by, F.last("last", True).over(carried).alias("carried"), F.last("first", True).over(coming).alias("coming"))
        out = out.join(ends, by).withColumns({"before": F.coalesce("before", "carried"), "after": F.coalesce("after", "coming")})
    return out.select(*[F.col(f"row.{n}").alias(n) for n in names], "before", "after")


def nearest(b: DataFrame, max_us: int | None = None) -> DataFrame:
    """Adds `hit`, the nearest sample (a tie takes the earlier), and dt_us; null beyond max_us."""
    back, ahead = F.col("t_us") - F.col("before.s_us"), F.col("after.s_us") - F.col("t_us")
    later = F.col("before").isNull() | (ahead < back)
    hit = F.when(later & F.col("after").isNotNull(), F.col("after")).otherwise(F.col("before"))
    out = b.withColumn("hit", hit).withColumn("dt_us", F.abs(F.col("hit.s_us") - F.col("t_us")))
    if max_us is not None:
        ok = F.col("dt_us") <= max_us
        out = out.withColumns({"hit": F.when(ok, F.col("hit")), "dt_us": F.when(ok, F.col("dt_us"))})
    return out


def hold(b: DataFrame) -> DataFrame:
    """Adds `hit`, the newest sample at or before the target, and its age_us."""
    return b.withColumn("hit", F.col("before")).withColumn("age_us", F.col("t_us") - F.col("before.s_us"))


def at_or_after() -> Column:
    """The oldest sample at or after the target: an exact hit is its own successor."""
    return F.when(F.col("before.s_us") == F.col("t_us"), F.col("before")).otherwise(F.col("after"))


def interpolate(b: DataFrame, vec: str = "values") -> DataFrame:
    """Adds `value`, linear between neighbours: the last sample's beyond the end, null before the first."""
    x0, x1 = F.col("before.s_us"), F.col("after.s_us")
    share = (F.col("t_us") - x0) / (x1 - x0)
    line = F.zip_with(F.col(f"before.payload.{vec}"), F.col(f"after.payload.{vec}"), lambda a, c: a + (c - a) * share)
    return b.withColumn("value", F.when(F.col("before").isNull(), None).when(F.col("after").isNull() | (x0 == F.col("t_us")), F.col(f"before.payload.{vec}")).otherwise(line))


def bracket_stats(b: DataFrame) -> DataFrame:
    """Adds width_us between the samples at both sides and nearest_us; null without a sample at or after."""
    nxt = at_or_after()["s_us"]
    width = F.when(F.col("before").isNotNull(), nxt - F.col("before.s_us"))
    return b.withColumns({"width_us": width, "nearest_us": F.least(F.col("t_us") - F.col("before.s_us"), nxt - F.col("t_us"))})


def in_gap(b: DataFrame, hz: float) -> DataFrame:
    """Adds in_gap: strictly between two samples further apart than 0.15 * 10 / hz seconds."""
    wide = F.col("after.s_us") - F.col("before.s_us") > round(0.15 * 10 / hz * 1e6)
    return b.withColumn("in_gap", F.coalesce(wide & (F.col("before.s_us") < F.col("t_us")), F.lit(False)))


def fill_gaps(b: DataFrame, hz: float, width: int, sentinel: float = 999.0) -> DataFrame:
    """Adds `value`: the sentinel inside gaps, the nearest sample's elsewhere."""
    out = nearest(in_gap(b, hz))
    return out.withColumn("value", F.when(F.col("in_gap"), F.array_repeat(F.lit(sentinel), width)).otherwise(F.col("hit.payload.values")))


def direct_error(targets: DataFrame, messages: DataFrame, topic: str, bucket_us: int | None = None) -> DataFrame:
    """Match on the receive clock, report the source clocks' difference. targets: t_us receive time, header_us source time."""
    b = nearest(bracket(targets, samples(messages, topic, "bag_us"), bucket_us))
    return b.withColumn("error_us", F.abs(F.col("hit.payload.header_us") - F.col("header_us")))


def lag_compensated(targets: DataFrame, src: DataFrame, delays: DataFrame, bucket_us: int | None = None) -> DataFrame:
    """Hold at the target's time less its episode's delay_us."""
    shifted = targets.join(delays, E).withColumn("t_us", F.col("t_us") - F.col("delay_us"))
    return hold(bracket(shifted, src, bucket_us)).withColumn("t_us", F.col("t_us") + F.col("delay_us"))


def hold_many(targets: DataFrame, messages: DataFrame, topics: list[str], bucket_us: int | None = None) -> DataFrame:
    """The newest values of several topics at each target, by one sort for all: a column for each topic. bucket_us as in bracket()."""
    names = targets.columns
    left = targets.select(E, F.col("t_us").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("seq"), F.lit("").alias("topic"), F.lit(None).cast("array<double>").alias("values"), F.struct(*names).alias("row"))
    right = messages.where(F.col("topic").isin(*topics)).select(E, F.col("header_us").alias("at"), F.lit(0).alias("kind"), "seq", "topic", "values", F.lit(None).cast(left.schema["row"].dataType).alias("row"))
    both, by = left.union(right), [E]
    if bucket_us:
        both, by = both.withColumn("bucket", F.floor(F.col("at") / bucket_us)), [E, "bucket"]
    w = Window.partitionBy(*by).orderBy("at", "kind", "seq").rowsBetween(Window.unboundedPreceding, 0)
    of = lambda t: F.when(F.col("topic") == t, F.col("values"))
    out = both.withColumns({t: F.last(of(t), True).over(w) for t in topics}).where("kind = 1")
    if bucket_us:
        order = lambda t: F.when(F.col("topic") == t, F.struct("at", "seq"))
        ends = both.groupBy(*by).agg(*[F.max_by("values", order(t)).alias(f"last_{i}") for i, t in enumerate(topics)])
        carried = Window.partitionBy(E).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        ends = ends.select(*by, *[F.last(f"last_{i}", True).over(carried).alias(f"carried_{i}") for i in range(len(topics))])
        out = out.join(ends, by).withColumns({t: F.coalesce(t, f"carried_{i}") for i, t in enumerate(topics)})
    return out.select(*[F.col(f"row.{n}").alias(n) for n in names], *topics)
