"""Message clocks: master timeline, duplicates, rates, coverage, order, backlog, gaps.

messages: episode_id, topic, seq (arrival order), header_us (source clock), bag_us (receive clock), values.
targets: episode_id, frame_index, t_us.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

E = "episode_id"


def scan_topics(messages: DataFrame, topics: list[str], t0: int | None = None, t1: int | None = None) -> DataFrame:
    """Messages of some topics, within an inclusive range of source time. Both filters reach the scan."""
    out = messages.where(F.col("topic").isin(*topics))
    return out if t0 is None else out.where(F.col("header_us").between(t0, t1))


def scan_clock(messages: DataFrame) -> DataFrame:
    """Stamps alone; payload columns are never read."""
    return messages.select(E, "topic", "seq", "header_us", "bag_us")


def master_clock(messages: DataFrame, topic: str, drop: int = 0, stride: int = 1) -> DataFrame:
    """Targets: the topic's stamps without the first and last `drop`, every `stride`-th of the rest."""
    src = messages.where(F.col("topic") == topic).select(E, "seq", F.col("header_us").alias("t_us"))
    rn = F.row_number().over(Window.partitionBy(E).orderBy("t_us", "seq")) - 1
    n = F.count("*").over(Window.partitionBy(E))
    kept = src.withColumns({"rn": rn, "n": n}).where(f"rn >= {drop} and rn < n - {drop} and (rn - {drop}) % {stride} = 0")
    return kept.select(E, ((F.col("rn") - drop) / stride).cast("long").alias("frame_index"), "t_us")


def clip_min_end(targets: DataFrame, messages: DataFrame) -> DataFrame:
    """Targets before the earliest end of any topic of their episode."""
    ends = messages.groupBy(E, "topic").agg(F.max("header_us").alias("end")).groupBy(E).agg(F.min("end").alias("end"))
    return targets.join(ends, E).where("t_us < end").drop("end")


def dedup_newest(messages: DataFrame) -> DataFrame:
    """One message for each stamp of a topic, the newest arrival."""
    later = F.lead("header_us").over(Window.partitionBy(E, "topic").orderBy("header_us", "seq"))
    return messages.withColumn("later", later).where("later is null or later > header_us").drop("later")


def distinct_stamps(messages: DataFrame) -> DataFrame:
    return messages.select(E, "topic", "header_us").where("header_us is not null").distinct()


def rate_stats(messages: DataFrame) -> DataFrame:
    """Rate of each topic in messages a second by both clocks; null for a single stamp or no span."""
    hz = lambda c: F.when((F.count(c) > 1) & (F.max(c) > F.min(c)), (F.count(c) - 1) * 1e6 / (F.max(c) - F.min(c)))
    return messages.groupBy(E, "topic").agg(F.count("*").alias("n"), ((F.max("header_us") - F.min("header_us")) / 1e6).alias("span_s"), hz("header_us").alias("source_hz"), hz("bag_us").alias("receive_hz"))


def coverage(messages: DataFrame, topic: str, master: str) -> DataFrame:
    """Share of the master topic's span that the topic's span overlaps."""
    ends = lambda name, p: messages.where(F.col("topic") == name).groupBy(E).agg(F.min("header_us").alias(f"{p}0"), F.max("header_us").alias(f"{p}1"))
    both = ends(master, "m").join(ends(topic, "s"), E, "left")
    overlap = F.greatest(F.lit(0), F.least("m1", "s1") - F.greatest("m0", "s0"))
    return both.select(E, F.when(F.col("s0").isNull() | (F.col("m1") <= F.col("m0")), 0.0).otherwise(overlap / (F.col("m1") - F.col("m0"))).alias("coverage"))


def nonmonotonic(messages: DataFrame, clock: str = "header_us") -> DataFrame:
    """Messages whose stamp isn't later than that of the arrival before."""
    step = F.col(clock) - F.lag(clock).over(Window.partitionBy(E, "topic").orderBy("seq"))
    return messages.withColumn("step", step).groupBy(E, "topic").agg(F.count_if(F.col("step") <= 0).alias("nonmonotonic"))


def backlog(messages: DataFrame) -> DataFrame:
    """Receive minus source time in ms: percentiles and the last arrival's."""
    age = ((F.col("bag_us") - F.col("header_us")) / 1000.0).alias("age")
    p = F.percentile("age", F.array(*map(F.lit, (0.5, 0.95, 0.99))))
    out = messages.select(E, "topic", "seq", age).groupBy(E, "topic").agg(p.alias("p"), F.max("age").alias("max_ms"), F.max_by("age", "seq").alias("final_ms"))
    return out.select(E, "topic", *[F.col("p")[i].alias(n) for i, n in enumerate(("p50_ms", "p95_ms", "p99_ms"))], "max_ms", "final_ms")


def reliable_prefix(messages: DataFrame, topic: str, master: str, limit_ms: float, bin_us: int = 250_000) -> DataFrame:
    """Seconds of the master topic's span, by receive time, before the topic's messages go stale.

    Messages are binned by receive time from the master's first; the first of two neighbouring bins whose median age is
    above the limit ends the prefix, and the whole span is reliable without one. 0 without messages or a span.
    """
    span = messages.where(F.col("topic") == master).groupBy(E).agg(F.min("bag_us").alias("m0"), F.max("bag_us").alias("m1"))
    rows = messages.where(F.col("topic") == topic).select(E, "bag_us", ((F.col("bag_us") - F.col("header_us")) / 1000.0).alias("age"))
    bins = rows.join(span, E).withColumn("bin", F.floor((F.col("bag_us") - F.col("m0")) / bin_us))
    inside = (F.col("bin") >= 0) & (F.col("bin") <= F.ceil((F.col("m1") - F.col("m0")) / bin_us))
    # messages outside the span still tell that the topic was there
    bins = bins.groupBy(E, F.when(inside, F.col("bin")).alias("bin")).agg(F.median("age").alias("age"))
    w = Window.partitionBy(E).orderBy(F.asc_nulls_first("bin"))
    stale = (F.col("age") > limit_ms) & (F.lead("age").over(w) > limit_ms) & (F.lead("bin").over(w) == F.col("bin") + 1)
    ends = bins.withColumn("stale", stale).groupBy(E).agg(F.min(F.when(F.col("stale"), F.col("bin"))).alias("end"), F.lit(True).alias("any"))
    whole = F.when(F.col("any") & (F.col("m1") > F.col("m0")), F.coalesce(F.col("end") * bin_us, F.col("m1") - F.col("m0")) / 1e6)
    return span.join(ends, E, "left").select(E, F.coalesce(whole, F.lit(0.0)).alias("reliable_s"))


def find_gaps(messages: DataFrame, topic: str, hz: float) -> DataFrame:
    """Neighbouring stamps further apart than 0.15 * 10 / hz seconds."""
    w = Window.partitionBy(E).orderBy("header_us", "seq")
    rows = messages.where(F.col("topic") == topic).select(E, F.lag("header_us").over(w).alias("gap_start"), F.col("header_us").alias("gap_end"))
    return rows.where(F.col("gap_end") - F.col("gap_start") > round(0.15 * 10 / hz * 1e6))


def topic_inventory(messages: DataFrame, expected: list[str], width: int) -> tuple[DataFrame, DataFrame]:
    """Counts by topic (empty and invalid payloads too), and the expected topics that an episode lacks."""
    bad = (F.size("values") < width) | F.exists("values", lambda x: x.isNull() | F.isnan(x))
    counts = messages.groupBy(E, "topic").agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.size("values"), F.lit(0)) <= 0).alias("empty"), F.count_if(bad).alias("invalid"))
    missing = messages.groupBy(E).agg(F.collect_set("topic").alias("t")).select(E, F.explode(F.array_except(F.array(*map(F.lit, expected)), "t")).alias("topic"))
    return counts, missing
