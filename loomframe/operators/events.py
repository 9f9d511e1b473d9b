"""Command edges and the responses to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

E = "episode_id"


def edges(commands: DataFrame, threshold: float, value: str = "x") -> DataFrame:
    """Changes between open and closed (value > threshold). commands: episode_id, t_us, seq, x."""
    closed = F.col(value) > threshold
    w = Window.partitionBy(E).orderBy("t_us", "seq")
    out = commands.withColumn("closed", closed).withColumn("was", F.lag("closed").over(w))
    return out.where("was is not null and closed <> was").select(E, "t_us", "seq", F.when(F.col("closed"), "close").otherwise("open").alias("kind"))


def stable_edges(found: DataFrame, ends: DataFrame, hold_us: int) -> DataFrame:
    """Edges that hold: the next one, or the interval's end (ends: episode_id, end_us), is at least hold_us away."""
    w = Window.partitionBy(E).orderBy("t_us", "seq")
    out = found.join(ends, E).withColumn("until", F.coalesce(F.lead("t_us").over(w), "end_us"))
    return out.withColumn("stable", F.col("until") - F.col("t_us") >= hold_us).drop("end_us")


def event_samples(events: DataFrame, src: DataFrame, before_us: int, after_us: int) -> DataFrame:
    """Samples within [event - before, event + after): an equi-join on time buckets as wide as the window.

    events: episode_id, event_id, at_us; src: episode_id, s_us, x.
    """
    width = before_us + after_us
    buckets = events.withColumn("bucket", F.explode(F.sequence(F.floor((F.col("at_us") - before_us) / width), F.floor((F.col("at_us") + after_us) / width))))
    return buckets.join(src.withColumn("bucket", F.floor(F.col("s_us") / width)), [E, "bucket"]).where((F.col("s_us") >= F.col("at_us") - before_us) & (F.col("s_us") < F.col("at_us") + after_us)).drop("bucket")


def first_crossing(inside: DataFrame, by: list[str], level: str, rising: str) -> DataFrame:
    """Delay from the event to the first sample beyond the level, in the event's direction."""
    cond = F.when(F.col(rising), F.col("x") >= F.col(level)).otherwise(F.col("x") <= F.col(level))
    return inside.where(F.col("s_us") >= F.col("at_us")).groupBy(*by).agg(F.min(F.when(cond, F.col("s_us") - F.col("at_us"))).alias("delay_us"))


def response_events(events: DataFrame, src: DataFrame, window_us: int, baseline_us: int, tail_us: int, least_move: float, limit_us: int) -> DataFrame:
    """For each command edge: medians before it and at the end of its window, the move, delays to 5, 50 and 95 % of it, and a reason if it isn't valid.

    events: episode_id, event_id, at_us, kind. A close must raise the state, an open must lower it. The window ends early
    at the next edge.
    """
    w = Window.partitionBy(E).orderBy("at_us", "event_id")
    ev = events.withColumn("end_us", F.least(F.col("at_us") + window_us, F.coalesce(F.lead("at_us").over(w), F.col("at_us") + window_us)))
    near = event_samples(ev, src, baseline_us, window_us).where(F.col("s_us") < F.col("end_us"))
    by = [E, "event_id"]
    med = near.groupBy(*by).agg(F.median(F.when(F.col("s_us") < F.col("at_us"), F.col("x"))).alias("baseline"), F.median(F.when(F.col("s_us") >= F.col("end_us") - tail_us, F.col("x"))).alias("final"))
    near = near.join(med, by).withColumn("up", F.col("final") > F.col("baseline"))
    crossed = lambda share: F.min(F.when((F.col("s_us") >= F.col("at_us")) & F.when(F.col("up"), F.col("x") >= F.col("baseline") + share * (F.col("final") - F.col("baseline"))).otherwise(F.col("x") <= F.col("baseline") + share * (F.col("final") - F.col("baseline"))), F.col("s_us") - F.col("at_us")))
    delays = near.where("baseline is not null and final is not null").groupBy(*by).agg(*[crossed(s).alias(f"delay{int(s * 100)}_us") for s in (0.05, 0.5, 0.95)])
    out = ev.join(med, by, "left").join(delays, by, "left").withColumn("move", F.col("final") - F.col("baseline"))
    wrong = F.when(F.col("kind") == "close", F.col("move") < 0).otherwise(F.col("move") > 0)
    reason = F.when(F.col("baseline").isNull(), "no_baseline").when(F.col("final").isNull(), "no_final").when(F.abs("move") < least_move, "no_move").when(wrong, "direction").when(F.col("delay50_us").isNull(), "no_crossing").when(F.col("delay50_us") > limit_us, "slow")
    return out.withColumn("reason", reason).select(E, "event_id", "kind", "baseline", "final", "move", "delay5_us", "delay50_us", "delay95_us", "reason")


def delay_summary(responses: DataFrame, by: list[str]) -> DataFrame:
    """Median and maximum of the 50 % and 95 % delays over valid events."""
    v = responses.where("reason is null")
    return v.groupBy(*by).agg(F.count("*").alias("events"), *[f(c).alias(f"{n}_{c}") for c in ("delay50_us", "delay95_us") for n, f in (("median", F.median), ("max", F.max))])
