"""Gripper cycles: debounced transitions, pairs, statuses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

E, FR = "episode_index", "frame_index"


def frame_order():
    return Window.partitionBy(E).orderBy(FR)


def debounce(frames: DataFrame, value: str, low: float = 0.3, high: float = 0.7, n: int = 2) -> DataFrame:
    """Confirmed changes of state with hysteresis: a run of n frames at one side counts; its first state is no event.

    In-band frames end a run. Runs are islands of equal observations; an event stands at its run's first frame.
    """
    obs = F.when(F.col(value) >= high, 1).when(F.col(value) <= low, 0)
    rows = frames.select(E, FR, obs.alias("obs"))
    cut = F.sum(F.when(F.lag("obs").over(frame_order()).eqNullSafe(F.col("obs")), 0).otherwise(1)).over(frame_order())
    found = rows.withColumn("run", cut).where("obs is not null").groupBy(E, "run", "obs").agg(F.min(FR).alias(FR), F.count("*").alias("n")).where(f"n >= {n}")
    before = F.lag("obs").over(frame_order())
    return found.withColumn("before", before).where("before is not null and obs <> before").select(E, FR, F.when(F.col("obs") == 1, "close").otherwise("open").alias("kind"))


def pair_cycles(events: DataFrame) -> DataFrame:
    """A close and the next open: cycle; an open without close: orphan; a last close: unclosed. A later close takes an earlier one's place."""
    prev, nxt = F.lag("kind").over(frame_order()), F.lead("kind").over(frame_order())
    rows = events.withColumns({"prev": prev, "nxt": nxt, "prev_frame": F.lag(FR).over(frame_order())})
    status = F.when((F.col("kind") == "open") & (F.col("prev") == "close"), "cycle").when(F.col("kind") == "open", "orphan_open").when(F.col("nxt").isNull(), "unclosed").otherwise(None)
    return rows.withColumn("pair", status).where("pair is not null").select(E, F.when(F.col("pair") == "cycle", F.col("prev_frame")).otherwise(F.when(F.col("pair") == "unclosed", F.col(FR))).alias("close_frame"), F.when(F.col("kind") == "open", F.col(FR)).alias("open_frame"), "pair")


def cycle_status(pairs: DataFrame, expected: int, least: int = 2) -> DataFrame:
    """A recording's cycle status from its counts."""
    c = pairs.groupBy(E).agg(F.count_if(F.col("pair") == "cycle").alias("cycles"), F.count_if(F.col("pair") == "orphan_open").alias("orphans"), F.count_if(F.col("pair") == "unclosed").alias("unclosed"), F.min(F.when(F.col("pair") == "cycle", F.col("open_frame") - F.col("close_frame"))).alias("shortest"))
    s = F.when((F.col("cycles") == 0) & (F.col("orphans") + F.col("unclosed") == 0), "none").when(F.col("unclosed") > 0, "unclosed").when(F.col("orphans") > 0, "orphan_open").when(F.col("shortest") < least, "too_short").when(F.col("cycles") == expected, "expected").when(F.col("cycles") > expected, "extra").otherwise("missing")
    return c.withColumn("status", s)


def episode_status(statuses: DataFrame) -> DataFrame:
    """nominal if all dimensions are as expected, recovery_candidate if some have more and none is broken, else anomaly."""
    return statuses.groupBy(E).agg(F.when(F.bool_and(F.col("status") == "expected"), "nominal").when(F.bool_and(F.col("status").isin("expected", "extra")), "recovery_candidate").otherwise("anomaly").alias("episode_status"))


def cycle_distribution(statuses: DataFrame) -> DataFrame:
    rows = statuses.select(F.explode(F.array(F.struct(F.lit("cycles").alias("name"), F.col("cycles").cast("string").alias("value")), F.struct(F.lit("status").alias("name"), F.col("status").alias("value")))).alias("x")).select("x.*")
    return rows.groupBy("name", "value").agg(F.count("*").alias("n"))
