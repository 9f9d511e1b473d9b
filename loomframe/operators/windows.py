"""Observation and action windows, and scores of predicted chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import quantiles

E, FR = "episode_index", "frame_index"


def delta_windows(frames: DataFrame, v: str, offsets: list[int]) -> DataFrame:
    """Rows (episode, frame, offset, x, pad): the vector `offset` frames away, clamped at the episode's ends; pad marks clamped ones."""
    sizes = frames.groupBy(E).agg(F.max(FR).alias("last"))
    at = frames.select(E, FR).join(sizes, E).select(E, FR, "last", F.explode(F.array(*map(F.lit, offsets))).alias("offset"))
    at = at.withColumn("target", F.greatest(F.lit(0), F.least("last", F.col(FR) + F.col("offset"))))
    at = at.withColumn("pad", F.col("target") != F.col(FR) + F.col("offset")).drop("last")
    return at.join(frames.select(E, F.col(FR).alias("target"), F.col(v).alias("x")), [E, "target"]).drop("target")


def gather(windows: DataFrame) -> DataFrame:
    """Windows as arrays in the order of offsets."""
    out = windows.groupBy(E, FR).agg(F.sort_array(F.collect_list(F.struct("offset", "x", "pad"))).alias("w"))
    return out.select(E, FR, F.col("w.x").alias("x"), F.col("w.pad").alias("pad"))


def offsets_of(n_obs: int, n_steps: int) -> list[int]:
    return list(range(1 - n_obs, n_steps))


def join_truth(predictions: DataFrame, frames: DataFrame, v: str = "action") -> DataFrame:
    """Rows (episode, frame, h, predicted, actual): a chunk's step h against the frame h later; steps past the end have no actual."""
    p = predictions.select(E, FR, F.posexplode("chunk").alias("h", "predicted")).withColumn("target", F.col(FR) + F.col("h"))
    return p.join(frames.select(E, F.col(FR).alias("target"), F.col(v).alias("actual")), [E, "target"], "left").drop("target")


def per_dim(joined: DataFrame) -> DataFrame:
    pairs = joined.where("actual is not null").select(E, FR, "h", F.posexplode(F.arrays_zip("predicted", "actual")).alias("dim", "p"))
    ok = F.col("p.predicted").isNotNull() & F.col("p.actual").isNotNull() & ~F.isnan("p.predicted") & ~F.isnan("p.actual")
    return pairs.select(E, FR, "h", "dim", (F.col("p.predicted") - F.col("p.actual")).alias("e"), ok.alias("ok")).where("ok").drop("ok")


def chunk_errors(joined: DataFrame) -> DataFrame:
    """Mean absolute and root mean square error for each step and dimension; padded and non-finite ones don't count."""
    return per_dim(joined).groupBy("h", "dim").agg(F.count("*").alias("n"), F.avg(F.abs("e")).alias("mae"), F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"))


def chunk_summary(joined: DataFrame, joints: int, width: int) -> DataFrame:
    """Overall, first action, joints, gripper."""
    d = per_dim(joined)
    part = lambda c: F.avg(F.when(c, F.abs("e")))
    return d.agg(F.avg(F.abs("e")).alias("mae"), F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"), part(F.col("h") == 0).alias("first_mae"), part(F.col("dim") < joints).alias("joint_mae"), part(F.col("dim") == width - 1).alias("gripper_mae"))


def chunk_health(predictions: DataFrame, low: float, high: float) -> DataFrame:
    """Shares of non-finite and of out-of-range components."""
    x = predictions.select(F.explode(F.flatten("chunk")).alias("x"))
    finite = F.col("x").isNotNull() & ~F.isnan("x") & (F.abs("x") != float("inf"))
    return x.agg(F.count("*").alias("n"), (F.count_if(~finite) / F.count("*")).alias("non_finite"), (F.count_if(finite & ~F.col("x").between(low, high)) / F.count("*")).alias("violations"))


def first_action_rows(joined: DataFrame) -> DataFrame:
    return per_dim(joined.where("h = 0")).groupBy(E, FR).agg(F.avg(F.abs("e")).alias("mae"))


def latency_stats(telemetry: DataFrame, column: str) -> DataFrame:
    out = telemetry.agg(F.count(column).alias("n"), F.avg(column).alias("mean"))
    return out.join(F.broadcast(quantiles(telemetry, [], column, {"p95": 0.95})), how="left")  # one row each


def timeline(predictions: DataFrame, stride: int, mode: str) -> DataFrame:
    """Overlay of the chunks of every `stride`-th frame: the mean where they overlap, or only their first `stride` steps (prefix)."""
    p = predictions.where(F.col(FR) % stride == 0).select(E, F.col(FR).alias("start"), F.posexplode("chunk").alias("h", "x"))
    if mode == "prefix":
        p = p.where(F.col("h") < stride)
    p = p.select(E, (F.col("start") + F.col("h")).alias(FR), F.posexplode("x").alias("dim", "y"))
    return p.groupBy(E, FR, "dim").agg(F.avg("y").alias("x"), F.count("*").alias("chunks"))


def sample_frames(frames: DataFrame, stride: int, most: int) -> DataFrame:
    rn = F.row_number().over(Window.partitionBy(E).orderBy(FR))
    return frames.where(F.col(FR) % stride == 0).withColumn("rn", rn).where(F.col("rn") <= most).drop("rn")


def execute_prefix(predictions: DataFrame, k: int) -> DataFrame:
    """The first k steps of each chunk that is planned: every k-th frame."""
    p = predictions.where(F.col(FR) % k == 0).select(E, FR, F.posexplode("chunk").alias("h", "x")).where(F.col("h") < k)
    return p.select(E, (F.col(FR) + F.col("h")).alias("step"), "h", "x")


def delay_steps(latency, hz: float):
    return F.ceil(latency * hz).cast("long")


def merge_chunks(chunks: DataFrame) -> DataFrame:
    """What is executed when chunk requested at step r and ready at step a replaces the queue by its steps from a - r on: the newest ready chunk wins.

    chunks: episode_index, requested, ready, chunk.
    """
    s = chunks.select(E, "requested", "ready", F.posexplode("chunk").alias("h", "x")).withColumn("step", F.col("requested") + F.col("h"))
    return s.where(F.col("step") >= F.col("ready")).groupBy(E, "step").agg(F.max_by("x", F.struct("ready", "requested")).alias("x"))
