"""Episodes of frames: tables, numbering, trims, groups, lengths.

frames: episode_index, frame_index, state, action. trims: episode_index, start, end (half open), dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .places import places
from .quantiles import quantiles

E, FR = "episode_index", "frame_index"


def frame_order():
    return Window.partitionBy(E).orderBy(FR)


def ordered(frames: DataFrame, *order: str) -> DataFrame:
    """Frames with their place, from 1, in the order of episode and frame (or other columns)."""
    return places(frames, [F.col(c) for c in order or (E, FR)])


def relative_start(frames: DataFrame) -> DataFrame:
    """State and action less those of the episode's first frame."""
    first = {v: F.zip_with(F.col(v), F.first(v).over(frame_order()), lambda x, y: x - y) for v in ("state", "action")}
    return frames.withColumns(first)


def episode_table(frames: DataFrame, fps: float) -> DataFrame:
    return frames.groupBy(E).agg(F.count("*").alias("n"), F.min(FR).alias("first_frame"), (F.max(FR) + 1).alias("end_frame"), (F.count("*") / fps).alias("seconds"))


def reindex(frames: DataFrame, fps: float) -> DataFrame:
    """Episodes, frames and rows numbered anew. Global numbers come from a running sum over the table of episodes."""
    sizes = frames.groupBy(E).agg(F.count("*").alias("length"))
    # one row an episode: a few bytes for thousands of frames
    w = Window.orderBy(E)
    offsets = sizes.select(E, (F.row_number().over(w) - 1).cast("long").alias("new_episode"), (F.sum("length").over(w) - F.col("length")).alias("dataset_from_index"), "length")
    out = frames.withColumn("new_frame", (F.row_number().over(frame_order()) - 1).cast("long")).join(offsets, E)
    return out.withColumns({"timestamp": (F.col("new_frame") / fps).cast("float"), "index": F.col("dataset_from_index") + F.col("new_frame"), "dataset_to_index": F.col("dataset_from_index") + F.col("length")})


def action_metrics(frames: DataFrame) -> DataFrame:
    """Length and mean size of the action, and length of its change (0 in the first frame and where the width changes)."""
    before = F.lag("action").over(frame_order())
    delta = F.when(F.size(before) == F.size("action"), F.sqrt(F.aggregate(F.zip_with("action", before, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))).otherwise(0.0)
    norm = F.sqrt(F.aggregate("action", F.lit(0.0), lambda s, x: s + x * x))
    return frames.withColumns({"l2": norm, "mean_abs": F.aggregate("action", F.lit(0.0), lambda s, x: s + F.abs(x)) / F.size("action"), "delta_l2": F.coalesce(delta, F.lit(0.0))})


def suggest_trim(metrics: DataFrame, column: str, threshold: float, margin: int) -> DataFrame:
    """First to last active frame with a margin; all frames where none is active."""
    active = F.when(F.col(column) > threshold, F.col(FR))
    out = metrics.groupBy(E).agg(F.min(active).alias("a"), F.max(active).alias("z"), F.count("*").alias("n"))
    return out.select(E, F.coalesce(F.greatest(F.lit(0), F.col("a") - margin), F.lit(0)).cast("long").alias("start"), F.coalesce(F.least("n", F.col("z") + 1 + margin), "n").alias("end"), F.col("a").isNotNull().alias("found"))


def command_trim(frames: DataFrame, joints: list[int], hands: list[int], joint_step: float = 0.001, hand_step: float = 0.1, pre: int = 2, post: int = 2) -> DataFrame:
    """Trim by commands: a step is active if a joint or hand moves enough, or both its neighbours do. Fewer than 2 frames left is a reject."""
    before = F.lag("action").over(frame_order())
    moved = lambda dims, step: F.greatest(*[F.abs(F.col("action")[d] - before[d]) for d in dims]) > step if len(dims) > 1 else F.abs(F.col("action")[dims[0]] - before[dims[0]]) > step
    raw = F.coalesce(moved(joints, joint_step) | moved(hands, hand_step), F.lit(False))
    steps = frames.withColumn("raw", raw).withColumn("step", F.col(FR) - 1)
    ws = Window.partitionBy(E).orderBy(FR)
    bridged = F.col("raw") | (F.coalesce(F.lag("raw").over(ws), F.lit(False)) & F.coalesce(F.lead("raw").over(ws), F.lit(False)))
    steps = steps.withColumn("active", bridged)
    out = steps.groupBy(E).agg(F.min(F.when(F.col("active"), F.col("step"))).alias("a"), F.max(F.when(F.col("active"), F.col("step"))).alias("z"), F.count("*").alias("n"))
    out = out.select(E, F.greatest(F.lit(0), F.col("a") + 1 - pre).cast("long").alias("start"), F.least("n", F.col("z") + 2 + post).alias("end"))
    return out.withColumn("reject", F.coalesce(F.col("end") - F.col("start") < 2, F.lit(True)))


def with_trims(episodes: DataFrame, trims: DataFrame) -> DataFrame:
    """Each episode (E, n) with its trim, clamped to [0, n]; the whole episode where there is none."""
    clamp = lambda c, d: F.least("n", F.greatest(F.lit(0).cast("long"), F.coalesce(c, d)))
    out = episodes.join(trims, E, "left")
    return out.select(E, "n", clamp("start", F.lit(0).cast("long")).alias("start"), clamp("end", "n").alias("end"), F.coalesce("dropped", F.lit(False)).alias("dropped"))


def trim_plan(trimmed: DataFrame, suggested: DataFrame, include_dropped: bool = False, inactive: str = "keep") -> DataFrame:
    """What to do with each episode. Suggestions never widen a trim; without overlap the present trim stays.

    inactive: keep, drop or keep_one for episodes without activity.
    """
    s = suggested.select(E, F.col("start").alias("s0"), F.col("end").alias("s1"), "found")
    a, z = F.greatest("start", "s0"), F.least("end", "s1")
    out = trimmed.join(s, E, "left").withColumns({"a": a, "z": z})
    action = F.when(F.col("dropped") & F.lit(not include_dropped), "skip").when(~F.coalesce("found", F.lit(False)), {"keep": "keep", "drop": "drop", "keep_one": "keep_one"}[inactive]).when(F.col("a") >= F.col("z"), "fallback").when((F.col("a") == F.col("start")) & (F.col("z") == F.col("end")), "unchanged").otherwise("trim")
    out = out.withColumn("action", action)
    start = F.when(F.col("action") == "trim", F.col("a")).otherwise(F.col("start"))
    end = F.when(F.col("action") == "trim", F.col("z")).when(F.col("action") == "keep_one", F.least("end", F.col("start") + 1)).otherwise(F.col("end"))
    return out.select(E, "n", start.alias("start"), end.alias("end"), (F.col("dropped") | (F.col("action") == "drop")).alias("dropped"), "action", F.col("start").alias("old_start"), F.col("end").alias("old_end"))


def plan_summary(plan: DataFrame) -> DataFrame:
    kept = F.when(F.col("dropped"), 0).otherwise(F.col("end") - F.col("start"))
    old = F.col("old_end") - F.col("old_start")
    return plan.agg(F.count("*").alias("episodes"), F.count_if((F.col("start") != F.col("old_start")) | (F.col("end") != F.col("old_end"))).alias("changed"), F.sum(kept).alias("kept"), F.sum(old - kept).alias("saved"))


def apply_selection(trims: DataFrame, ids: DataFrame, drop_rest: bool = True) -> DataFrame:
    """Chosen episodes lose their drop mark; the rest gets one if drop_rest."""
    out = trims.join(ids.select(E).distinct().withColumn("chosen", F.lit(True)), E, "left")
    return out.withColumn("dropped", F.when(F.col("chosen"), False).when(F.lit(drop_rest), True).otherwise(F.col("dropped"))).drop("chosen")


def drop_bad(trims: DataFrame, bad: DataFrame) -> DataFrame:
    out = trims.join(bad.select(E).distinct().withColumn("bad", F.lit(True)), E, "left")
    return out.withColumn("dropped", F.col("dropped") | F.coalesce("bad", F.lit(False))).drop("bad")


def kept_frames(frames: DataFrame, trimmed: DataFrame) -> DataFrame:
    """Frames inside the trims of episodes that aren't dropped."""
    t = trimmed.where("not dropped").select(E, "start", "end")
    return frames.join(t, E).where((F.col(FR) >= F.col("start")) & (F.col(FR) < F.col("end"))).drop("start", "end")


def group_episodes(episodes: DataFrame, k: int, regroup: bool = False) -> DataFrame:
    """Groups of k neighbouring episodes; with regroup, dropped ones leave before groups are formed."""
    e = episodes.where("not dropped") if regroup else episodes
    return e.withColumn("grp", F.floor((F.row_number().over(Window.orderBy(E)) - 1) / k))


def merge_groups(frames: DataFrame, grouped: DataFrame) -> DataFrame:
    """Groups become episodes, in the order of source episode and frame; empty groups go and survivors are numbered."""
    kept = kept_frames(frames, grouped).join(grouped.select(E, "grp"), E)
    numbers = kept.select("grp").distinct().withColumn("output", (F.row_number().over(Window.orderBy("grp")) - 1).cast("long"))
    w = Window.partitionBy("grp").orderBy(E, FR)
    return kept.withColumn("output_frame", (F.row_number().over(w) - 1).cast("long")).join(numbers, "grp")


def drop_tail(frames: DataFrame, n: int) -> DataFrame:
    sizes = frames.groupBy(E).agg(F.count("*").alias("length"))
    return frames.join(sizes, E).where(F.col(FR) < F.col("length") - n).drop("length")


def length_table(trimmed: DataFrame, fps: float) -> DataFrame:
    kept = F.when(F.col("dropped"), 0).otherwise(F.col("end") - F.col("start")).cast("long")
    return trimmed.select(E, "n", (F.col("n") / fps).alias("seconds"), kept.alias("kept"), (kept / fps).alias("kept_seconds"), "dropped")


def iqr_outliers(df: DataFrame, column: str, k: float = 1.5) -> DataFrame:
    """Marks values outside the quartiles by k ranges, given 4 finite values and a range above 0."""
    finite = df.where(F.col(column).isNotNull() & ~F.isnan(column))
    q = finite.agg(F.count("*").alias("c")).join(F.broadcast(quantiles(finite, [], column, {"q1": 0.25, "q3": 0.75})), how="left")  # one row each
    r = F.col("q3") - F.col("q1")
    flag = (F.col("c") >= 4) & (r > 0) & ((F.col(column) < F.col("q1") - k * r) | (F.col(column) > F.col("q3") + k * r))
    return df.join(F.broadcast(q)).withColumn("outlier", F.coalesce(flag, F.lit(False))).drop("q1", "q3", "c")


def group_lengths(grouped: DataFrame, k: int, fps: float) -> DataFrame:
    kept = F.when(F.col("dropped"), 0).otherwise(F.col("end") - F.col("start"))
    return grouped.groupBy("grp").agg(F.count("*").alias("episodes"), F.sum("n").alias("frames"), F.sum(kept).alias("kept"), (F.sum(kept) / fps).alias("kept_seconds"), (F.count("*") == k).alias("complete"), F.bool_and("dropped").alias("all_dropped"))


def duration_summary(df: DataFrame, column: str) -> DataFrame:
    shares = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    out = quantiles(df, [], column, {f"q{i}": x for i, x in enumerate(shares)})
    return out.select(F.inline(F.array(*[F.struct(F.lit(x).alias("quantile"), F.col(f"q{i}").alias("seconds")) for i, x in enumerate(shares)])))


def limit_per_group(df: DataFrame, key: str, order: list, n: int) -> DataFrame:
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(f"rn <= {n}").drop("rn")
