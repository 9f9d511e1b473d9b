"""Tasks' settings as a table that is joined to the rows, so that one plan serves several tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# fixed values: for each task its hands, their places in the action, the cycles each should make, and the edges an episode needs
TASKS = {
    "task1": {"hands": {"right_gripper": 7}, "expected": [3], "min_events": 6, "topics": ["/sensors_data_raw", "/kuavo_arm_traj", "/leju_claw_state", "/leju_claw_command"]},
    "task2": {"hands": {"left_gripper": 7, "right_gripper": 15}, "expected": [1, 1], "min_events": 4, "topics": ["/sensors_data_raw", "/kuavo_arm_traj", "/leju_claw_state", "/leju_claw_command"]},
    "task3": {"hands": {"right_dexhand": 7}, "expected": [1], "min_events": 2, "topics": ["/sensors_data_raw", "/kuavo_arm_traj", "/dexhand/state", "/control_robot_hand_position"]},
}
# fixed values: the largest median and 99 % age of each kind of topic, in milliseconds
LIMITS = {"arm_state": (20.0, 100.0), "arm_action": (50.0, 150.0), "hand_state": (20.0, 100.0), "hand_action": (50.0, 150.0)}


def hands(spark: SparkSession, tasks: dict = TASKS) -> DataFrame:
    """(task, hand, place, expected, min_events): a row for each hand of each task."""
    rows = [(t, h, p, e, s["min_events"]) for t, s in tasks.items() for (h, p), e in zip(s["hands"].items(), s["expected"])]
    return spark.createDataFrame(rows, "task string, hand string, place int, expected int, min_events int")


def topics(spark: SparkSession, tasks: dict = TASKS) -> DataFrame:
    """(task, topic) that each task's recordings must have."""
    return spark.createDataFrame([(t, x) for t, s in tasks.items() for x in s["topics"]], "task string, topic string")


def limits(spark: SparkSession) -> DataFrame:
    """(kind, p50, p99) of ages."""
    return spark.createDataFrame([(k, *v) for k, v in LIMITS.items()], "kind string, p50 double, p99 double")


def hand_values(frames: DataFrame, presets: DataFrame, v: str = "action") -> DataFrame:
    """A row for each frame and hand of its task, with the hand's value: presets say how many there are and where they stand.

    frames: task, episode_index, frame_index and the vector. Frames of a task without presets give no row.
    """
    return frames.join(F.broadcast(presets), "task").withColumn("value", F.get(v, F.col("place")))


def hand_edges(frames: DataFrame, presets: DataFrame, threshold: float, v: str = "action") -> DataFrame:
    """(task, episode_index, hand, edges, cycles, enough, as_expected): how often each hand crosses the threshold, against its task's settings."""
    w = Window.partitionBy("task", "episode_index", "hand").orderBy("frame_index")
    rows = hand_values(frames, presets, v).withColumn("closed", F.col("value") > threshold)
    rows = rows.withColumn("edge", F.coalesce(F.col("closed") != F.lag("closed").over(w), F.lit(False)))
    out = rows.groupBy("task", "episode_index", "hand", "expected", "min_events").agg(F.count_if("edge").alias("edges"), F.count_if(F.col("edge") & F.col("closed")).alias("cycles"))
    return out.select("task", "episode_index", "hand", "edges", "cycles", (F.col("edges") >= F.col("min_events")).alias("enough"), (F.col("cycles") == F.col("expected")).alias("as_expected"))


def missing_topics(recordings: DataFrame, messages: DataFrame, wanted: DataFrame) -> DataFrame:
    """(task, episode_id, topic) that a task wants and its recording lacks. recordings: episode_id, task."""
    return recordings.join(F.broadcast(wanted), "task").join(messages.select("episode_id", "topic").distinct(), ["episode_id", "topic"], "left_anti").select("task", "episode_id", "topic")
