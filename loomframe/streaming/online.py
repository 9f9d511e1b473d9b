"""The same rules on streams: keyed folds, windows, sessions and manifests of telemetry, logs joined by step.

State is kept for each key and ends by watermarks: a fold's once the watermark has passed its key's last row by IDLE_MS,
windows, sessions and joined steps once no row of theirs can come. Results are appended, each row once; rows later than
the watermark are dropped and counted. Operators with lists, timers and several states are in stateful.py.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import fold
from ..sources.io import scratch
from .stateful import IDLE_MS, LATE

E, FR = "episode_index", "frame_index"
#: The state store of the queries that run_once() starts: state beside the heap, and what transformWithState needs.
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_counted(df: DataFrame, spark: SparkSession, at: str | None = None) -> tuple[DataFrame, dict[str, int]]:
    """Run a stream over what its source has now, into a table in the shared folder: its rows, and counts of it.

    at: a folder that holds the table and the checkpoint; a run that is given one that an earlier run had goes on from there.
    Counts: late, rows that watermarks have dropped; held, rows of state in the end; most, rows of state at most.
    """
    out = at or scratch(spark)
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        q = df.writeStream.format("parquet").option("path", f"{out}/data").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start()
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)
    q.awaitTermination()
    each = [p.stateOperators for p in q.recentProgress if p.stateOperators]
    held = [sum(o.numRowsTotal for o in ops) for ops in each]
    counts = {"late": sum(o.numRowsDroppedByWatermark for ops in each for o in ops), "held": held[-1] if held else 0, "most": max(held, default=0)}
    return spark.read.schema(df.schema).parquet(f"{out}/data"), counts


def run_once(df: DataFrame, spark: SparkSession, at: str | None = None) -> DataFrame:
    """The rows of run_counted()."""
    return run_counted(df, spark, at)[0]


def run_hooked(stream: DataFrame, spark: SparkSession, on_frames: Callable[[DataFrame], DataFrame], on_saved: Callable[[DataFrame, int], None] | None = None, at: str | None = None) -> DataFrame:
    """Batches of a stream given to a hook, saved, and then given to another: the rows that were saved.

    on_frames: a batch's rows -> the rows to save. on_saved: the saved rows and the batch's number, once they are all written;
    it comes again with the same number if the driver dies before the batch is marked as done, so what it does should bear
    that. A batch that is done again replaces what it has saved. at: as in run_counted().
    """
    out = at or scratch(spark)

    def save(batch: DataFrame, n: int) -> None:
        path = f"{out}/data/batch={n}"
        rows = on_frames(batch)
        rows.write.mode("overwrite").parquet(path)
        if on_saved:
            on_saved(batch.sparkSession.read.schema(rows.schema).parquet(path), n)

    stream.writeStream.foreachBatch(save).option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/data").drop("batch")


def keyed(stream: DataFrame, key: str, work: Callable, output: str, state: str, idle_ms: int = IDLE_MS, late: str = LATE) -> DataFrame:
    """work(key, rows of a batch, state row or None) -> (output, new state row) for each key; the state ends idle_ms after a key's last row."""

    def run(k, pdfs: Iterator[pd.DataFrame], held) -> Iterator[pd.DataFrame]:
        if held.hasTimedOut:
            held.remove()
            return
        pdf = pd.concat(pdfs)
        out, new = work(k[0], pdf, held.get if held.exists else None)
        held.update(new)
        held.setTimeoutTimestamp(max(int(pdf["at"].max().timestamp() * 1000), held.getCurrentWatermarkMs()) + idle_ms)
        yield out

    return stream.withWatermark("at", late).groupBy(key).applyInPandasWithState(run, output, state, "append", "EventTimeTimeout")


def fold_stream(stream: DataFrame, v: str, rule: fold.Rule) -> DataFrame:
    """A fold's rule (operators.fold) with its state kept for each episode between batches; a batch's frames go in order."""

    def work(key, pdf, held):
        state = {} if held is None else {n: np.array(x, float) for n, x in zip(fold.FIELDS, held) if x is not None}
        pdf = pdf.sort_values(FR)
        state, out = fold.run(rule, state, pdf[v], pdf[FR])
        return pd.DataFrame({E: key, FR: pdf[FR].to_numpy(), "x": out}), tuple(state[n].tolist() if n in state else None for n in fold.FIELDS)

    return keyed(stream.select(E, FR, "at", v), E, work, f"{E} bigint, {FR} bigint, x array<double>", ", ".join(f"{n} array<double>" for n in fold.FIELDS))


def telemetry_window(stream: DataFrame, ts: str, key: str, value: str, width: str, late: str) -> DataFrame:
    """Counts and means over tumbling windows, each once the watermark has passed its end; rows later than that are dropped."""
    w = stream.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), key)
    return w.agg(F.count("*").alias("n"), F.avg(value).alias("mean")).select(F.unix_micros("w.start").alias("start_us"), key, "n", "mean")


def episode_manifest(stream: DataFrame, ts: str, key: str, value: str, gap: str, late: str) -> DataFrame:
    """One row for each episode of a telemetry log once no row has come for `gap`: rows, first and last time, mean."""
    us = F.unix_micros(ts)
    s = stream.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), key)
    return s.agg(F.count("*").alias("n"), F.min(us).alias("first_us"), F.max(us).alias("last_us"), F.avg(value).alias("mean")).select(key, "n", "first_us", "last_us", "mean")


def sessions(stream: DataFrame, ts: str, key: str, gap: str, late: str) -> DataFrame:
    """Runs of a key's rows without a gap, each once the watermark has passed its end."""
    s = stream.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), key)
    return s.agg(F.count("*").alias("n")).select(F.unix_micros("w.start").alias("start_us"), key, "n")


def join_steps(actions: DataFrame, logs: dict[str, DataFrame], within: str, late: str) -> DataFrame:
    """Logs of one run joined by (episode, step): a row for each action once every log has one for its step.

    Each has episode, step and at, and columns of its own, which keep their names. A row joins those that are at most
    `within` from the action's time; state is kept for that long, and rows later than a side's watermark are dropped.
    """
    out = actions.withWatermark("at", late).withColumnsRenamed({"episode": "a_episode", "step": "a_step", "at": "a_at"})
    for name, log in logs.items():
        e, s, t = f"{name}_episode", f"{name}_step", f"{name}_at"
        log = log.withWatermark("at", late).withColumnsRenamed({"episode": e, "step": s, "at": t})
        near = F.col(t).between(F.col("a_at") - F.expr(f"interval {within}"), F.col("a_at") + F.expr(f"interval {within}"))
        out = out.join(log, (F.col("a_episode") == F.col(e)) & (F.col("a_step") == F.col(s)) & near).drop(e, s, t)
    return out.withColumnsRenamed({"a_episode": "episode", "a_step": "step", "a_at": "at"})


#: Values computed from a topic's payload, by name: (topic, function of its values column).
COMPUTED: dict[str, tuple[str, Callable]] = {}


def register_computed(name: str, topic: str, fn: Callable) -> None:
    COMPUTED[name] = (topic, fn)


def computed(messages: DataFrame, name: str) -> DataFrame:
    topic, fn = COMPUTED[name]
    return messages.where(F.col("topic") == topic).withColumn(name, fn(F.col("values")))
