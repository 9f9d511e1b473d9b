"""Keyed operators with list and value state and timers: look-ahead alignment, snapshots, debounce, chunk queues.

All run on transformWithState, whose state is kept in RocksDB (online.run_once() chooses it for the query it starts). Rows
carry their event time in column at. A key's state ends once the watermark has passed its last row by idle_ms.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

E, FR = "episode_index", "frame_index"
#: How far behind the newest row others may come, and milliseconds after which an idle key's state goes.
LATE, IDLE_MS = "1 minute", 3_600_000


class Keyed(StatefulProcessor):
    """A processor with one timer a key: at the end of its idle time, or earlier where work waits for the watermark."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "ms bigint")
        self.open(handle)

    def seen(self, pdf: pd.DataFrame) -> int:
        """The event time of the key's newest row, these included."""
        ms = int(pdf["at"].max().timestamp() * 1000)
        if self.newest.exists():
            ms = max(ms, self.newest.get()[0])
        self.newest.update((ms,))
        return ms

    def wake(self, ms: int) -> None:
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(rows)
        now = timerValues.getCurrentWatermarkInMs()
        newest = self.seen(pdf)
        out = self.work(key[0], pdf, now)
        self.wake(max(newest + self.idle_ms, now + 1))
        yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.end()
        self.newest.clear()
        yield self.nothing()

    def close(self) -> None:
        pass


def run(stream: DataFrame, key: str, processor: Keyed, output: str, late: str) -> DataFrame:
    return stream.withWatermark("at", late).groupBy(key).transformWithStateInPandas(processor, output, "Append", "EventTime")


# ---- alignment that looks ahead

ALIGNED = "episode_id bigint, t_us bigint, seq bigint, s_us bigint, value array<double>"


def choose(how: str, t: int, before, after):
    """The stamp and value for a target between two samples (stamp, value), as operators.align chooses them: hold, nearest or interpolate."""
    if how == "interpolate":
        if before is None:
            return None, None
        if after is None or before[0] == t:
            return before
        share = (t - before[0]) / (after[0] - before[0])
        return before[0], [a + (c - a) * share for a, c in zip(before[1], after[1])]
    if how == "nearest" and after is not None and (before is None or after[0] - t < t - before[0]):
        return after
    return before or (None, None)


class LookAhead(Keyed):
    """Targets wait in state until no row that can still come would change their sample.

    That is so once the watermark has passed the sample after them; for a nearest sample also once it is as far ahead as the
    sample before is behind, for a held one once it has passed the target. With wait_us a target waits that long at most,
    and then takes what is there, as all do when the key's idle time ends. Samples go once every target that waits or can
    still come has a later one.
    """

    def __init__(self, how: str, topic: str, idle_ms: int, wait_us: int | None):
        super().__init__(idle_ms)
        self.how, self.topic, self.wait_us = how, topic, wait_us

    def open(self, handle) -> None:
        self.samples = handle.getListState("samples", "t bigint, seq bigint, v array<double>")
        self.targets = handle.getListState("targets", "t bigint, seq bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(rows)
        newest = self.seen(pdf)
        mine = pdf["topic"] == self.topic
        samples = [(int(t), int(s), [float(y) for y in v]) for t, s, v in zip(pdf["header_us"][mine], pdf["seq"][mine], pdf["values"][mine])]
        targets = [(int(t), int(s)) for t, s in zip(pdf["header_us"][~mine], pdf["seq"][~mine])]
        yield self.settle(key[0], samples, targets, newest, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self.settle(key[0], [], [], self.newest.get()[0], timerValues.getCurrentWatermarkInMs())

    def settle(self, key, samples: list, targets: list, newest: int, now_ms: int) -> pd.DataFrame:
        now, over = now_ms * 1000, now_ms >= newest + self.idle_ms
        samples = sorted([*(tuple(r) for r in self.samples.get()), *samples] if self.samples.exists() else samples)
        targets = sorted([*(tuple(r) for r in self.targets.get()), *targets] if self.targets.exists() else targets)
        times = np.array([s[0] for s in samples], np.int64)
        out, waiting, wake = [], [], newest + self.idle_ms
        for t, seq in targets:
            i = int(np.searchsorted(times, t, side="right"))
            before = (samples[i - 1][0], list(samples[i - 1][2])) if i else None
            after = (samples[i][0], list(samples[i][2])) if i < len(samples) else None
            if self.how == "hold" or before is not None and before[0] == t or self.how == "interpolate" and before is None:
                ready = t
            elif self.how == "nearest" and before is not None:
                ready = min(2 * t - before[0], after[0] if after else 2 * t - before[0])
            else:
                ready = after[0] if after else None
            if self.wait_us is not None:
                ready = t + self.wait_us if ready is None else min(ready, t + self.wait_us)
            if over or ready is not None and ready <= now:
                # a sample beyond the watermark may yet get one before it
                known = after if after and (over or after[0] <= now) else None
                out.append((key, t, seq, *choose(self.how, t, before, known)))
            else:
                waiting.append((t, seq))
                if ready is not None:
                    wake = min(wake, ceil(ready / 1000) + 1)
        if over:
            for state in (self.samples, self.targets, self.newest):
                state.clear()
        else:
            low = min([now, *(t for t, _ in waiting[:1])])
            first = max(0, int(np.searchsorted(times, low, side="right")) - 1)
            for state, rows in ((self.samples, samples[first:]), (self.targets, waiting)):
                state.put([tuple(r) for r in rows]) if rows else state.clear()
            self.wake(max(wake, now_ms + 1))
        return pd.DataFrame(out, columns=["episode_id", "t_us", "seq", "s_us", "value"]).astype({"s_us": "Int64"})


def asof_stream(stream: DataFrame, master: str, topic: str, how: str, idle_ms: int = IDLE_MS, late: str = LATE, wait_us: int | None = None) -> DataFrame:
    """Align a topic to a master clock on a stream: the rows of operators.align's hold, nearest or interpolate, in any batching.

    stream: episode_id, topic, seq, header_us, values. Rows: episode_id, t_us, seq (the target's), s_us, value. Rows later
    than the watermark are dropped; with all rows in time the result is the batch's. Null values count as no sample.
    """
    rows = stream.where(F.col("topic").isin(master, topic)).where((F.col("topic") == master) | F.col("values").isNotNull())
    rows = rows.select("episode_id", "topic", "seq", "header_us", "values", F.timestamp_micros("header_us").alias("at"))
    return run(rows, "episode_id", LookAhead(how, topic, idle_ms, wait_us), ALIGNED, late)


# ---- snapshots of ring buffers


def snapshot(buffers: dict[str, list[tuple[int, float]]], sizes: dict[str, int], max_dt: int | None, ratio: float = 1.0, reference: tuple[str, ...] | None = None) -> tuple[int, dict[str, float | None]] | None:
    """The least of the reference keys' latest stamps (all keys' unless named), and each key's nearest value to it; None until every buffer is full.

    Only the newest `ratio` of a buffer counts; beyond max_dt a key's value is None, and where all are, max_dt is waived.
    """
    if any(len(buffers.get(k, ())) < n for k, n in sizes.items()):
        return None
    t = min(buffers[k][-1][0] for k in reference or sizes)
    near = {}
    for k, n in sizes.items():
        part = buffers[k][-max(1, int(n * ratio)) :]
        near[k] = min(part, key=lambda s: abs(s[0] - t))
    ok = {k: max_dt is None or abs(s[0] - t) <= max_dt for k, s in near.items()}
    relaxed = not any(ok.values())
    return t, {k: s[1] if ok[k] or relaxed else None for k, s in near.items()}


class Snapshots(Keyed):
    """A list state for each topic, its ring buffer, and the last reference stamp."""

    def __init__(self, sizes: dict[str, int], max_dt: int | None, ratio: float, reference: tuple[str, ...] | None, idle_ms: int):
        super().__init__(idle_ms)
        self.sizes, self.max_dt, self.ratio, self.reference = sizes, max_dt, ratio, reference

    def open(self, handle) -> None:
        self.rings = {k: handle.getListState(f"ring{i}", "t bigint, x double") for i, k in enumerate(self.sizes)}
        self.last = handle.getValueState("last", "t bigint")

    def work(self, key, pdf, now) -> pd.DataFrame:
        buffers = {k: [tuple(r) for r in s.get()] if s.exists() else [] for k, s in self.rings.items()}
        last, out, changed = self.last.get()[0] if self.last.exists() else None, [], set()
        pdf = pdf[pdf["topic"].isin(self.sizes)].sort_values("seq")
        for topic, t_us, x in zip(pdf["topic"], pdf["header_us"], pdf["x"]):
            buffers[topic] = [*buffers[topic], (int(t_us), float(x))][-self.sizes[topic] :]
            changed.add(topic)
            got = snapshot(buffers, self.sizes, self.max_dt, self.ratio, self.reference)
            if got and (last is None or got[0] > last):
                last = got[0]
                out.append((key, last, {k: v for k, v in got[1].items() if v is not None}))
        for k in changed:
            self.rings[k].put(buffers[k])
        if last is not None:
            self.last.update((last,))
        return pd.DataFrame(out, columns=["episode_id", "t_us", "values"])

    def end(self) -> None:
        for s in (*self.rings.values(), self.last):
            s.clear()

    def nothing(self) -> pd.DataFrame:
        return pd.DataFrame([], columns=["episode_id", "t_us", "values"])


def aligned_snapshots(stream: DataFrame, sizes: dict[str, int], max_dt: int | None, ratio: float = 1.0, reference: tuple[str, ...] | None = None, idle_ms: int = IDLE_MS, late: str = LATE) -> DataFrame:
    """Ring buffers of the last `size` samples of each topic, for each episode; a row for each advance of the reference stamp.

    stream: episode_id, topic, seq, header_us, x. Rows: episode_id, t_us, values map. reference: the topics whose latest
    stamps set the reference, all unless named.
    """
    rows = stream.select("episode_id", "topic", "seq", "header_us", "x", F.timestamp_micros("header_us").alias("at"))
    return run(rows, "episode_id", Snapshots(sizes, max_dt, ratio, reference, idle_ms), "episode_id bigint, t_us bigint, values map<string,double>", late)


# ---- debounce


def debounce_step(state: tuple, x: float, low: float, high: float, n: int) -> tuple[tuple, str | None]:
    """Online form of operators.cycles.debounce(): the kind of event that this value confirms. state: (run, its length, confirmed)."""
    was, length, confirmed = state
    obs = 1 if x >= high else 0 if x <= low else None
    length = length + 1 if obs == was and obs is not None else 1
    kind = None
    if obs is not None and length == n:
        if confirmed is not None and obs != confirmed:
            kind = "close" if obs else "open"
        confirmed = obs
    return (obs, length, confirmed), kind


class Debounce(Keyed):
    """One value state: the run, its length and what is confirmed."""

    def __init__(self, value: str, low: float, high: float, n: int, idle_ms: int):
        super().__init__(idle_ms)
        self.value, self.low, self.high, self.n = value, low, high, n

    def open(self, handle) -> None:
        self.state = handle.getValueState("run", "run int, length int, confirmed int")

    def work(self, key, pdf, now) -> pd.DataFrame:
        state, out = tuple(self.state.get()) if self.state.exists() else (None, 0, None), []
        pdf = pdf.sort_values(FR)
        for x, frame in zip(pdf[self.value], pdf[FR]):
            state, kind = debounce_step(state, float(x), self.low, self.high, self.n)
            if kind:
                out.append((key, int(frame) - self.n + 1, kind))
        self.state.update(state)
        return pd.DataFrame(out, columns=[E, FR, "kind"])

    def end(self) -> None:
        self.state.clear()

    def nothing(self) -> pd.DataFrame:
        return pd.DataFrame([], columns=[E, FR, "kind"])


def debounce_stream(stream: DataFrame, value: str, low: float, high: float, n: int, idle_ms: int = IDLE_MS, late: str = LATE) -> DataFrame:
    """Events (episode, frame, kind) as runs are confirmed; the frame is the run's first. Frames follow each other without a hole."""
    return run(stream.select(E, FR, "at", value), E, Debounce(value, low, high, n, idle_ms), f"{E} bigint, {FR} bigint, kind string", late)


# ---- chunks of actions


class Queue:
    """Actions of one chunk, replaced by the part of the next that is still to come when that is ready.

    A chunk is asked for when the queue is empty, or no longer than `threshold`, and none is on its way; the request's
    prefix is the queue's next `prefix` actions. What was executed between request and arrival is cut from the chunk's
    front. Ticks that find no action wait for the chunk. A chunk that nobody asked for is left out; one that is shorter than
    the delay is an error, and leaves the queue as it is.
    """

    def __init__(self, horizon: int, threshold: int, prefix: int, actions=(), count: int = 0, sent: int | None = None, waiting: int = 0):
        self.horizon, self.threshold, self.prefix = horizon, threshold, prefix
        self.actions, self.count, self.sent, self.waiting = [list(a) for a in actions], count, sent, waiting

    def _ask(self, out: list) -> None:
        if self.sent is None and len(self.actions) <= self.threshold:
            self.sent = self.count
            out.append((self.count, "request", [x for a in self.actions[: self.prefix] for x in a], None))

    def _serve(self, out: list) -> None:
        while self.waiting and self.actions:
            self._ask(out)
            out.append((self.count, "action", self.actions.pop(0), None))
            self.count, self.waiting = self.count + 1, self.waiting - 1

    def tick(self, out: list) -> None:
        self.waiting += 1
        if not self.actions:
            self._ask(out)
        self._serve(out)

    def chunk(self, rows: list, out: list) -> None:
        if self.sent is None:
            return
        delay, self.sent = self.count - self.sent, None
        left = rows[: self.horizon][delay:]
        if not left:
            out.append((self.count, "error", None, delay))
            if self.waiting:
                self._ask(out)
            return
        self.actions = [list(map(float, a)) for a in left]
        out.append((self.count, "merge", None, delay))
        self._serve(out)


class ChunkQueue(Keyed):
    """The queue's actions as list state, its counters as value state."""

    def __init__(self, horizon: int, threshold: int, prefix: int, idle_ms: int):
        super().__init__(idle_ms)
        self.rule = (horizon, threshold, prefix)

    def open(self, handle) -> None:
        self.actions = handle.getListState("actions", "a array<double>")
        self.state = handle.getValueState("state", "count bigint, sent bigint, waiting bigint")

    def work(self, key, pdf, now) -> pd.DataFrame:
        q, out = Queue(*self.rule, [r[0] for r in self.actions.get()] if self.actions.exists() else (), *(self.state.get() if self.state.exists() else ())), []
        pdf = pdf.sort_values("seq")
        for width, flat in zip(pdf["width"], pdf["flat"]):
            q.tick(out) if width < 0 else q.chunk(np.reshape(flat, (-1, width)).tolist() if width else [], out)
        self.actions.put([(a,) for a in q.actions]) if q.actions else self.actions.clear()
        self.state.update((q.count, q.sent, q.waiting))
        return pd.DataFrame([(key, *o) for o in out], columns=[E, "step", "kind", "values", "delay"]).astype({"delay": "Int64"})

    def end(self) -> None:
        self.actions.clear()
        self.state.clear()

    def nothing(self) -> pd.DataFrame:
        return pd.DataFrame([], columns=[E, "step", "kind", "values", "delay"])


def chunk_queue(stream: DataFrame, horizon: int, threshold: int, prefix: int, idle_ms: int = IDLE_MS, late: str = LATE) -> DataFrame:
    """Overlapping action chunks as a queue for each episode, which asks for the next chunk while it runs.

    stream: episode_index, seq (order within an episode), at, chunk (array of action vectors; null: a tick that takes an
    action). Rows: episode_index, step (actions before), kind (action, request, merge or error), values (the action, or the
    request's prefix one after the other), delay (actions that ran between request and arrival).
    """
    # flat, with the width of a step: columns of nested lists that are all null crash the reader of Arrow batches
    width = F.when(F.col("chunk").isNull(), -1).otherwise(F.coalesce(F.size(F.get("chunk", F.lit(0))), F.lit(0)))
    rows = stream.select(E, "seq", "at", width.alias("width"), F.coalesce(F.flatten("chunk"), F.array().cast("array<double>")).alias("flat"))
    return run(rows, E, ChunkQueue(horizon, threshold, prefix, idle_ms), f"{E} bigint, step bigint, kind string, values array<double>, delay bigint", late)
