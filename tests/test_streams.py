"""Stateful streams in several batches: against the batch operators, with late rows, and stopped and started again."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomframe.operators import align
from loomframe.sources import io
from loomframe.streaming import online, stateful

LOG = "episode_id long, topic string, seq long, header_us long, values array<double>"
FAR = 10**15


def parts(spark, path, rows, schema):
    """Each list of rows as one file, in order."""
    for part in rows:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def close(topic="s"):
    return [[(-1, topic, 0, FAR, [0.0])], [(-1, topic, 1, FAR + 1, [0.0])]]


def log(seed, n=40):
    """Two episodes in stamps of up to 9 seconds, in the order of time."""
    rng = np.random.default_rng(seed)
    rows = []
    for e in (1, 2):
        t, s = np.sort(rng.integers(0, 9000, n)), np.sort(rng.integers(500, 8000, n // 2))
        rows += [(e, "m", int(i), int(x) * 1000, None) for i, x in enumerate(t)] + [(e, "s", int(i), int(x) * 1000, [float(x), float(i)]) for i, x in enumerate(s)]
    return sorted(rows, key=lambda r: (r[3], r[1] == "m", r[2]))


@pytest.mark.parametrize("how", ["nearest", "interpolate", "hold"])
def test_alignment_looks_ahead_over_batches(spark, tmp_path, how):
    """Batches end anywhere, also between a target and its sample, and rows come up to half a second late."""
    rows = log(3)
    rng = np.random.default_rng(4)
    # up to half a second out of order
    mixed = sorted(rows, key=lambda r: r[3] + int(rng.integers(0, 400_000)))
    cut = [mixed[i : i + 30] for i in range(0, len(mixed), 30)]
    assert len(cut) >= 3
    stream = parts(spark, str(tmp_path / "in"), [*cut, *close()], LOG)
    got, counts = online.run_counted(stateful.asof_stream(stream, "m", "s", how, idle_ms=1000, late="500 milliseconds"), spark)
    df = spark.createDataFrame(rows, LOG)
    b = align.bracket(df.where("topic = 'm'").select("episode_id", "seq", F.col("header_us").alias("t_us")), align.samples(df, "s"))
    want = {"nearest": lambda: align.nearest(b).select("episode_id", "t_us", "seq", F.col("hit.payload.values").alias("value")), "hold": lambda: align.hold(b).select("episode_id", "t_us", "seq", F.col("hit.payload.values").alias("value")), "interpolate": lambda: align.interpolate(b).select("episode_id", "t_us", "seq", "value")}[how]()
    key = lambda r: (r.episode_id, r.t_us, r.seq, tuple(round(x, 6) for x in r.value or ()))
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    # what is left is the closing row's own key
    assert counts["late"] == 0 and counts["held"] <= 4 < counts["most"]


def test_a_target_waits_no_longer_than_it_may(spark, tmp_path):
    rows = [[(1, "s", 0, 500_000, [1.0]), (1, "m", 0, 1_000_000, None)], [(1, "m", 1, 5_000_000, None)], [(1, "m", 2, 9_000_000, None)], [(1, "s", 1, 9_500_000, [2.0])]]
    stream = parts(spark, str(tmp_path / "in"), rows, LOG)
    got = online.run_once(stateful.asof_stream(stream, "m", "s", "interpolate", idle_ms=10**9, late="0 seconds", wait_us=1_000_000), spark).orderBy("t_us").collect()
    assert [(r.t_us, r.value) for r in got] == [(1_000_000, [1.0]), (5_000_000, [1.0])]


def test_snapshots_and_debounce_go_on_after_a_stop(spark, tmp_path):
    """A stream that is stopped half-way and started again from its checkpoint gives what it gives in one go."""
    rng = np.random.default_rng(5)
    rows = [(e, str(rng.choice(["a", "b", "c"])), i, i * 1000 + int(rng.integers(0, 900)), [float(i)]) for i in range(60) for e in (1, 2)]
    cut = [rows[i : i + 30] for i in range(0, 120, 30)]
    make = lambda s: stateful.aligned_snapshots(s.withColumn("x", F.col("values")[0]), {"a": 2, "b": 3, "c": 1}, 20_000, reference=("a", "b"), late="1 minute")
    whole = online.run_once(make(parts(spark, str(tmp_path / "one"), cut, LOG)), spark)
    path, at = str(tmp_path / "two"), str(tmp_path / "run")
    for half in (cut[:2], cut[2:]):
        got = online.run_once(make(parts(spark, path, half, LOG)), spark, at)
    plain = lambda df: sorted((r.episode_id, r.t_us, tuple(sorted(r["values"].items()))) for r in df.collect())
    assert plain(got) == plain(whole) and len(plain(got)) > 20

    frames = [(e, i, float(rng.choice([0.1, 0.5, 0.9])), i) for i in range(40) for e in (1, 2)]
    schema = "episode_index long, frame_index long, x double, s long"
    make = lambda s: stateful.debounce_stream(s.withColumn("at", F.timestamp_seconds("s")), "x", 0.3, 0.7, 2)
    cut = [frames[i : i + 20] for i in range(0, 80, 20)]
    whole = online.run_once(make(parts(spark, str(tmp_path / "d1"), cut, schema)), spark)
    for half in (cut[:2], cut[2:]):
        got = online.run_once(make(parts(spark, str(tmp_path / "d2"), half, schema)), spark, str(tmp_path / "drun"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))
    want = []
    for e in (1, 2):
        state = (None, 0, None)
        for _, i, x, _ in [f for f in frames if f[0] == e]:
            state, kind = stateful.debounce_step(state, x, 0.3, 0.7, 2)
            want += [(e, i - 1, kind)] if kind else []
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_reference_keys_are_the_callers():
    buffers = {"a": [(1, 1.0), (9, 2.0)], "b": [(2, 3.0), (4, 4.0)]}
    sizes = {"a": 2, "b": 2}
    assert stateful.snapshot(buffers, sizes, None)[0] == 4 and stateful.snapshot(buffers, sizes, None, reference=("a",)) == (9, {"a": 2.0, "b": 4.0})


def test_logs_joined_by_step_drop_and_count_late_rows(spark, tmp_path):
    schema = "episode long, step long, s long, x double"
    steps = lambda a, b: [(1, i, i, float(i)) for i in range(a, b)]
    late = [(1, 1, 1, -1.0)]
    end = [[(9, 0, 10_000, 0.0)], [(9, 1, 10_001, 0.0)]]
    make = lambda name, rows: parts(spark, str(tmp_path / name), rows, schema).withColumn("at", F.timestamp_seconds(F.col("s") + 1000)).drop("s").withColumnRenamed("x", name)
    actions = make("action", [steps(0, 20), steps(20, 40), [*steps(40, 60), *late], *end])
    states = make("state", [steps(0, 20), steps(20, 40), [*steps(40, 60), *late], *end])
    # timings lack some steps
    timings = make("timing", [steps(0, 20), steps(25, 40), steps(40, 60), *end])
    got, counts = online.run_counted(online.join_steps(actions, {"state": states, "timing": timings}, "2 seconds", "3 seconds"), spark)
    rows = sorted((r.step, r.action, r.state, r.timing) for r in got.where("episode = 1").collect())
    assert rows == [(i, float(i), float(i), float(i)) for i in range(60) if not 20 <= i < 25]
    assert counts["late"] >= 2 and counts["held"] <= 8 and counts["most"] < 120


def chunk(first):
    return [[float(first + i)] * 8 for i in range(4)]


def test_chunk_queue_replaces_by_delay(spark, tmp_path):
    """The chunk of the second request comes in a later batch than the action that runs meanwhile: 0, 1, 101."""
    schema = "episode_index long, seq long, chunk array<array<double>>"
    rows = [[(7, 0, None), (7, 1, chunk(0)), (7, 2, None)], [(7, 3, chunk(100))], [(7, 4, None), (8, 0, None), (8, 1, None)], [(8, 2, chunk(50))]]
    s = parts(spark, str(tmp_path / "in"), rows, schema).withColumn("at", F.timestamp_seconds(F.col("seq") + 1000))
    out = online.run_once(stateful.chunk_queue(s, 4, 3, 2, late="1 hour"), spark).collect()
    action = lambda e: [r["values"] for r in sorted(out, key=lambda r: r.step) if r.episode_index == e and r.kind == "action"]
    assert action(7) == [[0.0] * 8, [1.0] * 8, [101.0] * 8]
    assert action(8) == [[50.0] * 8, [51.0] * 8]  # ticks that found no action waited
    asked = sorted((r.step, r["values"]) for r in out if r.episode_index == 7 and r.kind == "request")
    assert asked[:2] == [(0, []), (1, [1.0] * 8 + [2.0] * 8)]
    assert sorted((r.step, r.delay) for r in out if r.episode_index == 7 and r.kind == "merge") == [(0, 0), (2, 1)]


def test_chunk_queue_rules():
    q, out = stateful.Queue(2, 1, 1), []
    q.chunk(chunk(9), out)  # nobody asked
    assert out == []
    q.tick(out)
    q.chunk(chunk(0), out)
    q.tick(out)
    assert [o[0] for o in out if o[1] == "action"] == [0, 1] and q.sent == 1 and q.actions == []
    q.chunk([[5.0]], out)  # shorter than the delay
    assert out[-1] == (2, "error", None, 1)
    q.tick(out)
    q.chunk(chunk(20), out)
    assert out[-1][:3] == (2, "action", [20.0] * 8)


def test_settings_of_the_session_stay(spark, tmp_path):
    stream = parts(spark, str(tmp_path / "in"), [[(1, "a", 0, 5, [1.0])]], LOG)
    before = spark.conf.get(online.PROVIDER, None)
    online.run_once(stream.select("seq"), spark)
    assert spark.conf.get(online.PROVIDER, None) == before


def test_telemetry_is_read_as_a_stream(spark, tmp_path):
    io.write_events(spark.createDataFrame([(1, 0, [0.5], 0.1), (1, 1, [0.7], 0.3)], "episode long, step long, action array<double>, infer_time_sec double"), str(tmp_path / "log"))
    got = online.run_once(io.read_telemetry_stream(spark, str(tmp_path / "log")), spark).orderBy("step").collect()
    assert [(r.step, r.action, r.infer_time_sec, r.reward) for r in got] == [(0, [0.5], 0.1, None), (1, [0.7], 0.3, None)]


def test_hooks_on_frames_and_saved_batches(spark, tmp_path):
    """The hook on saved batches sees each batch once it is written; a run that fails in it does that batch again."""
    rows = [[(1, "a", i, i, [float(i)]) for i in range(k, k + 3)] for k in (0, 3, 6)]
    stream = parts(spark, str(tmp_path / "in"), rows, LOG)
    seen, at = [], str(tmp_path / "run")

    def saved(batch, n, fail=False):
        if fail and n == 1:
            raise RuntimeError("stop")
        seen.append((n, sorted(r.x for r in batch.collect())))

    double = lambda b: b.select((F.col("values")[0] * 2).alias("x"))
    with pytest.raises(Exception, match="stop"):
        online.run_hooked(stream, spark, double, lambda b, n: saved(b, n, True), at)
    out = online.run_hooked(stream, spark, double, saved, at)
    assert sorted(r.x for r in out.collect()) == [2.0 * i for i in range(9)]
    assert seen == [(0, [0.0, 2.0, 4.0]), (1, [6.0, 8.0, 10.0]), (2, [12.0, 14.0, 16.0])]
