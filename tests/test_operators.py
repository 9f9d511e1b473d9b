"""Literal vectors, and properties against NumPy on seeded clocks."""

import hashlib
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from loomframe.functions import vectors as V
from loomframe.operators import align, audit, clocks, cycles, episodes, fold, lineage, places, sampling, stats, topics, windows
from loomframe.operators.quantiles import quantiles
from loomframe.sources import io
from loomframe.streaming import online, stateful


def clock_tables(spark, seed, n=60):
    rng = np.random.default_rng(seed)
    t = {e: np.sort(rng.choice(5000, n, replace=False)) for e in (1, 2)}
    s = {e: np.sort(rng.choice(5000, n // 2, replace=False)) for e in (1, 2)}
    v = {e: rng.normal(size=n // 2) for e in (1, 2)}
    targets = spark.createDataFrame([(e, i, int(x)) for e in t for i, x in enumerate(t[e])], "episode_id long, frame_index long, t_us long")
    msgs = spark.createDataFrame([(e, "s", i, int(x), int(x), [float(v[e][i])]) for e in s for i, x in enumerate(s[e])], "episode_id long, topic string, seq long, header_us long, bag_us long, values array<double>")
    return t, s, v, targets, msgs


@pytest.mark.parametrize("bucket", [None, 300])
@pytest.mark.parametrize("seed", [0, 1])
def test_alignment_is_numpys(spark, seed, bucket):
    t, s, v, targets, msgs = clock_tables(spark, seed)
    b = align.bracket(targets, align.samples(msgs, "s"), bucket)
    near = {(r.episode_id, r.t_us): r for r in align.nearest(b).select("episode_id", "t_us", "hit.s_us", "dt_us").collect()}
    line = {(r.episode_id, r.t_us): r.value for r in align.interpolate(b).select("episode_id", "t_us", "value").collect()}
    for e in t:
        for x in t[e]:
            assert near[e, x].s_us == s[e][np.argmin(np.abs(s[e] - x))]
            want = None if x < s[e][0] else np.interp(x, s[e], v[e])
            got = line[e, x]
            assert got is None and want is None or got[0] == pytest.approx(want, abs=1e-12)


def test_ties_take_the_earlier_and_hold_includes_equal(spark):
    targets = spark.createDataFrame([(1, 0, 10), (1, 1, 20)], "episode_id long, frame_index long, t_us long")
    src = spark.createDataFrame([(1, 0, 0, [1.0]), (1, 20, 1, [2.0])], "episode_id long, s_us long, seq long, v array<double>").select("episode_id", "s_us", "seq", F.struct(F.col("v").alias("values")).alias("payload"))
    b = align.bracket(targets, src)
    assert [r.hit.s_us for r in align.nearest(b).orderBy("t_us").collect()] == [0, 20]
    assert [r.age_us for r in align.hold(b).orderBy("t_us").collect()] == [10, 0]
    assert [r.width_us for r in align.bracket_stats(b).orderBy("t_us").collect()] == [20, 0]


def test_empty_inputs(spark):
    _, _, _, targets, msgs = clock_tables(spark, 0)
    none = align.bracket(targets, align.samples(msgs.where("false"), "s"))
    assert align.nearest(none).where("hit is not null").count() == 0
    assert clocks.master_clock(msgs.where("false"), "s").count() == 0


@pytest.mark.parametrize("bucket", [None, 5_000])
def test_alignment_grows_with_the_rows_of_an_episode(spark, bucket):
    """One episode of 200,000 samples: a window that is read anew for every row would take hours."""

    def took(n):
        src = spark.range(n).select(F.lit(1).cast("long").alias("episode_id"), (F.col("id") * 10).alias("s_us"), F.col("id").alias("seq"), F.struct(F.array(F.col("id").cast("double")).alias("values")).alias("payload"))
        targets = spark.range(n // 10).select(F.lit(1).cast("long").alias("episode_id"), F.col("id").alias("frame_index"), (F.col("id") * 100 + 3).alias("t_us"))
        start = time.time()
        out = align.bracket(targets, src, bucket).agg(F.count("*"), F.sum(F.col("t_us") - F.col("before.s_us")), F.sum(F.col("after.s_us") - F.col("t_us"))).first()
        assert tuple(out) == (n // 10, 3 * n // 10, 7 * n // 10)
        return time.time() - start

    took(1_000)
    one, two = took(100_000), took(200_000)
    assert two < 2.5 * one + 4


def test_hold_many_by_buckets_is_that_without(spark):
    _, _, _, targets, msgs = clock_tables(spark, 4)
    msgs = msgs.union(msgs.select("episode_id", F.lit("u"), "seq", F.col("header_us") * 2, "bag_us", "values"))
    plain, dealt = ({str(r) for r in align.hold_many(targets, msgs, ["s", "u"], b).collect()} for b in (None, 200))
    assert plain == dealt


def test_reliable_prefix(spark):
    """Bins of 250 ms by receive time from the camera's first stamp; two stale ones in a row end the prefix."""
    ms = 1000
    cam = [(1, "cam", i, t * ms, t * ms) for i, t in enumerate((1000, 3000))] + [(2, "cam", 0, 0, 0), (2, "cam", 1, 1000 * ms, 1000 * ms), (3, "cam", 0, 5 * ms, 5 * ms), (4, "cam", 0, 0, 0), (4, "cam", 1, 500 * ms, 500 * ms)]
    # receive times of episode 1 in bins 0, 2, 4, 5: ages of 10, 900 (alone), 900 and 900 ms
    state = [(1, "s", i, (t - age) * ms, t * ms) for i, (t, age) in enumerate(((1100, 10), (1600, 900), (2100, 900), (2300, 900)))]
    state += [(2, "s", 0, 100 * ms, 110 * ms)]
    m = spark.createDataFrame(cam + state, "episode_id long, topic string, seq long, header_us long, bag_us long")
    got = {r.episode_id: r.reliable_s for r in clocks.reliable_prefix(m, "s", "cam", 500.0).collect()}
    assert got == {1: 1.0, 2: 1.0, 3: 0.0, 4: 0.0}


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_quantiles_are_numpys(spark, accuracy):
    rng = np.random.default_rng(5)
    rows = [("a", float(v)) for v in rng.integers(0, 40, 700)] + [("b", float(v)) for v in rng.normal(size=333)] + [(None, 2.0), ("c", None)]
    shares = {"q0": 0.0, "q1": 0.01, "q50": 0.5, "q9": 0.9, "q100": 1.0}
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    got = {r.g: [r[n] for n in shares] for r in quantiles(df, ["g"], "x", shares, accuracy).collect()}
    assert set(got) == {"a", "b", None}
    for g in got:
        assert got[g] == pytest.approx(np.quantile([x for k, x in rows if k == g and x is not None], list(shares.values())).tolist())


def test_places_run_over_all_parts(spark):
    f = spark.range(500).select((F.col("id") % 7).alias("episode_index"), F.col("id").alias("frame_index"))
    r = sorted(episodes.ordered(f).collect(), key=lambda x: x.place)
    assert [x.place for x in r] == list(range(1, 501)) and r == sorted(r, key=lambda x: (x.episode_index, x.frame_index))


@pytest.mark.parametrize("parts", [3, 16])
def test_places_of_wide_rows_at_size(spark, parts):
    rows = spark.range(3_000_000).select((F.col("id") % 997).alias("episode_index"), F.xxhash64("id").alias("frame_index"), F.array_repeat(F.col("id").cast("double"), 4).alias("v"))
    got = places.places(rows, [F.col("episode_index"), F.col("frame_index")], parts=parts)
    by_window = F.lag("frame_index").over(Window.partitionBy("episode_index").orderBy("place"))
    first = got.agg(F.count("*"), F.countDistinct("place"), F.min("place"), F.max("place")).first()
    assert tuple(first) == (3_000_000, 3_000_000, 1, 3_000_000)
    assert got.withColumn("before", by_window).where("frame_index < before").count() == 0
    ends = got.groupBy("episode_index").agg(F.min("place").alias("a"), F.max("place").alias("z"), F.count("*").alias("n")).collect()
    assert all(r.z - r.a + 1 == r.n for r in ends) and [r.a for r in sorted(ends)] == sorted(r.a for r in ends)


def test_places_of_ties_repeats_and_nothing(spark):
    rows = spark.createDataFrame([(None, "x")] * 3 + [(1, "y")] * 40 + [(1, None)] * 2, "k int, v string").repartition(6)
    got = sorted(places.places(rows, [F.col("k")], "n").collect(), key=lambda r: r.n)
    assert [r.n for r in got] == list(range(1, 46)) and [r.k for r in got] == [None] * 3 + [1] * 42
    assert places.places(rows.limit(0), [F.col("k")]).count() == 0


def test_noise_is_gaussian_and_does_not_depend_on_partitions(spark):
    f = spark.range(4000).select("id", F.array(F.col("id").cast("double"), F.lit(0.0)).alias("v"))
    noisy = lambda df: {r.id: r.n for r in df.select("id", V.add_noise("v", 0.5, 3).alias("n")).collect()}
    one = noisy(f)
    assert one == noisy(f.repartition(7))
    d = np.array([[x - i, y] for i, (x, y) in one.items()])
    left = (d == 0).all(axis=1)
    assert abs(left.mean() - 0.2) < 0.03 and np.abs(d[~left].mean(axis=0)).max() < 0.05 and np.abs(d[~left].std(axis=0) - 0.5).max() < 0.03


def test_random_sample(spark):
    df = spark.range(300).withColumnRenamed("id", "k")
    a, b = ([r.k for r in sampling.sample_random(x, "k", 40, 9).collect()] for x in (df, df.repartition(6)))
    assert a == b and len(set(a)) == 40 and a != [r.k for r in sampling.sample_random(df, "k", 40, 10).collect()]


def test_dataset_reads_back_and_is_accepted(spark, tmp_path):
    f = spark.createDataFrame([(3, 0, [0.0, 1.0], [1.0]), (3, 1, [2.0, 1.0], [3.0]), (9, 5, [4.0, 4.0], [4.0])], "episode_index long, frame_index long, state array<double>, action array<double>")
    root = str(tmp_path / "set")
    io.write_dataset(episodes.reindex(f, 10.0), root, 10.0, spark.createDataFrame([(0, "pick")], "task_index long, task string"))
    assert io.accept_dataset(io.read_info(spark, root), io.read_frames(spark, root), io.read_tasks(spark, root), {"codebase_version": "v3.0", "fps": 10.0, "width": 1, "state_width": 2, "cameras": ()}).count() == 0
    assert io.read_tasks(spark, root).first().task == "pick"
    s = {r.feature: r for r in io.read_stats(spark, f"{root}/meta/stats.json").collect()}
    assert s["index"]["max"] == [2.0] and s["observation.state"]["mean"] == [2.0, 2.0] and s["action"]["count"] == [3]
    e = io.read_episodes(spark, root).orderBy("episode_index").first()
    assert e["length"] == 2 and e["stats/action/max"] == [3.0] and e["stats/frame_index/mean"] == [0.5]
    assert spark.read.json(f"{root}/meta/info.json").first().splits.train == "0:2"


def test_norm_stats_are_checked_and_read_back(spark, tmp_path):
    s = stats.as_arrays(stats.vector_stats(spark.createDataFrame([([1.0, 2.0],), ([3.0, 5.0],)], "state array<double>"), "state").withColumn("feature", F.lit("state")), ["feature"])
    io.write_norm_stats(s, str(tmp_path / "norm"), {"state": 2}, ["mean", "std"])
    assert io.read_stats(spark, str(tmp_path / "norm")).first()["mean"] == [2.0, 3.5]
    with pytest.raises(ValueError, match="state width:mean"):
        io.write_norm_stats(s, str(tmp_path / "other"), {"state": 3}, ["mean"])


def test_topics_feed_keys_and_are_required(spark):
    m = spark.createDataFrame([(1, "a", [1.0, 2.0]), (1, "b", [3.0]), (1, "x", [4.0])], "episode_id long, topic string, values array<double>")
    b = topics.build(m, {"k1": ("a", lambda v: v), "k2": ("a", lambda v: F.slice(v, 2, 1)), "k3": ("b", V.to_rad)})
    assert {(r.key, tuple(r.vector)) for r in b.collect()} == {("k1", (1.0, 2.0)), ("k2", (2.0,)), ("k3", (np.radians(3.0),))}
    assert topics.require(spark.createDataFrame([([1],), ([],), (None,)], "v array<int>"), ["v"]).count() == 1
    assert spark.range(1).select(topics.path_id(F.lit("/a/b.bag"))).first()[0] == hashlib.sha1(b"/a/b.bag").hexdigest()[:10]


def test_hand_range_regrade_and_trims(spark):
    f = spark.createDataFrame([(1, [9.0, 0.5]), (1, [9.0, 1.04]), (2, [0.0, -0.2]), (3, [float("nan")])], "episode_index long, state array<double>")
    assert {r.episode_index: r.ok for r in audit.hand_range(f, "state", ["episode_index"]).collect()} == {1: True, 2: False, 3: False}
    g = spark.createDataFrame([(1, 5.0, "B"), (2, None, "A")], "e long, m double, grade string")
    assert [r.grade for r in audit.regrade(g, [("A", audit.at_most("m", 9.0))]).orderBy("e").collect()] == ["A", "D"]
    t = spark.createDataFrame([(1, 0, 3), (2, 2, 2), (3, 0, 9), (4, 0, 1)], "e long, start long, end long")
    master = spark.createDataFrame([(1,)] * 3 + [(2,)] * 5 + [(3,)] * 8, "e long")
    assert sorted(r.e for r in lineage.trims_outside(t, master, "e").collect()) == [2, 3, 4]


def run(step, rows):
    return [x.tolist() for x in fold.run(step, {}, rows, range(len(rows)))[1]]


def test_rate_limiter():
    step = lambda s, r, f: fold.limit_step(s, r, [0, 2], [1.0, 0.5])
    assert run(step, [(0, 10, 0), (3, 11, -2), (3, 12, -2), (-3, 13, 2)])[1:] == [[1, 11, -0.5], [2, 12, -1.0], [1, 13, -0.5]]
    second = lambda s, r, f: fold.limit_step(s, r, [0], [10.0], [0.25])
    assert [x[0] for x in run(second, [(0,), (5,), (5,), (-5,)])][1:] == [0.25, 0.75, 1.0]


def test_boundary_blend():
    s, out = {"last": np.array([0.0, 7.0])}, []
    for at, r in [(0, (2, 8)), (1, (4, 9)), (2, (6, 10)), (0, (10, 11)), (1, (12, 12))]:
        s, x = fold.blend_step(s, np.array(r, float), at, 2, [0])
        out.append(x.tolist())
    assert out == [[1, 8], [4, 9], [6, 10], [8, 11], [12, 12]]


def test_combined_pipeline():
    step = fold.compose(lambda f: f % 2, [0], [1.0], 2, [1], 1, [0.0, 0.0])
    assert run(step, [(10, 1), (10, 1), (10, 1)]) == [[1, 1], [2, 1], [3, 1]]


def test_latch():
    step = lambda s, r, f: fold.latch_step(s, r, [0], 3, min_close=2, min_open=1)
    assert [x[0] for x in run(step, [(0.9,), (0.8,), (0.95,)])] == [0, 0, 1]
    assert [x[0] for x in run(step, [(0.9,), (0.8,), (0.5,), (0.9,), (0.8,), (0.9,)])] == [0, 0, 0, 0, 0, 1]
    hold = lambda s, r, f: fold.latch_step(s, r, [0], 2, min_close=4, min_open=1)
    assert [x[0] for x in run(hold, [(0.9,), (0.9,), (0.0,), (0.0,), (0.0,), (0.0,)])] == [0, 1, 1, 1, 1, 0]
    assert fold.latch_step({"initial": np.array([1.0, 7.0, 0.0])}, np.array([0.5, 7.0, 0.5]), [0, 2], 2)[1].tolist() == [1.0, 7.0, 0.0]


def test_folds_carry_their_state_over_batches():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 3))
    for step in (lambda s, r, i: fold.limit_step(s, r, [0, 2], [0.3, 0.2], [0.1, 0.1]), lambda s, r, i: fold.latch_step(s, r, [0, 1], 2, 0.2, -0.2, 3, 1), fold.compose(lambda f: f % 4, [0, 1], [0.2, 0.2], 2, [1], 2, close=0.2, open_=-0.2)):
        whole = fold.run(step, {}, x, range(40))[1]
        state, first = fold.run(step, {}, x[:13], range(13))
        rest = fold.run(step, {n: np.array(state[n].tolist()) for n in fold.FIELDS if n in state}, x[13:], range(13, 40))[1]
        assert set(state) <= set(fold.FIELDS) and np.allclose(whole, first + rest)


def test_mixture_counts_and_stats(spark):
    lengths = spark.createDataFrame([("a", 100, 0.75), ("b", 20, 0.25)], "source string, n long, weight double")
    assert {r.source: r.slots for r in stats.slots(lengths).collect()} == {"a": 100, "b": 34}
    s = spark.createDataFrame([("a", 0, 10, -2.0, 3.0, 0.0, 1.0), ("b", 0, 20, 5.0, 15.0, 10.0, 2.0)], "source string, dim int, count long, min double, max double, mean double, std double")
    w = stats.normalise_weights(spark.createDataFrame([("a", 75.0), ("b", 25.0)], "source string, weight double"))
    r = stats.mixture_stats(s, w, ["dim"]).first()
    assert (r["mean"], r["std"], r["min"], r["max"]) == pytest.approx((2.5, 4.52769257, -2, 15))


def test_merge_chunks_by_delay(spark):
    c = spark.createDataFrame([(0, 0, 0, [0, 1, 2, 3]), (0, 1, 2, [100, 101, 102, 103])], "episode_index long, requested long, ready long, chunk array<int>")
    assert [r.x for r in windows.merge_chunks(c).orderBy("step").limit(3).collect()] == [0, 1, 101]


def test_eef_command_and_contract(spark):
    df = spark.createDataFrame([(0.0, 1.0), (-0.01, 0.5), (0.5, 1.01)], "l double, r double")
    assert [x[0] for x in df.select(V.eef_command("l", "r")).collect()] == [[0.0, 80.0], None, None]
    a = spark.createDataFrame([([1.0] * 8,), ([1.0] * 7,), ([],), (None,), ([float("nan")] * 8,)], "v array<double>")
    assert [x[0] for x in a.select(V.violations("v", 8)).collect()] == [[], ["width"], ["empty", "width"], ["empty"], ["non_finite"]]


def test_delta_windows_clamp_and_pad(spark):
    f = spark.createDataFrame([(0, i, [float(i)]) for i in range(3)], "episode_index long, frame_index long, action array<double>")
    w = windows.gather(windows.delta_windows(f, "action", windows.offsets_of(2, 3))).orderBy("frame_index").collect()
    assert [[x[0] for x in r.x] for r in w] == [[0, 0, 1, 2], [0, 1, 2, 2], [1, 2, 2, 2]]
    assert w[0].pad == [True, False, False, False] and w[2].pad == [False, False, True, True]


def sequential_debounce(x, low, high, n):
    state, out = (None, 0, None), []
    for i, v in enumerate(x):
        state, kind = stateful.debounce_step(state, v, low, high, n)
        if kind:
            out.append((i - n + 1, kind))
    return out


@settings(max_examples=10, deadline=None)
@given(st.lists(st.sampled_from([0.1, 0.5, 0.9]), min_size=1, max_size=40), st.integers(1, 3))
def test_debounce_window_form_is_the_sequential_one(spark, x, n):
    f = spark.createDataFrame([(1, i, v) for i, v in enumerate(x)], "episode_index long, frame_index long, x double")
    got = sorted((r.frame_index, r.kind) for r in cycles.debounce(f, "x", n=n).collect())
    assert got == sequential_debounce(x, 0.3, 0.7, n)


def greedy(values, low, high, n):
    left, out = sorted(values), []
    for j in range(min(n, len(left))):
        t = low + (high - low) * j / (n - 1) if n > 1 else low
        best = min(left, key=lambda kv: (abs(kv[0] - t), kv[1]))
        left.remove(best)
        out.append(best[1])
    return out


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=25), st.integers(1, 12))
def test_uniform_sample_is_the_greedy_one(spark, values, n):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "k long, v double")
    got = [r.k for r in sampling.sample_uniform(df, "k", "v", 0.0, 30.0, n).orderBy("place").collect()]
    chosen = greedy([(float(v), i) for i, v in enumerate(values)], 0.0, 30.0, n)
    assert got == chosen


def test_numbers_run_over_episodes(spark):
    f = spark.createDataFrame([(5, 3, [0.0]), (5, 7, [0.0]), (2, 0, [0.0])], "episode_index long, frame_index long, action array<double>")
    r = episodes.reindex(f, 10.0).orderBy("index").collect()
    assert [(x.new_episode, x.new_frame, x["index"], x.dataset_to_index) for x in r] == [(0, 0, 0, 1), (1, 0, 1, 3), (1, 1, 2, 3)]


def test_snapshot_waits_for_full_buffers():
    buffers = {"a": [(1, 1.0), (5, 2.0)], "b": [(2, 3.0)]}
    assert stateful.snapshot(buffers, {"a": 2, "b": 2}, 10) is None
    assert stateful.snapshot({**buffers, "b": [(2, 3.0), (4, 4.0)]}, {"a": 2, "b": 2}, 1) == (4, {"a": 2.0, "b": 4.0})
    assert stateful.snapshot({"a": [(0, 1.0), (9, 2.0)], "b": [(4, 3.0), (30, 4.0)]}, {"a": 2, "b": 2}, 2)[1] == {"a": 2.0, "b": None}


def test_reasons_have_their_number_as_c_writes_it(spark):
    """By the exact binary value, ties to even: 174683257.35 is a little less than that, 0.25 is a tie."""
    rng = np.random.default_rng(8)
    values = [174683257.35, 112659976.05, 0.25, 0.75, 0.05, 0.0, -0.25, 2.0**60, float("inf"), float("nan"), *(rng.integers(0, 10**12, 300) / 1000), *(rng.integers(0, 10**10, 300) / 20)]
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate([*values])] + [(-1, None)], "i long, m double")
    got = {r.i: r.t_reasons for r in audit.qualify(df, {"t": {"m": -1e9}}).collect()}
    assert got.pop(-1) == ["m_missing"]
    assert got == {i: ["m_%.1f" % x] for i, x in enumerate(values)}
