"""Lists, mixtures, acceptance, recordings and their quarantine, incremental results; mergeable and weighted quantiles; presets."""

import gzip
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomframe.operators import presets, stats
from loomframe.operators.quantiles import quantiles, weighted_quantiles
from loomframe.sources import io, recordings


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_id_lists(spark):
    ids = lambda *v: sorted(r.id for r in io.parse_id_list(lines(spark, *v)).collect())
    assert ids("3, 17, 28-30", "5－4，9 # last", "", " , ") == [3, 4, 5, 9, 17, 28, 29, 30]
    assert ids("9 - 7") == ids("7-9") == ids("9 -7;8") == [7, 8, 9]
    assert ids("0,1,2,10-12；4") == [0, 1, 2, 4, 10, 11, 12]
    bad = lines(spark, "x5, 2", "3-", "4-5-6", "1.5")
    assert sorted(r.part for r in io.id_list_violations(bad).collect()) == ["1.5", "3-", "4-5-6", "x5"]
    with pytest.raises(Exception, match="not an id or a range"):
        io.parse_id_list(bad).collect()


def spec(*sources):
    return json.dumps([dict(zip(("repo_id", "weight", "name"), s)) for s in sources])


def test_mixtures(spark):
    got = lambda text: [(r.source, r.repo_id, round(r.weight, 9)) for r in io.parse_mixture(lines(spark, text)).collect()]
    assert got(spec(("a/x", 25), ("b/y", 75))) == [("source_01", "a/x", 0.25), ("source_02", "b/y", 0.75)]
    assert got(spec(("a/x", 1, "m"), ("b/y", 3, ""))) == [("m", "a/x", 0.25), ("source_02", "b/y", 0.75)]
    wrong = {spec(("a", 1, "m"), ("b", 3, "m")): "names must be unique", spec(("a", 1), ("b", -1)): "weights must be positive", spec(("a", 0)): "weights must be positive", "[]": "no sources", "{": "no sources", spec(("a", 1), ("b", 1, "source_01")): "names must be unique"}
    for text, reason in wrong.items():
        assert [r.violations for r in io.mixture_specs(lines(spark, text)).collect()] == [[reason]]
        with pytest.raises(Exception, match=reason):
            got(text)


def test_acceptance_tells_each_fault(spark, tmp_path):
    frames = spark.createDataFrame([(e, f, [0.0] * 8, [1.0] * 8) for e in (0, 1) for f in range(3)], "episode_index long, frame_index long, state array<double>, action array<double>")
    from loomframe.operators import episodes

    root = str(tmp_path / "data")
    io.write_dataset(episodes.reindex(frames, 10.0), root, 10.0, cameras={"observation.images.head": [3, 4, 4]})
    good = {"codebase_version": "v3.0", "fps": 10, "width": 8, "cameras": {"observation.images.head"}, "episodes": 2, "frames": 6}
    info, data, tasks = io.read_info(spark, root), io.read_frames(spark, root), io.read_tasks(spark, root)
    faults = lambda i=info, t=tasks, **c: sorted(r.violation for r in io.accept_dataset(i, data, t, good | c).collect())
    assert faults() == []
    assert faults(cameras={"observation.images.wrist"}) == faults(cameras=()) == ["cameras"]
    assert faults(frames=7) == ["frames"] and faults(episodes=3, fps=20) == ["episodes", "fps"] and faults(width=7) == ["width"] and faults(codebase_version="v2.1") == ["version"]
    assert faults(t=tasks.union(tasks)) == ["tasks"] and faults(t=tasks.where("false")) == ["tasks"]
    deep = info.withColumn("features", F.map_concat("features", F.create_map(F.lit("observation.Depth.head"), F.col("features")["action"])))
    assert faults(deep) == ["depth"]


# ---- recordings


def log(spark, n=40):
    return spark.createDataFrame([(e, "ab"[i % 2], i, i * 1000, i * 1000 + 5, [float(i)]) for e in range(6) for i in range(n)], f"episode_id bigint, {recordings.MESSAGE}")


def number(file):
    return int(file.split("episode_id=")[1].split("/")[0])


def test_broken_and_truncated_recordings_are_quarantined(spark, tmp_path):
    root = str(tmp_path / "rec")
    recordings.write_recordings(log(spark), root, broken=(F.col("episode_id") == 1) & F.col("seq").isin(3, 4), cut=(F.col("episode_id") == 2) & (F.col("seq") >= 30))
    path = lambda e: next(os.path.join(f"{root}/episode_id={e}", f) for f in os.listdir(f"{root}/episode_id={e}") if f.startswith("part-"))
    # an archive that ends in the middle, a file that lacks lines, a line of other content, an empty file
    text = open(path(3), "rb").read()
    os.remove(path(3))
    for left in os.listdir(f"{root}/episode_id=3"):
        os.remove(f"{root}/episode_id=3/{left}")
    rng = np.random.default_rng(1)
    noise = b"".join(b'{"topic":"a","seq":%d,"header_us":%d,"bag_us":1,"values":[%f]}\n' % (i, i, x) for i, x in enumerate(rng.normal(size=4000)))
    packed = gzip.compress(noise + b'{"messages":4000}\n')
    with open(f"{root}/episode_id=3/part-0.txt.gz", "wb") as f:
        f.write(packed[: len(packed) * 2 // 3])
    with open(path(4), "rb+") as f:
        kept = f.read().split(b"\n")
        f.seek(0)
        f.write(b"\n".join(kept[:10] + kept[12:]))
        f.truncate()
    for left in os.listdir(f"{root}/episode_id=4"):
        if left.endswith(".crc"):
            os.remove(f"{root}/episode_id=4/{left}")
    assert text
    good, bad = recordings.read_recordings(spark, root)
    counts = {r.episode_id: r["count"] for r in good.groupBy("episode_id").count().collect()}
    assert counts == {0: 40, 1: 38, 5: 40}
    found = sorted((number(r.file), r.reason) for r in bad.collect())
    assert found == [(1, "broken line"), (1, "broken line"), (2, "cut off"), (3, "cut off"), (4, "lines are missing")]
    store, kept = recordings.quarantined(spark, root, str(tmp_path / "out"))
    assert store.count() == 118 and kept.count() == 5


def test_only_asked_topics_files_are_read(spark, tmp_path):
    root = str(tmp_path / "store")
    recordings.write_store(log(spark), root)
    got = recordings.read_store(spark, root, ["a"])
    read = lambda df: {r.file.split("topic=")[1][0] for r in df.select(F.col("topic").alias("t"), F.input_file_name().alias("file")).distinct().collect()}
    assert got.count() == 120 and read(got) == {"a"}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan or "PartitionFilters: [topic" in plan
    wanted = spark.createDataFrame([("b", 1), ("zz", 2)], "topic string, n int").where("n < 10")
    joined = recordings.read_wanted(spark, root, wanted)
    assert joined.count() == 120 and "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString()
    assert read(joined) == {"b"}


def test_refresh_works_on_what_has_changed(spark, tmp_path):
    root, out = str(tmp_path / "rec"), str(tmp_path / "out")
    recordings.write_recordings(log(spark), root)
    seen = []

    def work(m):
        seen.append(sorted(r.episode_id for r in m.select("episode_id").distinct().collect()))
        return m.groupBy("file", "episode_id").agg(F.count("*").alias("n"))

    run = lambda version="1", **p: recordings.refresh(spark, root, out, work, version, {"window": 0.5} | p)
    result = lambda: {r.episode_id: r.n for r in spark.read.parquet(out).collect()}
    assert (run(), run()) == (6, 0) and result() == {e: 40 for e in range(6)}
    fresh = str(tmp_path / "fresh")
    recordings.write_recordings(log(spark, 30).where("episode_id = 4"), fresh)
    recordings.replace(spark, fresh, root)
    assert run() == 1 and seen[-1] == [4] and result() == {e: 30 if e == 4 else 40 for e in range(6)}
    # a run that dies while it writes leaves what was there
    boom = F.udf(lambda e: 1 // (e - 2), "long")
    with pytest.raises(Exception):
        recordings.refresh(spark, root, out, lambda m: m.groupBy("file", "episode_id").agg(F.count("*").alias("n")).withColumn("n", boom("episode_id")), "2", {})
    assert result() == {e: 30 if e == 4 else 40 for e in range(6)}
    assert run("2") == 6 and run("2") == 0 and run("2", window=0.7) == 6


# ---- quantiles


@pytest.mark.parametrize("few", [True, False])
def test_quantiles_with_bounds_sent_or_joined(spark, few):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=3000), np.repeat(0.5, 500)])
    df = spark.createDataFrame([(i % 3, float(v)) for i, v in enumerate(x)], "g int, x double")
    got = {r.g: [r.a, r.b] for r in quantiles(df, ["g"], "x", {"a": 0.1, "b": 0.9}, 100, few).collect()}
    for g in range(3):
        assert got[g] == pytest.approx(np.quantile(x[g::3], [0.1, 0.9]).tolist())
    assert quantiles(df.where("false"), [], "x", {"a": 0.5}).count() == 0


@pytest.mark.parametrize("rounds", [0, 1, 2])
def test_weighted_quantiles_are_those_of_the_copies(spark, rounds):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=400), np.repeat(0.25, 30), [1e6]])
    w = rng.integers(0, 9, len(x))
    df = spark.createDataFrame([(i % 2, float(v), int(k)) for i, (v, k) in enumerate(zip(x, w))] + [(0, None, 5), (1, 3.0, None), (7, 1.0, 1)], "g int, x double, w int")
    got = {r.g: [r[n] for n in stats.QUANTILES] for r in weighted_quantiles(df, ["g"], "x", "w", stats.QUANTILES, rounds).collect()}
    for g in range(2):
        assert got[g] == pytest.approx(np.quantile(np.repeat(x[g::2], w[g::2]), list(stats.QUANTILES.values())).tolist())
    assert got[7] == [1.0] * 5 and weighted_quantiles(df.where("false"), [], "x", "w", {"a": 0.5}).count() == 0


def test_merged_sketches_keep_their_rank_error(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=30_000), rng.exponential(size=3_000) + 5])
    df = spark.createDataFrame([(0 if i < 30_000 else 1, [float(v)]) for i, v in enumerate(x)], "part int, v array<double>").repartition(6)
    parts = stats.vector_stats(df, "v", ["part"], small=True, sketches=True)
    r = stats.merge_sketched(parts, ["dim"]).first()
    assert r["count"] == len(x) and r["mean"] == pytest.approx(x.mean()) and r["std"] == pytest.approx(x.std())
    for name, q in stats.QUANTILES.items():
        assert abs((x <= r[name]).mean() - q) <= stats.SKETCH_ERROR
    # means of the parts' quantiles are far off here
    plain = stats.merge_stats(parts.drop("sketch"), ["dim"]).first()
    assert abs((x <= plain["q90"]).mean() - 0.9) > stats.SKETCH_ERROR


# ---- presets


def test_presets_serve_several_tasks(spark):
    v = lambda left, right: [0.0] * 7 + [left] + [0.0] * 7 + [right]
    frames = spark.createDataFrame([("task1", 1, i, v(float(i % 2), 0.0)) for i in range(7)] + [("task2", 2, i, v(float(i > 2), float(i == 3))) for i in range(6)] + [("other", 3, 0, v(0.0, 0.0))], "task string, episode_index long, frame_index long, action array<double>")
    got = {(r.task, r.hand): (r.edges, r.cycles, r.enough, r.as_expected) for r in presets.hand_edges(frames, presets.hands(spark), 0.5).collect()}
    assert got == {("task1", "right_gripper"): (6, 3, True, True), ("task2", "left_gripper"): (1, 1, False, True), ("task2", "right_gripper"): (2, 1, False, True)}
    messages = spark.createDataFrame([(1, "/sensors_data_raw"), (1, "/kuavo_arm_traj"), (1, "/leju_claw_state")], "episode_id long, topic string")
    missing = presets.missing_topics(spark.createDataFrame([(1, "task1"), (2, "task3")], "episode_id long, task string"), messages, presets.topics(spark)).collect()
    assert {(r.episode_id, r.topic) for r in missing} == {(1, "/leju_claw_command")} | {(2, t) for t in presets.TASKS["task3"]["topics"]}
    assert presets.limits(spark).count() == 4


def test_statistics_are_computed_once_for_the_document(spark, tmp_path):
    """Sums of doubles may differ from one run to the next, here in all their digits; what is checked is what was written."""
    each = F.udf(lambda n: np.random.default_rng().random(n).tolist(), "array<double>").asNondeterministic()
    s = spark.range(2).select(F.concat(F.lit("f"), "id").alias("feature"), F.array(F.lit(7).cast("long"), F.lit(7).cast("long")).alias("count"), each(F.lit(2)).alias("mean"))
    io.write_norm_stats(s, str(tmp_path / "norm"), {"f0": 2, "f1": 2}, ["mean"])
    got = io.read_stats(spark, str(tmp_path / "norm")).orderBy("feature").collect()
    assert [(r.feature, r["count"], len(r["mean"])) for r in got] == [("f0", [7, 7], 2), ("f1", [7, 7], 2)]
