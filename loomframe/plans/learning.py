"""Queries of statistics, mixtures, windows, scores, folds and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import episodes as ep
from ..operators import fold, presets, sampling, stats, windows
from ..sources import io
from .standins import TABLES, elements, frames, messages, query, table

_QS = ", ".join(f"quantile_cont(x, {q}) AS {n}" for n, q in stats.QUANTILES.items())
_EX = "SELECT episode_index % 2 AS half, CAST(generate_subscripts(state, 1) - 1 AS INTEGER) AS dim, unnest(state) AS x FROM frms"
_ROUND = ", ".join(f"round({c}, 6) AS {c}" for c in ("min", "max", "mean", "std", *stats.QUANTILES))
_AGG = f"count(*) AS count, min(x) AS min, max(x) AS max, avg(x) AS mean, stddev_pop(x) AS std, {_QS}"


def rounded(df, keys):
    return df.select(*keys, "count", *[F.round(c, 6).alias(c) for c in ("min", "max", "mean", "std", *stats.QUANTILES)])


@query(f"--with v AS (SELECT dim, {_AGG} FROM ({_EX}) GROUP BY 1) SELECT dim, count, {_ROUND} FROM v")
def vector_stats(spark, sf):
    return rounded(stats.vector_stats(frames(spark, sf), "state"), ["dim"])


def halves(spark, sf):
    return stats.vector_stats(frames(spark, sf).withColumn("half", F.col("episode_index") % 2), "state", ["half"])


_HALF = f"--with h AS (SELECT half, dim, {_AGG} FROM ({_EX}) GROUP BY 1, 2)"


@query(f"{_HALF} SELECT half, dim, count, {_ROUND} FROM h -- frms")
def episode_stats(spark, sf):
    return rounded(halves(spark, sf), ["half", "dim"])


def _mix(w):
    return "min(min) AS min, max(max) AS max, sum({w} * mean) AS mean, sqrt(greatest(sum({w} * (std * std + mean * mean)) - sum({w} * mean) ** 2, 0)) AS std, ".replace("{w}", w) + ", ".join(f"sum({w} * {q}) AS {q}" for q in stats.QUANTILES)


@query(f"{_HALF}, w AS (SELECT *, count / sum(count) OVER (PARTITION BY dim) AS w FROM h), m AS (SELECT dim, CAST(sum(count) AS BIGINT) AS count, {_mix('w')} FROM w GROUP BY 1) SELECT dim, count, {_ROUND} FROM m -- frms")
def merge_stats(spark, sf):
    return rounded(stats.merge_stats(halves(spark, sf), ["dim"]), ["dim"])


@query(f"{_HALF}, w AS (SELECT *, CASE half WHEN 0 THEN 0.75 ELSE 0.25 END AS w FROM h), m AS (SELECT dim, CAST(sum(count) AS BIGINT) AS count, {_mix('w')} FROM w GROUP BY 1) SELECT dim, count, {_ROUND} FROM m -- frms")
def mixture_stats(spark, sf):
    w = table(spark, sf, "region").where("r_regionkey < 2").select(F.col("r_regionkey").cast("long").alias("half"), F.when(F.col("r_regionkey") == 0, 3.0).otherwise(1.0).alias("weight"))
    return rounded(stats.mixture_stats(halves(spark, sf), stats.normalise_weights(w), ["dim"], "half"), ["dim"])


@query(f"--with a AS (SELECT 'action' AS feature, CAST(i % 8 AS INTEGER) AS dim, chunk[i + 1] - state[i % 8 + 1] AS x FROM frms, range(32) r(i) UNION ALL SELECT 'state', CAST(i AS INTEGER), state[i + 1] FROM frms, range(16) r(i)), v AS (SELECT feature, dim, {_AGG} FROM a GROUP BY 1, 2) SELECT feature, dim, count, {_ROUND} FROM v")
def norm_stats(spark, sf):
    chunk = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda h: F.slice("chunk", h * 8 + 1, 8))
    # a step has 8 of the state's 16 dimensions: null beyond them, which no statistic counts
    wide = F.transform(chunk, lambda step: F.concat(step, F.array_repeat(F.lit(None).cast("double"), 8)))
    return rounded(stats.norm_stats(frames(spark, sf).withColumn("chunk", wide), "state", "chunk", True), ["feature", "dim"]).where("count > 0")


@query("""--with d AS (SELECT episode_index, frame_index, i AS dim, action[i + 1] - lag(action[i + 1]) OVER w AS d1 FROM frms, range(16) r(i) WINDOW w AS (PARTITION BY episode_index, i ORDER BY frame_index)),
e AS (SELECT *, d1 - lag(d1) OVER (PARTITION BY episode_index, dim ORDER BY frame_index) AS d2 FROM d) SELECT CAST(dim AS INTEGER) AS dim, round(quantile_cont(abs(d1), 0.99), 6) AS first, round(quantile_cont(abs(d2), 0.99), 6) AS second FROM e GROUP BY 1""")
def rate_limits(spark, sf):
    return stats.rate_limits(frames(spark, sf), 0.99).select("dim", F.round("first", 6).alias("first"), F.round("second", 6).alias("second"))


@query("SELECT dim, count(*) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, round(min(x), 6) AS min, round(median(x), 6) AS median, round(max(x), 6) AS max FROM (SELECT CAST(i AS INTEGER) AS dim, state[i + 1] AS x FROM frms, (VALUES (0), (3)) r(i)) GROUP BY 1")
def describe_dims(spark, sf):
    d = stats.describe_dims(frames(spark, sf), "state", [0, 3])
    return d.select("dim", "count", *[F.round(c, 6).alias(c) for c in ("mean", "std", "min", "median", "max")])


@query("SELECT l_linenumber AS step, l_shipmode AS source, avg(l_discount) AS loss FROM (SELECT *, l_returnflag AS l_shipmode FROM lineitem) GROUP BY 1, 2".replace("avg(l_discount)", "round(avg(l_discount), 6)"))
def loss_by_source(spark, sf):
    log = table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("step"), F.col("l_returnflag").alias("source"), F.col("l_discount").alias("loss"))
    return stats.loss_by_source(log).withColumn("loss", F.round("loss", 6))


@query("--with w AS (SELECT vec_id, CASE WHEN label % 4 = 0 THEN 7 ELSE 16 END AS w FROM embeddings) SELECT vec_id FROM w WHERE w = (SELECT w FROM w GROUP BY w ORDER BY count(*) DESC, w LIMIT 1)")
def majority_width(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("v", F.when(F.col("label") % 4 == 0, F.slice("embedding", 1, 7)).otherwise(F.slice("embedding", 1, 16)))
    return stats.majority_width(e, "v").select("vec_id")


_SRC = """sr AS (SELECT source, count(*) AS n, CAST(substr(source, 4) AS INTEGER) + 1 AS rank FROM documents GROUP BY 1), wt AS (SELECT source, n, rank / CAST(sum(rank) OVER () AS DOUBLE) AS weight FROM sr),
sl AS (SELECT source, n, weight, greatest(1, CAST(round_even(max(ceil(n / weight)) OVER () * weight, 0) AS BIGINT)) AS slots FROM wt)"""


def lengths(spark, sf):
    d = table(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("n"))
    w = d.select("source", "n", (F.substring("source", 4, 9).cast("int") + 1).cast("double").alias("weight"))
    return stats.normalise_weights(w)


@query(f"--with {_SRC} SELECT source, n, round(weight, 6) AS weight, slots FROM sl")
def mixture_slots(spark, sf):
    return stats.slots(lengths(spark, sf)).select("source", "n", F.round("weight", 6).alias("weight"), "slots")


def mixture(spark, sf):
    from pyspark.sql import Window

    d = table(spark, sf, "documents").select("doc_id", "source")
    rows = d.withColumn("local", (F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1).cast("long"))
    return stats.virtual_mixture(rows, lengths(spark, sf))


_VM = f"--with {_SRC}, lc AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS local FROM documents), vm AS (SELECT sl.source, r.slot, r.slot % n AS local FROM sl, LATERAL (SELECT unnest(range(slots)) AS slot) r)"


@query(f"{_VM} SELECT source, local, slot, doc_id FROM vm JOIN lc USING (source, local)")
def virtual_mixture(spark, sf):
    return mixture(spark, sf)


@query(f"{_VM} SELECT source, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS realized FROM vm GROUP BY 1")
def realized_weights(spark, sf):
    return stats.realized_weights(mixture(spark, sf)).withColumn("realized", F.round("realized", 6))


@query("--with s AS (SELECT i, avg(state[i + 1]) AS m, stddev_pop(state[i + 1]) AS d FROM frms, range(16) r(i) GROUP BY 1) SELECT episode_index, frame_index, CAST(i AS INTEGER) AS pos, round(CASE WHEN d > 0 THEN (state[i + 1] - m) / d ELSE 0 END, 6) AS x FROM frms, s")
def normalize(spark, sf):
    f = frames(spark, sf)
    s = stats.as_arrays(stats.vector_stats(f, "state").withColumn("k", F.lit(1)), ["k"]).select("mean", "std")
    return elements(f.join(F.broadcast(s)).withColumn("v", V.normalize("state", {"mean": "mean", "std": "std"}, "mean_std")), ["episode_index", "frame_index"], "v")


@query("SELECT episode_index, frame_index, CAST(i AS INTEGER) AS pos, round(state[i + 1], 6) AS x FROM frms, range(16) r(i)")
def unnormalize(spark, sf):
    f = frames(spark, sf)
    s = stats.as_arrays(stats.vector_stats(f, "state").withColumn("k", F.lit(1)), ["k"]).select("q01", "q99")
    q = {"q01": "q01", "q99": "q99"}
    f = f.join(F.broadcast(s)).withColumn("n", V.normalize("state", q, "quantiles"))
    return elements(f.withColumn("v", V.unnormalize("n", q, "quantiles")), ["episode_index", "frame_index"], "v")


@query("SELECT CASE WHEN i < 7 THEN 'arm' ELSE 'effector' END AS feature, CAST(i % 7 AS INTEGER) AS pos, round(avg(state[i + 1]), 6) AS mean, round(stddev_pop(state[i + 1]), 6) AS std FROM frms, range(8) r(i) GROUP BY i")
def split_stats(spark, sf):
    s = stats.as_arrays(stats.vector_stats(frames(spark, sf), "state").withColumn("k", F.lit(1)), ["k"])
    out = V.split_stats(s, ["mean", "std"], {"arm": (0, 7), "effector": (7, 8)}).select("feature", F.posexplode(F.arrays_zip("mean", "std")).alias("pos", "s"))
    return out.select("feature", "pos", F.round("s.mean", 6).alias("mean"), F.round("s.std", 6).alias("std"))


@query(f"{_VM}, x AS (SELECT CAST(i AS INTEGER) AS dim, CAST(CASE i WHEN 0 THEN n_chars ELSE (doc_id * 7919) % 1000 / 10.0 END AS DOUBLE) AS x FROM vm JOIN lc USING (source, local) JOIN documents USING (doc_id), range(2) r(i)) SELECT dim, {', '.join(f'round(quantile_cont(x, {q}), 6) AS {n}' for n, q in stats.QUANTILES.items())} FROM x GROUP BY 1")
def mixture_quantiles(spark, sf):
    """Exact quantiles of two numbers of the documents over a weighted mixture of their sources, whose rows are not made."""
    from pyspark.sql import Window

    place = (F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1).cast("long")
    v = F.array(F.col("n_chars").cast("double"), (F.col("doc_id") * 7919 % 1000).cast("double") / 10.0)
    rows = table(spark, sf, "documents").select("source", place.alias("local"), v.alias("v"))
    out = stats.mixture_quantiles(rows, lengths(spark, sf), "v")
    return out.select("dim", *[F.round(n, 6).alias(n) for n in stats.QUANTILES])


#: Rank of an estimate among all values, against its share: within the sketches' error, and a row's own width.
@query(f"--with x AS (SELECT CAST(i AS INTEGER) AS dim, state[i + 1] AS x FROM frms, range(16) r(i)), g AS (SELECT dim, count(*) AS count, round(min(x), 6) AS min, round(max(x), 6) AS max, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std FROM x GROUP BY 1) SELECT *, {', '.join(f'count > 0 AS {n}' for n in stats.QUANTILES)} FROM g -- frms")
def merge_sketches(spark, sf):
    """Two datasets of unequal size, merged from their episodes' sketches; quantiles are told by whether their ranks are right."""
    roots = []
    for part in ("episode_index % 3 = 0", "episode_index % 3 > 0"):
        roots.append(io.scratch(spark))
        io.write_dataset(ep.reindex(frames(spark, sf).where(part), 10.0), roots[-1], 10.0)
    merged = io.merged_stats(spark, roots).where("feature = 'observation.state'").drop("feature", "sketch")
    x = frames(spark, sf).select(F.posexplode("state").alias("dim", "x"))
    ranks = x.join(F.broadcast(merged), "dim").groupBy("dim").agg(*[F.count_if(F.col("x") < F.col(n) - 1e-6).alias(f"{n}_low") for n in stats.QUANTILES], *[F.count_if(F.col("x") <= F.col(n) + 1e-6).alias(f"{n}_high") for n in stats.QUANTILES])
    off = lambda n, q: (F.col(f"{n}_low") <= (q + stats.SKETCH_ERROR) * F.col("count") + 1) & (F.col(f"{n}_high") >= (q - stats.SKETCH_ERROR) * F.col("count") - 1)
    return merged.join(ranks, "dim").select("dim", "count", *[F.round(c, 6).alias(c) for c in ("min", "max", "mean", "std")], *[off(n, q).alias(n) for n, q in stats.QUANTILES.items()])


@query("--with t AS (SELECT *, CASE episode_index % 2 WHEN 0 THEN 'task1' ELSE 'task2' END AS task FROM frms), p(task, hand, place, expected, least) AS (VALUES ('task1', 'right_gripper', 7, 3, 6), ('task2', 'left_gripper', 7, 1, 4), ('task2', 'right_gripper', 15, 1, 4)), e AS (SELECT task, episode_index, hand, expected, least, action[place + 1] > 0 AS closed, lag(action[place + 1] > 0) OVER (PARTITION BY task, episode_index, hand ORDER BY frame_index) AS was FROM t JOIN p USING (task)), c AS (SELECT task, episode_index, hand, expected, least, count(*) FILTER (closed <> was) AS edges, count(*) FILTER (closed AND NOT was) AS cycles FROM e GROUP BY ALL) SELECT task, episode_index, hand, edges, cycles, edges >= least AS enough, cycles = expected AS as_expected FROM c -- frms")
def preset_hands(spark, sf):
    """Two tasks with different hands and settings in one plan."""
    f = frames(spark, sf).withColumn("task", F.when(F.col("episode_index") % 2 == 0, "task1").otherwise("task2"))
    return presets.hand_edges(f, presets.hands(spark), 0.0)


# ---- windows and scores

TABLES["pred"] = "pred AS (SELECT episode_index, frame_index, h, d, chunk[h * 8 + d + 1] AS p FROM frms, range(4) a(h), range(8) b(d))"
TABLES["jnd"] = "jnd AS (SELECT p.*, f.action[d + 1] AS a FROM pred p JOIN frms f ON f.episode_index = p.episode_index AND f.frame_index = p.frame_index + h)"


def predictions(spark, sf):
    chunk = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda h: F.slice("chunk", h * 8 + 1, 8))
    return frames(spark, sf).select("episode_index", "frame_index", chunk.alias("chunk"))


def joined(spark, sf):
    f = frames(spark, sf).withColumn("action", F.slice("action", 1, 8))
    return windows.join_truth(predictions(spark, sf), f)


@query("""--with l AS (SELECT episode_index, max(frame_index) AS last FROM frms GROUP BY 1), o AS (SELECT f.episode_index, f.frame_index, CAST(i AS INTEGER) AS "offset", greatest(0, least(last, f.frame_index + i)) AS target FROM frms f JOIN l USING (episode_index), (VALUES (-1), (0), (1), (2)) r(i))
SELECT o.episode_index, o.frame_index, "offset", target <> o.frame_index + "offset" AS pad, CAST(d AS INTEGER) AS pos, round(g.action[d + 1], 6) AS x FROM o JOIN frms g ON g.episode_index = o.episode_index AND g.frame_index = o.target, range(16) e(d)""")
def delta_windows(spark, sf):
    w = windows.delta_windows(frames(spark, sf), "action", windows.offsets_of(2, 3)).withColumnRenamed("x", "v")
    return elements(w, ["episode_index", "frame_index", "offset", "pad"], "v")


@query("SELECT CAST(h AS INTEGER) AS h, CAST(d AS INTEGER) AS dim, count(*) AS n, round(avg(abs(p - a)), 6) AS mae, round(sqrt(avg((p - a) * (p - a))), 6) AS rmse FROM jnd GROUP BY 1, 2 -- pred frms")
def chunk_errors(spark, sf):
    return windows.chunk_errors(joined(spark, sf)).withColumns({c: F.round(c, 6) for c in ("mae", "rmse")})


@query("SELECT round(avg(abs(p - a)), 6) AS mae, round(sqrt(avg((p - a) * (p - a))), 6) AS rmse, round(avg(CASE WHEN h = 0 THEN abs(p - a) END), 6) AS first_mae, round(avg(CASE WHEN d < 7 THEN abs(p - a) END), 6) AS joint_mae, round(avg(CASE WHEN d = 7 THEN abs(p - a) END), 6) AS gripper_mae FROM jnd -- pred frms")
def chunk_summary(spark, sf):
    out = windows.chunk_summary(joined(spark, sf), 7, 8)
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("SELECT count(*) AS n, CAST(count(*) FILTER (NOT isfinite(p)) / count(*) AS DOUBLE) AS non_finite, round(count(*) FILTER (p NOT BETWEEN -0.2 AND 0.2) / count(*), 6) AS violations FROM pred -- frms")
def chunk_health(spark, sf):
    return windows.chunk_health(predictions(spark, sf), -0.2, 0.2).withColumn("violations", F.round("violations", 6))


@query("SELECT episode_index, frame_index, round(avg(abs(p - a)), 6) AS mae FROM jnd WHERE h = 0 GROUP BY 1, 2 -- pred frms")
def first_action_rows(spark, sf):
    return windows.first_action_rows(joined(spark, sf)).withColumn("mae", F.round("mae", 6))


@query("SELECT count(*) AS n, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.95), 6) AS p95 FROM events")
def latency_stats(spark, sf):
    return windows.latency_stats(table(spark, sf, "events"), "value").withColumns({c: F.round(c, 6) for c in ("mean", "p95")})


@query("SELECT episode_index, frame_index + h AS frame_index, CAST(d AS INTEGER) AS dim, round(avg(p), 6) AS x, count(*) AS chunks FROM pred WHERE frame_index % 2 = 0 GROUP BY 1, 2, 3 -- frms")
def timeline_mean(spark, sf):
    return windows.timeline(predictions(spark, sf), 2, "mean").withColumn("x", F.round("x", 6))


@query("SELECT episode_index, frame_index + h AS frame_index, CAST(d AS INTEGER) AS dim, round(avg(p), 6) AS x, count(*) AS chunks FROM pred WHERE frame_index % 2 = 0 AND h < 2 GROUP BY 1, 2, 3 -- frms")
def timeline_prefix(spark, sf):
    return windows.timeline(predictions(spark, sf), 2, "prefix").withColumn("x", F.round("x", 6))


@query("SELECT episode_index, frame_index FROM (SELECT *, row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) AS rn FROM frms WHERE frame_index % 3 = 0) WHERE rn <= 5")
def sample_frames(spark, sf):
    return windows.sample_frames(frames(spark, sf), 3, 5).select("episode_index", "frame_index")


@query("SELECT episode_index, frame_index + h AS step, CAST(h AS INTEGER) AS h, CAST(d AS INTEGER) AS pos, round(p, 6) AS x FROM pred WHERE frame_index % 3 = 0 AND h < 3 -- frms")
def execute_prefix(spark, sf):
    return elements(windows.execute_prefix(predictions(spark, sf), 3).withColumnRenamed("x", "v"), ["episode_index", "step", "h"], "v")


@query("""--with c AS (SELECT episode_index, d, frame_index AS requested, frame_index + 1 + (episode_index + frame_index) % 2 AS ready, h, p FROM pred WHERE frame_index % 2 = 0)
SELECT episode_index, requested + h AS step, CAST(d AS INTEGER) AS pos, round(arg_max(p, ready * 1000000 + requested), 6) AS x FROM c WHERE requested + h >= ready GROUP BY 1, 2, 3 -- pred frms""")
def merge_chunks(spark, sf):
    p = predictions(spark, sf).where("frame_index % 2 = 0")
    p = p.select("episode_index", F.col("frame_index").alias("requested"), (F.col("frame_index") + 1 + (F.col("episode_index") + F.col("frame_index")) % 2).alias("ready"), "chunk")
    return elements(windows.merge_chunks(p).withColumnRenamed("x", "v"), ["episode_index", "step"], "v")


@query("SELECT event_id, CAST(ceil(value / 100.0 * 10) AS BIGINT) AS delay FROM events")
def delay_steps(spark, sf):
    return table(spark, sf, "events").select("event_id", windows.delay_steps(F.col("value") / 100.0, 10.0).alias("delay"))


# ---- folds and samples

DIMS = list(range(16))
LIMIT = lambda s, row, f: fold.limit_step(s, row, DIMS, [0.05] * 16, [0.03] * 16)
LATCH = lambda s, row, f: fold.latch_step(s, row, DIMS, 2, 0.02, -0.02, 3, 2)
BLEND = lambda s, row, f: fold.blend_step(s, row, f % 5, 3, DIMS)
COMPOSED = fold.compose(lambda f: f % 4, DIMS, [0.05] * 16, 2, [7, 15], 2, close=0.02, open_=-0.02)

_ROWS = "recursive rw AS (SELECT episode_index, frame_index, CAST(i AS INTEGER) AS pos, action[i + 1] AS a FROM frms, range(16) r(i))"
_NEXT = "JOIN rw r ON r.episode_index = l.episode_index AND r.pos = l.pos AND r.frame_index = l.frame_index + 1"


def folded(spark, sf, rule):
    return elements(fold.run_batch(frames(spark, sf), "action", rule), ["episode_index", "frame_index"], "x")


@query(f"""--with {_ROWS}, lm AS (SELECT episode_index, frame_index, pos, a AS x, CAST(0 AS DOUBLE) AS d FROM rw WHERE frame_index = 0 UNION ALL
SELECT episode_index, frame_index, pos, x + s, s FROM (SELECT r.episode_index, r.frame_index, r.pos, l.x, l.d + greatest(-0.03, least(0.03, greatest(-0.05, least(0.05, r.a - l.x)) - l.d)) AS s FROM lm l {_NEXT}))
SELECT episode_index, frame_index, pos, round(x, 6) AS x FROM lm -- frms""")
def rate_limit(spark, sf):
    return folded(spark, sf, LIMIT)


_TURN = "CASE WHEN v = 1 THEN {x} <= -0.02 ELSE {x} >= 0.02 END"


@query(f"""--with {_ROWS}, lt AS (SELECT episode_index, CAST(-1 AS BIGINT) AS frame_index, pos, 0 AS v, 0 AS n, 2 AS age FROM rw WHERE frame_index = 0 UNION ALL
SELECT episode_index, frame_index, pos, CASE WHEN turn THEN 1 - v ELSE v END, CASE WHEN turn THEN 0 ELSE n END, CASE WHEN turn THEN 1 ELSE age + 1 END FROM (
SELECT *, n >= 2 AND age >= CASE WHEN v = 1 THEN 3 ELSE 2 END AS turn FROM (SELECT r.episode_index, r.frame_index, r.pos, v, age, CASE WHEN {_TURN.format(x="a")} THEN n + 1 ELSE 0 END AS n FROM lt l {_NEXT})))
SELECT episode_index, frame_index, pos, CAST(v AS DOUBLE) AS x FROM lt WHERE frame_index >= 0 -- frms""")
def latch(spark, sf):
    return folded(spark, sf, LATCH)


@query(f"""--with {_ROWS}, bl AS (SELECT episode_index, frame_index, pos, a AS x, a AS anchor FROM rw WHERE frame_index = 0 UNION ALL
SELECT episode_index, frame_index, pos, CASE WHEN i < 3 THEN (1 - (i + 1) / 3.0) * anchor + (i + 1) / 3.0 * a ELSE a END, anchor FROM (
SELECT r.episode_index, r.frame_index, r.pos, r.a, r.frame_index % 5 AS i, CASE WHEN r.frame_index % 5 = 0 THEN l.x ELSE l.anchor END AS anchor FROM bl l {_NEXT}))
SELECT episode_index, frame_index, pos, round(x, 6) AS x FROM bl -- frms""")
def blend(spark, sf):
    return folded(spark, sf, BLEND)


@query(f"""--with {_ROWS}, pp AS (SELECT episode_index, CAST(-1 AS BIGINT) AS frame_index, pos, a AS final, a AS anchor, a AS lim, 0 AS v, 0 AS n FROM rw WHERE frame_index = 0 UNION ALL
SELECT episode_index, frame_index, pos, CASE WHEN pos IN (7, 15) THEN CASE WHEN turn THEN 1 - v ELSE v END ELSE lim END, anchor, lim, CASE WHEN turn THEN 1 - v ELSE v END, CASE WHEN turn THEN 0 ELSE n END FROM (
SELECT *, n >= 2 AS turn FROM (SELECT * REPLACE (CASE WHEN {_TURN.format(x="lim")} THEN n + 1 ELSE 0 END AS n) FROM (
SELECT * REPLACE (lim + greatest(-0.05, least(0.05, CASE WHEN i < 2 THEN (1 - (i + 1) / 2.0) * anchor + (i + 1) / 2.0 * a ELSE a END - lim)) AS lim) FROM (
SELECT r.episode_index, r.frame_index, r.pos, r.a, r.frame_index % 4 AS i, CASE WHEN r.frame_index % 4 = 0 THEN l.final ELSE l.anchor END AS anchor, l.lim, l.v, l.n FROM pp l {_NEXT})))))
SELECT episode_index, frame_index, pos, round(final, 6) AS x FROM pp WHERE frame_index >= 0 -- frms""")
def postprocess(spark, sf):
    return folded(spark, sf, COMPOSED)


@query()
def sample_random(spark, sf):
    return sampling.sample_random(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 50, 7)


@query()
def sample_uniform(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("n_chars"))
    return sampling.sample_uniform(d, "doc_id", "n_chars", 100.0, 5000.0, 40)


@query()
def sample_groups_uniform(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("n_chars"), F.substring("source", 4, 9).cast("long").alias("grp"))
    return sampling.sample_uniform(d, "doc_id", "n_chars", 100.0, 5000.0, 5, by="grp")


@query("SELECT episode_id, arg_max(topic, header_us * 1000 + seq % 1000) AS topic, max(header_us) AS header_us FROM msgs GROUP BY 1")
def latest(spark, sf):
    m = messages(spark, sf)
    return m.groupBy("episode_id").agg(F.max_by("topic", F.struct("header_us", "seq")).alias("topic"), F.max("header_us").alias("header_us"))


@query("SELECT DISTINCT user_id AS id FROM events")
def distinct_ids(spark, sf):
    return table(spark, sf, "events").select(F.col("user_id").alias("id")).distinct()


@query("SELECT episode_index, frame_index, CAST(i AS INTEGER) AS pos, round(d1, 6) AS d1, round(d1 - lag(d1) OVER (PARTITION BY episode_index, i ORDER BY frame_index), 6) AS d2 FROM (SELECT episode_index, frame_index, i, action[i + 1] - lag(action[i + 1]) OVER (PARTITION BY episode_index, i ORDER BY frame_index) AS d1 FROM frms, range(16) r(i))")
def diffs(spark, sf):
    before = lambda c: F.coalesce(F.lag(c).over(ep.frame_order()), F.array().cast("array<double>"))
    d = frames(spark, sf).withColumn("d1", F.zip_with("action", before("action"), lambda a, b: a - b))
    d = d.withColumn("d2", F.zip_with("d1", before("d1"), lambda a, b: a - b))
    return d.select("episode_index", "frame_index", F.posexplode(F.arrays_zip("d1", "d2")).alias("pos", "d")).select("episode_index", "frame_index", "pos", F.round("d.d1", 6).alias("d1"), F.round("d.d2", 6).alias("d2"))


@query("SELECT 'documents' AS src, doc_id AS id, lang AS tag FROM documents UNION ALL SELECT 'pages', page_id, NULL FROM pages")
def union_sources(spark, sf):
    a = table(spark, sf, "documents").select(F.lit("documents").alias("src"), F.col("doc_id").alias("id"), F.col("lang").alias("tag"))
    return a.unionByName(table(spark, sf, "pages").select(F.lit("pages").alias("src"), F.col("page_id").alias("id")), allowMissingColumns=True)
