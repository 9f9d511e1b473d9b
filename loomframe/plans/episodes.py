"""Queries of episode editing, and the flagship."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import align, clocks
from ..operators import episodes as ep
from .standins import ACTION, BUCKET, COMMAND, HAND, MASTER, STATE, episodes, frames, messages, query, targets

FPS = 10.0


def trims(spark, sf):
    """A trim for two episodes of three, one of five dropped."""
    e = episodes(spark, sf).where("episode_index % 3 <> 0")
    return e.select("episode_index", (F.col("episode_index") % 7).alias("start"), (F.col("n") - F.col("episode_index") % 4 + 1).alias("end"), (F.col("episode_index") % 5 == 0).alias("dropped"))


def trimmed(spark, sf):
    return ep.with_trims(episodes(spark, sf), trims(spark, sf))


_TRIM = """--with trm AS (SELECT episode_index, n, CASE WHEN episode_index % 3 <> 0 THEN least(n, greatest(0, episode_index % 7)) ELSE 0 END AS start,
CASE WHEN episode_index % 3 <> 0 THEN least(n, greatest(0, n - episode_index % 4 + 1)) ELSE n END AS "end", episode_index % 3 <> 0 AND episode_index % 5 = 0 AS dropped FROM eps)"""
_MET = """met AS (SELECT episode_index, frame_index, sqrt(list_sum(list_transform(action, lambda x: x * x))) AS l2, list_avg(list_transform(action, lambda x: abs(x))) AS mean_abs,
coalesce(list_distance(action, lag(action) OVER (PARTITION BY episode_index ORDER BY frame_index)), 0) AS delta_l2 FROM frms)"""
_SUG = """sug AS (SELECT episode_index, coalesce(greatest(0, a - 2), 0) AS s0, coalesce(least(n, z + 3), n) AS s1, a IS NOT NULL AS found FROM (
SELECT episode_index, min(CASE WHEN delta_l2 > 1.3 THEN frame_index END) AS a, max(CASE WHEN delta_l2 > 1.3 THEN frame_index END) AS z, count(*) AS n FROM met GROUP BY 1))"""


@query("""--with s AS (SELECT episode_id, header_us AS s_us, v0, v1 FROM msgs WHERE topic = 'click'), a AS (SELECT episode_id, header_us AS a_us, v0 AS a0 FROM msgs WHERE topic = 'purchase'),
h AS (SELECT episode_id, header_us AS h_us, v0 / 100.0 AS h0 FROM msgs WHERE topic = 'error'), g AS (SELECT episode_id, header_us AS g_us, v0 / 100.0 AS g0 FROM msgs WHERE topic = 'signup'),
e AS (SELECT episode_id, min(m) AS m FROM (SELECT episode_id, topic, max(header_us) AS m FROM msgs GROUP BY 1, 2) GROUP BY 1),
t AS (SELECT tgts.* FROM tgts JOIN e USING (episode_id) WHERE t_us < m),
b AS (SELECT t.*, s.s_us AS p_us, s.v0 AS p FROM t ASOF LEFT JOIN s ON t.episode_id = s.episode_id AND t.t_us >= s.s_us),
n AS (SELECT b.*, s.s_us AS n_us, s.v0 AS n FROM b ASOF LEFT JOIN s ON b.episode_id = s.episode_id AND b.t_us < s.s_us),
x AS (SELECT n.*, a.a0 FROM n ASOF LEFT JOIN a ON n.episode_id = a.episode_id AND n.t_us >= a.a_us),
y AS (SELECT x.*, h.h0 FROM x ASOF LEFT JOIN h ON x.episode_id = h.episode_id AND x.t_us >= h.h_us),
z AS (SELECT y.*, g.g0 FROM y ASOF LEFT JOIN g ON y.episode_id = g.episode_id AND y.t_us >= g.g_us),
f AS (SELECT episode_id, t_us, CASE WHEN n_us IS NULL OR p_us = t_us THEN p ELSE p + (n - p) * ((t_us - p_us) / CAST(n_us - p_us AS DOUBLE)) END AS state, h0 AS hand, a0 AS action, g0 AS command
FROM z WHERE p_us IS NOT NULL AND a0 IS NOT NULL AND h0 IS NOT NULL AND g0 IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY t_us) - 1 AS frame_index FROM f),
r AS (SELECT *, coalesce(abs(action - lag(action) OVER w) > 0.001 OR abs(command - lag(command) OVER w) > 0.1, false) AS raw FROM k WINDOW w AS (PARTITION BY episode_id ORDER BY frame_index)),
q AS (SELECT *, raw OR (coalesce(lag(raw) OVER w, false) AND coalesce(lead(raw) OVER w, false)) AS active FROM r WINDOW w AS (PARTITION BY episode_id ORDER BY frame_index)),
c AS (SELECT episode_id, greatest(0, min(CASE WHEN active THEN frame_index - 1 END) + 1 - 2) AS s0, least(count(*), max(CASE WHEN active THEN frame_index - 1 END) + 4) AS s1 FROM q GROUP BY 1),
d AS (SELECT k.* FROM k JOIN c USING (episode_id) WHERE s1 - s0 >= 2 AND frame_index >= s0 AND frame_index < s1)
SELECT dense_rank() OVER (ORDER BY episode_id) - 1 AS episode_index, row_number() OVER (PARTITION BY episode_id ORDER BY frame_index) - 1 AS frame_index, row_number() OVER (ORDER BY episode_id, frame_index) - 1 AS "index",
round(state, 6) AS state, round(hand, 6) AS hand, round(action, 6) AS action, round(command, 6) AS command FROM d""")
def align_session(spark, sf):
    """Log to frames: master clock, clipped; state interpolated, commands held; assembled, trimmed by commands, numbered."""
    m = clocks.dedup_newest(messages(spark, sf))
    t = clocks.clip_min_end(targets(spark, sf), m)
    b = align.interpolate(align.bracket(t, align.samples(m, STATE), BUCKET)).select("episode_id", "t_us", F.col("value").alias("state"))
    held = align.hold_many(b.where("state is not null"), m, [ACTION, HAND, COMMAND], BUCKET)
    held = held.where(" and ".join(f"{c} is not null" for c in (ACTION, HAND, COMMAND)))
    scaled = held.select(F.col("episode_id").alias("episode_index"), "t_us", F.concat(F.slice("state", 1, 1), F.slice(V.scale_hand(HAND, "claw"), 1, 1)).alias("state"), F.concat(F.slice(ACTION, 1, 1), F.slice(V.scale_hand(COMMAND, "claw"), 1, 1)).alias("action"))
    from pyspark.sql import Window

    f = scaled.withColumn("frame_index", (F.row_number().over(Window.partitionBy("episode_index").orderBy("t_us")) - 1).cast("long"))
    cut = ep.command_trim(f, [0], [1]).where("not reject").select("episode_index", "start", "end", F.lit(False).alias("dropped"))
    out = ep.reindex(ep.kept_frames(f, cut), FPS)
    r = lambda v, i, n: F.round(F.col(v)[i], 6).alias(n)
    return out.select(F.col("new_episode").alias("episode_index"), F.col("new_frame").alias("frame_index"), "index", r("state", 0, "state"), r("state", 1, "hand"), r("action", 0, "action"), r("action", 1, "command"))


@query("SELECT episode_index, count(*) AS n, min(frame_index) AS first_frame, max(frame_index) + 1 AS end_frame, count(*) / 10.0 AS seconds FROM frms GROUP BY 1")
def episode_table(spark, sf):
    return ep.episode_table(frames(spark, sf), FPS)


@query("""SELECT dense_rank() OVER (ORDER BY episode_index) - 1 AS new_episode, row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) - 1 AS new_frame,
row_number() OVER (ORDER BY episode_index, frame_index) - 1 AS "index", round((row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) - 1) / 10.0, 4) AS "timestamp" FROM frms WHERE label <> 3 AND episode_index IN (SELECT episode_index FROM frms GROUP BY 1 HAVING avg(action[1]) > 0)""")
def reindex(spark, sf):
    f = frames(spark, sf)
    kept = f.groupBy("episode_index").agg(F.avg(F.col("action")[0]).alias("m")).where("m > 0")  # the others stand for deleted episodes
    out = ep.reindex(f.where("label <> 3").join(kept, "episode_index", "left_semi"), FPS)
    return out.select("new_episode", "new_frame", "index", F.round(F.col("timestamp").cast("double"), 4).alias("timestamp"))


@query(f"--with {_MET} SELECT episode_index, frame_index, round(l2, 6) AS l2, round(mean_abs, 6) AS mean_abs, round(delta_l2, 6) AS delta_l2 FROM met")
def action_metrics(spark, sf):
    m = ep.action_metrics(frames(spark, sf))
    return m.select("episode_index", "frame_index", *[F.round(c, 6).alias(c) for c in ("l2", "mean_abs", "delta_l2")])


@query(f'--with {_MET}, {_SUG} SELECT episode_index, s0 AS start, s1 AS "end", found FROM sug -- frms')
def suggest_trim(spark, sf):
    return ep.suggest_trim(ep.action_metrics(frames(spark, sf)), "delta_l2", 1.3, 2)


@query("""--with r AS (SELECT episode_index, frame_index, coalesce(greatest(abs(action[1] - lag(action[1]) OVER w), abs(action[2] - lag(action[2]) OVER w)) > 0.28 OR abs(action[16] - lag(action[16]) OVER w) > 0.35, false) AS raw FROM frms WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index)),
q AS (SELECT *, raw OR (coalesce(lag(raw) OVER w, false) AND coalesce(lead(raw) OVER w, false)) AS active FROM r WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index)),
c AS (SELECT episode_index, greatest(0, min(CASE WHEN active THEN frame_index - 1 END) + 1 - 2) AS start, least(count(*), max(CASE WHEN active THEN frame_index - 1 END) + 4) AS "end", min(CASE WHEN active THEN 1 END) AS any_active FROM q GROUP BY 1)
SELECT episode_index, CASE WHEN any_active = 1 THEN start ELSE 0 END AS start, "end", coalesce("end" - start < 2, true) AS reject FROM c""")
def command_trim(spark, sf):
    return ep.command_trim(frames(spark, sf), [0, 1], [15], 0.28, 0.35)


@query(_TRIM + ' SELECT episode_index, n, start, "end", dropped FROM trm -- eps')
def with_trims(spark, sf):
    return trimmed(spark, sf)


_PLAN = f"""{_TRIM}, {_MET}, {_SUG}, pln AS (SELECT t.*, greatest(start, s0) AS a, least("end", s1) AS z, CASE WHEN dropped THEN 'skip' WHEN NOT found THEN 'drop' WHEN greatest(start, s0) >= least("end", s1) THEN 'fallback'
WHEN greatest(start, s0) = start AND least("end", s1) = "end" THEN 'unchanged' ELSE 'trim' END AS action FROM trm t JOIN sug USING (episode_index))"""


@query(_PLAN + """ SELECT episode_index, n, CASE WHEN action = 'trim' THEN a ELSE start END AS start, CASE WHEN action = 'trim' THEN z ELSE "end" END AS "end", dropped OR action = 'drop' AS dropped, action, start AS old_start, "end" AS old_end FROM pln -- eps frms""")
def trim_plan(spark, sf):
    return ep.trim_plan(trimmed(spark, sf), ep.suggest_trim(ep.action_metrics(frames(spark, sf)), "delta_l2", 1.3, 2), inactive="drop")


@query(_PLAN + """, o AS (SELECT CASE WHEN action = 'trim' THEN a ELSE start END AS s, CASE WHEN action = 'trim' THEN z ELSE "end" END AS e, dropped OR action = 'drop' AS d, start AS os, "end" AS oe FROM pln)
SELECT count(*) AS episodes, count(*) FILTER (s <> os OR e <> oe) AS changed, CAST(sum(CASE WHEN d THEN 0 ELSE e - s END) AS BIGINT) AS kept, CAST(sum(oe - os - CASE WHEN d THEN 0 ELSE e - s END) AS BIGINT) AS saved FROM o -- eps frms""")
def plan_summary(spark, sf):
    return ep.plan_summary(trim_plan(spark, sf))


@query(_TRIM + """ SELECT episode_index, n, start, "end", episode_index % 4 <> 0 AS dropped FROM trm -- eps""")
def apply_selection(spark, sf):
    return ep.apply_selection(trimmed(spark, sf), episodes(spark, sf).where("episode_index % 4 = 0"))


@query(_TRIM + """ SELECT episode_index, n, start, "end", dropped OR episode_index % 4 = 1 AS dropped FROM trm -- eps""")
def drop_bad(spark, sf):
    return ep.drop_bad(trimmed(spark, sf), episodes(spark, sf).where("episode_index % 4 = 1"))


@query(_TRIM + """ SELECT episode_index, frame_index FROM frms JOIN trm USING (episode_index) WHERE NOT dropped AND frame_index >= start AND frame_index < "end" -- eps""")
def kept_frames(spark, sf):
    return ep.kept_frames(frames(spark, sf), trimmed(spark, sf)).select("episode_index", "frame_index")


@query(_TRIM + """ SELECT episode_index, (row_number() OVER (ORDER BY episode_index) - 1) // 3 AS grp FROM trm WHERE NOT dropped -- eps""")
def group_episodes(spark, sf):
    return ep.group_episodes(trimmed(spark, sf), 3, regroup=True).select("episode_index", "grp")


@query(_TRIM + """, g AS (SELECT *, (row_number() OVER (ORDER BY episode_index) - 1) // 3 AS grp FROM trm), k AS (SELECT grp, episode_index, frame_index FROM frms JOIN g USING (episode_index) WHERE NOT dropped AND frame_index >= start AND frame_index < "end")
SELECT dense_rank() OVER (ORDER BY grp) - 1 AS output, row_number() OVER (PARTITION BY grp ORDER BY episode_index, frame_index) - 1 AS output_frame, episode_index, frame_index FROM k -- eps""")
def merge_groups(spark, sf):
    out = ep.merge_groups(frames(spark, sf), ep.group_episodes(trimmed(spark, sf), 3))
    return out.select("output", "output_frame", "episode_index", "frame_index")


@query("SELECT episode_index, frame_index FROM frms JOIN eps USING (episode_index) WHERE frame_index < n - 7")
def drop_tail(spark, sf):
    return ep.drop_tail(frames(spark, sf), 7).select("episode_index", "frame_index")


@query(_TRIM + """ SELECT episode_index, n, n / 10.0 AS seconds, CASE WHEN dropped THEN 0 ELSE "end" - start END AS kept, CASE WHEN dropped THEN 0 ELSE "end" - start END / 10.0 AS kept_seconds, dropped FROM trm -- eps""")
def length_table(spark, sf):
    return ep.length_table(trimmed(spark, sf), FPS)


_DOCS = "--with d AS (SELECT doc_id, CAST(n_chars AS DOUBLE) AS x FROM documents)"


@query(_DOCS + """, q AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3, count(*) AS c FROM d)
SELECT doc_id, x, c >= 4 AND q3 > q1 AND (x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS outlier FROM d, q""")
def iqr_outliers(spark, sf):
    return ep.iqr_outliers(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("n_chars").cast("double").alias("x")), "x")


@query(_TRIM + """, g AS (SELECT *, (row_number() OVER (ORDER BY episode_index) - 1) // 3 AS grp FROM trm)
SELECT grp, count(*) AS episodes, CAST(sum(n) AS BIGINT) AS frames, CAST(sum(CASE WHEN dropped THEN 0 ELSE "end" - start END) AS BIGINT) AS kept, sum(CASE WHEN dropped THEN 0 ELSE "end" - start END) / 10.0 AS kept_seconds, count(*) = 3 AS complete, bool_and(dropped) AS all_dropped FROM g GROUP BY grp -- eps""")
def group_lengths(spark, sf):
    return ep.group_lengths(ep.group_episodes(trimmed(spark, sf), 3), 3, FPS)


@query(_DOCS + ", s AS (SELECT unnest([0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]) AS q) SELECT CAST(q AS DOUBLE) AS quantile, round((SELECT quantile_cont(x, [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]) FROM d)[list_position([0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0], q)], 6) AS seconds FROM s")
def duration_summary(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("n_chars").cast("double").alias("x"))
    return ep.duration_summary(d, "x").withColumn("seconds", F.round("seconds", 6))


@query("SELECT episode_id, topic, seq FROM (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY header_us, seq) AS rn FROM msgs) WHERE rn <= 3")
def limit_per_group(spark, sf):
    return ep.limit_per_group(messages(spark, sf), "episode_id", ["header_us", "seq"], 3).select("episode_id", "topic", "seq")
