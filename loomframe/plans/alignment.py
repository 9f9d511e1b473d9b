"""Queries of clocks, alignment and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import align, clocks, topics
from .standins import ACTION, BUCKET, COMMAND, HAND, MASTER, STATE, elements, frames, messages, query, table, targets

HZ = 0.00002  # the stand-in logs are sparse: a rate at which some of their steps are gaps


@query("SELECT episode_id, topic, seq, header_us FROM msgs WHERE topic IN ('click', 'purchase')")
def scan_topics(spark, sf):
    return clocks.scan_topics(messages(spark, sf), [STATE, ACTION]).select("episode_id", "topic", "seq", "header_us")


@query("SELECT episode_id, topic, seq FROM msgs WHERE topic = 'click' AND header_us BETWEEN 1704100000000000 AND 1705000000000000")
def scan_range(spark, sf):
    return clocks.scan_topics(messages(spark, sf), [STATE], 1704100000000000, 1705000000000000).select("episode_id", "topic", "seq")


@query("SELECT topic, count(*) AS n, min(header_us) AS first_us, max(bag_us) AS last_us FROM msgs GROUP BY topic")
def scan_clock(spark, sf):
    return clocks.scan_clock(messages(spark, sf)).groupBy("topic").agg(F.count("*").alias("n"), F.min("header_us").alias("first_us"), F.max("bag_us").alias("last_us"))


@query("SELECT episode_id, seq FROM msgs WHERE isfinite(v0) AND isfinite(v1)")
def valid_payload(spark, sf):
    return messages(spark, sf).where(V.is_valid("values", 2)).select("episode_id", "seq")


@query("""--with r AS (SELECT episode_id, header_us AS t_us, row_number() OVER (PARTITION BY episode_id ORDER BY header_us, seq) - 1 AS rn, count(*) OVER (PARTITION BY episode_id) AS n FROM msgs WHERE topic = 'view')
SELECT episode_id, CAST((rn - 2) / 3 AS BIGINT) AS frame_index, t_us FROM r WHERE rn >= 2 AND rn < n - 2 AND (rn - 2) % 3 = 0""")
def downsample(spark, sf):
    return clocks.master_clock(messages(spark, sf), MASTER, 2, 3)


@query("""--with e AS (SELECT episode_id, min(m) AS m FROM (SELECT episode_id, topic, max(header_us) AS m FROM msgs GROUP BY 1, 2) GROUP BY 1)
SELECT episode_id, frame_index, t_us FROM tgts JOIN e USING (episode_id) WHERE t_us < m""")
def clip_min_end(spark, sf):
    return clocks.clip_min_end(targets(spark, sf), messages(spark, sf))


@query("SELECT episode_id, topic, max(seq) AS seq, header_us FROM msgs GROUP BY episode_id, topic, header_us")
def dedup_newest(spark, sf):
    return clocks.dedup_newest(messages(spark, sf)).select("episode_id", "topic", "seq", "header_us")


@query("SELECT DISTINCT episode_id, topic, header_us FROM msgs")
def distinct_stamps(spark, sf):
    return clocks.distinct_stamps(messages(spark, sf))


_NEAREST = """--with s AS (SELECT episode_id, header_us AS s_us, v0 FROM msgs WHERE topic = 'click'),
b AS (SELECT t.episode_id, t.frame_index, t.t_us, s.s_us AS p_us, s.v0 AS p FROM tgts t ASOF LEFT JOIN s ON t.episode_id = s.episode_id AND t.t_us >= s.s_us),
n AS (SELECT b.*, s.s_us AS n_us, s.v0 AS n FROM b ASOF LEFT JOIN s ON b.episode_id = s.episode_id AND b.t_us < s.s_us)
"""


@query(_NEAREST + """SELECT episode_id, frame_index, CASE WHEN p_us IS NULL OR n_us - t_us < t_us - p_us THEN coalesce(n, p) ELSE p END AS v,
CASE WHEN p_us IS NULL OR n_us - t_us < t_us - p_us THEN coalesce(n_us - t_us, t_us - p_us) ELSE t_us - p_us END AS dt_us FROM n""")
def asof_nearest(spark, sf):
    b = align.nearest(align.bracket(targets(spark, sf), align.samples(messages(spark, sf), STATE), BUCKET))
    return b.select("episode_id", "frame_index", F.col("hit.payload.values")[0].alias("v"), "dt_us")


@query(_NEAREST + """SELECT episode_id, frame_index, CASE WHEN least(n_us - t_us, t_us - p_us) <= 20000000000 THEN CASE WHEN p_us IS NULL OR n_us - t_us < t_us - p_us THEN n ELSE p END END AS v FROM n""")
def asof_tolerance(spark, sf):
    b = align.nearest(align.bracket(targets(spark, sf), align.samples(messages(spark, sf), STATE), BUCKET), 20_000_000_000)
    return b.select("episode_id", "frame_index", F.col("hit.payload.values")[0].alias("v"))


@query(_NEAREST + "SELECT episode_id, frame_index, p AS v, t_us - p_us AS age_us FROM n")
def asof_hold(spark, sf):
    b = align.hold(align.bracket(targets(spark, sf), align.samples(messages(spark, sf), STATE), BUCKET))
    return b.select("episode_id", "frame_index", F.col("hit.payload.values")[0].alias("v"), "age_us")


@query(_NEAREST + "SELECT episode_id, frame_index, round(CASE WHEN p_us IS NULL THEN NULL WHEN n_us IS NULL OR p_us = t_us THEN p ELSE p + (n - p) * ((t_us - p_us) / CAST(n_us - p_us AS DOUBLE)) END, 6) AS v FROM n")
def asof_interp(spark, sf):
    b = align.interpolate(align.bracket(targets(spark, sf), align.samples(messages(spark, sf), STATE), BUCKET))
    return b.select("episode_id", "frame_index", F.round(F.col("value")[0], 6).alias("v"))


@query(_NEAREST + "SELECT episode_id, frame_index, (CASE WHEN p_us = t_us THEN p_us ELSE n_us END) - p_us AS width_us, least(t_us - p_us, (CASE WHEN p_us = t_us THEN p_us ELSE n_us END) - t_us) AS nearest_us FROM n")
def asof_bracket(spark, sf):
    b = align.bracket_stats(align.bracket(targets(spark, sf), align.samples(messages(spark, sf), STATE), BUCKET))
    return b.select("episode_id", "frame_index", "width_us", "nearest_us")


_GAP = "75000000000"


@query(f"""SELECT episode_id, gap_start, gap_end FROM (SELECT episode_id, lag(header_us) OVER (PARTITION BY episode_id ORDER BY header_us, seq) AS gap_start, header_us AS gap_end FROM msgs WHERE topic = 'click')
WHERE gap_end - gap_start > {_GAP}""")
def clock_gaps(spark, sf):
    return clocks.find_gaps(messages(spark, sf), STATE, HZ)


@query(_NEAREST + f"""SELECT episode_id, frame_index, CASE WHEN p_us < t_us AND n_us - p_us > {_GAP} THEN 999.0 WHEN p_us IS NULL OR n_us - t_us < t_us - p_us THEN coalesce(n, p) ELSE p END AS v FROM n""")
def gap_sentinel(spark, sf):
    b = align.fill_gaps(align.bracket(targets(spark, sf), align.samples(messages(spark, sf), STATE), BUCKET), HZ, 2)
    return b.select("episode_id", "frame_index", F.col("value")[0].alias("v"))


@query("""--with t AS (SELECT episode_id, seq, bag_us AS t_us, header_us FROM msgs WHERE topic = 'view'), s AS (SELECT episode_id, bag_us AS s_us, header_us AS h_us FROM msgs WHERE topic = 'click'),
b AS (SELECT t.*, s.s_us AS p_us, s.h_us AS p FROM t ASOF LEFT JOIN s ON t.episode_id = s.episode_id AND t.t_us >= s.s_us),
n AS (SELECT b.*, s.s_us AS n_us, s.h_us AS n FROM b ASOF LEFT JOIN s ON b.episode_id = s.episode_id AND b.t_us < s.s_us)
SELECT episode_id, seq, abs((CASE WHEN p_us IS NULL OR n_us - t_us < t_us - p_us THEN coalesce(n, p) ELSE p END) - header_us) AS error_us FROM n""")
def direct_error(spark, sf):
    m = messages(spark, sf)
    t = m.where(F.col("topic") == MASTER).select("episode_id", "seq", F.col("bag_us").alias("t_us"), "header_us")
    return align.direct_error(t, m, STATE, BUCKET).select("episode_id", "seq", "error_us")


@query("""--with d AS (SELECT episode_id, CAST(median(bag_us - header_us) AS BIGINT) AS delay_us FROM msgs GROUP BY 1), t AS (SELECT tgts.*, t_us - delay_us AS q_us FROM tgts JOIN d USING (episode_id)), s AS (SELECT episode_id, header_us AS s_us, v0 FROM msgs WHERE topic = 'purchase')
SELECT t.episode_id, t.frame_index, t.t_us, s.v0 AS v FROM t ASOF LEFT JOIN s ON t.episode_id = s.episode_id AND t.q_us >= s.s_us""")
def lag_compensated(spark, sf):
    m = messages(spark, sf)
    delays = m.groupBy("episode_id").agg(F.median(F.col("bag_us") - F.col("header_us")).cast("long").alias("delay_us"))
    b = align.lag_compensated(targets(spark, sf), align.samples(m, ACTION), delays, BUCKET)
    return b.select("episode_id", "frame_index", "t_us", F.col("hit.payload.values")[0].alias("v"))


@query("""--with a AS (SELECT * FROM msgs WHERE topic = 'purchase'), h AS (SELECT * FROM msgs WHERE topic = 'error'),
x AS (SELECT t.episode_id, t.frame_index, t.t_us, a.v0 AS action FROM tgts t ASOF LEFT JOIN a ON t.episode_id = a.episode_id AND t.t_us >= a.header_us)
SELECT x.episode_id, x.frame_index, x.action, h.v0 AS hand FROM x ASOF LEFT JOIN h ON x.episode_id = h.episode_id AND x.t_us >= h.header_us""")
def hold_many(spark, sf):
    out = align.hold_many(targets(spark, sf), messages(spark, sf), [ACTION, HAND], BUCKET)
    return out.select("episode_id", "frame_index", F.col(ACTION)[0].alias("action"), F.col(HAND)[0].alias("hand"))


# ---- topics to features

BUILDERS: topics.Builders = {"observation.state": (STATE, lambda v: v), "observation.first": (STATE, lambda v: F.slice(v, 1, 1)), "action": (ACTION, lambda v: V.scale_hand(v, "claw"))}


@query("SELECT episode_id, seq, 'observation.state' AS key, round(v0, 6) AS x0, v1 AS x1 FROM msgs WHERE topic = 'click' UNION ALL SELECT episode_id, seq, 'observation.first', round(v0, 6), NULL FROM msgs WHERE topic = 'click' UNION ALL SELECT episode_id, seq, 'action', round(v0 / 100.0, 6), v1 / 100.0 FROM msgs WHERE topic = 'purchase'")
def map_topics(spark, sf):
    b = topics.build(messages(spark, sf), BUILDERS)
    return b.select("episode_id", "seq", "key", F.round(F.get("vector", F.lit(0)), 6).alias("x0"), F.get("vector", F.lit(1)).alias("x1"))


@query("SELECT episode_index, frame_index FROM frms WHERE label % 3 <> 0 AND label % 5 <> 0")
def require(spark, sf):
    f = frames(spark, sf).withColumns({"state": F.when(F.col("label") % 3 != 0, F.col("state")), "action": F.when(F.col("label") % 5 == 0, F.array().cast("array<double>")).otherwise(F.col("action"))})
    return topics.require(f, ["state", "action"]).select("episode_index", "frame_index")


@query("SELECT episode_index, frame_index, CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS pos, round(unnest(v), 6) AS x FROM (SELECT episode_index, frame_index, list_concat(state[1:13], action[1:3], [CAST(label AS DOUBLE)]) AS v FROM frms)")
def imu_vector(spark, sf):
    xyz = lambda v, a: F.struct(*[F.col(v)[a + i].alias(n) for i, n in enumerate("xyz")])
    quat = F.struct(*[F.col("state")[9 + i].alias(n) for i, n in enumerate("xyzw")])
    imu = F.struct(xyz("state", 0).alias("gyro"), xyz("state", 3).alias("acc"), xyz("state", 6).alias("free_acc"), quat.alias("quat"))
    pose = F.struct(*[F.col("action")[i].alias(n) for i, n in enumerate(("x", "y", "yaw"))])
    f = frames(spark, sf).withColumns({"imu": imu, "pose": pose})
    return elements(f.withColumn("v", F.concat(V.imu_vector("imu"), V.pose_vector("pose"), V.as_singleton(F.col("label").cast("double")))), ["episode_index", "frame_index"], "v")


@query("SELECT episode_index, frame_index, row_number() OVER (ORDER BY episode_index, frame_index) AS place FROM frms")
def order(spark, sf):
    from ..operators import episodes

    return episodes.ordered(frames(spark, sf)).select("episode_index", "frame_index", "place")


# ---- vectors


@query("SELECT episode_index, frame_index, CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS pos, round(unnest(v), 6) AS x FROM (SELECT *, list_concat(state[3:5], action[1:2]) AS v FROM frms)")
def slice_vec(spark, sf):
    return elements(frames(spark, sf).withColumn("v", F.concat(V.slice_vec("state", [(2, 5)]), V.slice_vec("action", [(0, 2)]))), ["episode_index", "frame_index"], "v")


@query("SELECT episode_index, frame_index, CAST(generate_subscripts(state, 1) - 1 AS INTEGER) AS pos, round(radians(unnest(state)), 6) AS x FROM frms")
def deg2rad(spark, sf):
    return elements(frames(spark, sf).withColumn("v", V.to_rad("state")), ["episode_index", "frame_index"], "v")


@query("SELECT episode_id, seq, round(v0 / 255.0, 6) AS a, round(v1 / 255.0, 6) AS b FROM msgs WHERE topic = 'signup'")
def scale_hand(spark, sf):
    m = messages(spark, sf).where(F.col("topic") == COMMAND).withColumn("v", V.scale_hand("values", "gripper_command"))
    return m.select("episode_id", "seq", F.round(F.col("v")[0], 6).alias("a"), F.round(F.col("v")[1], 6).alias("b"))


@query("SELECT episode_id, seq, CAST(v0 > 50 AS INTEGER) AS a, CAST(v1 > 50 AS INTEGER) AS b FROM msgs WHERE topic = 'error'")
def binarize_hand(spark, sf):
    m = messages(spark, sf).where(F.col("topic") == HAND).withColumn("v", V.binarize_hand("values", "claw"))
    return m.select("episode_id", "seq", F.col("v")[0].cast("int").alias("a"), F.col("v")[1].cast("int").alias("b"))


@query("SELECT episode_index, frame_index, round(CASE WHEN label % 3 = 0 THEN action[1] ELSE state[1] END, 6) AS v FROM frms")
def coalesce_hand(spark, sf):
    f = frames(spark, sf).withColumn("empty", F.when(F.col("label") % 3 == 0, F.array().cast("array<double>")).otherwise(F.col("state")))
    return f.select("episode_index", "frame_index", F.round(V.coalesce_hand("empty", "action")[0], 6).alias("v"))


@query("SELECT episode_index, frame_index, CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS pos, round(unnest(v), 6) AS x FROM (SELECT *, list_concat(state[1:7], action[15:15], state[8:14], action[16:16]) AS v FROM frms)")
def assemble(spark, sf):
    f = frames(spark, sf).withColumn("v", V.assemble("state", F.slice("action", 15, 2)).cast("array<double>"))
    return elements(f, ["episode_index", "frame_index"], "v")


@query("SELECT episode_index, frame_index, CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS pos, round(unnest(v), 6) AS x FROM (SELECT *, list_concat(chunk[1:12], CASE WHEN label % 2 = 0 THEN state[1:14] ELSE action[1:14] END, chunk[27:32]) AS v FROM frms)")
def overlay(spark, sf):
    f = frames(spark, sf).withColumn("alt", F.when(F.col("label") % 2 == 0, F.slice("state", 1, 14)))
    return elements(f.withColumn("v", V.overlay("chunk", F.slice("action", 1, 14), "alt")), ["episode_index", "frame_index"], "v")


@query("SELECT episode_index, frame_index, round(state[1], 6) AS x, round(state[3], 6) AS yaw, CAST(label % 2 AS DOUBLE) AS flag, CAST(20 AS INTEGER) AS width FROM frms")
def append_base(spark, sf):
    f = frames(spark, sf).withColumn("v", V.append_base("action", F.slice("state", 1, 3), F.col("label") % 2))
    return f.select("episode_index", "frame_index", F.round(F.col("v")[16], 6).alias("x"), F.round(F.col("v")[18], 6).alias("yaw"), F.col("v")[19].alias("flag"), F.size("v").alias("width"))


@query("SELECT episode_index, frame_index, CAST(i AS INTEGER) AS pos, round(v[i + 1] - first_value(v[i + 1]) OVER (PARTITION BY episode_index, i ORDER BY frame_index), 6) AS x FROM (SELECT *, list_concat(state, action) AS v FROM frms), range(32) r(i)")
def relative_start(spark, sf):
    from ..operators import episodes

    return elements(episodes.relative_start(frames(spark, sf)).withColumn("v", F.concat("state", "action")), ["episode_index", "frame_index"], "v")


@query("SELECT episode_index, frame_index, CAST(i AS INTEGER) AS pos, round(action[i + 1] - state[i + 1], 6) AS x FROM frms, range(16) r(i)")
def delta_action(spark, sf):
    return elements(frames(spark, sf).withColumn("v", V.minus("action", "state")), ["episode_index", "frame_index"], "v")


@query("SELECT episode_index, frame_index, CAST(generate_subscripts(action, 1) - 1 AS INTEGER) AS pos, round(greatest(-0.1, least(0.1, unnest(action))), 6) AS x, len(list_filter(action, lambda x: abs(x) > 0.1)) > 0 AS outside FROM frms")
def clip_action(spark, sf):
    f = frames(spark, sf).withColumns({"v": V.clip("action", [-0.1] * 16, [0.1] * 16), "outside": V.out_of_range("action", [-0.1] * 16, [0.1] * 16)})
    return elements(f, ["episode_index", "frame_index", "outside"], "v")


@query("SELECT episode_index, frame_index, CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS pos, round(unnest(v), 6) AS x FROM (SELECT *, CASE WHEN label % 2 = 0 THEN list_concat(action[1:7], state[1:1], action[8:14], state[2:2]) ELSE action END AS v FROM frms)")
def coerce_action(spark, sf):
    f = frames(spark, sf).withColumn("v", F.when(F.col("label") % 2 == 0, F.slice("action", 1, 14)).otherwise(F.col("action")))
    return elements(f.withColumn("v", V.coerce_action("v", "state")), ["episode_index", "frame_index"], "v")


@query("SELECT episode_id, seq, CASE WHEN v0 / 100 BETWEEN 0 AND 1 AND v1 / 100 BETWEEN 0 AND 1 THEN round(v0 / 100 * 80.0, 6) END AS l, CASE WHEN v0 / 100 BETWEEN 0 AND 1 AND v1 / 100 BETWEEN 0 AND 1 THEN round(v1 / 100 * 80.0, 6) END AS r FROM msgs WHERE topic = 'signup'")
def eef_command(spark, sf):
    m = messages(spark, sf).where(F.col("topic") == COMMAND).withColumn("c", V.eef_command(F.col("values")[0] / 100, F.col("values")[1] / 100))
    return m.select("episode_id", "seq", F.round(F.col("c")[0], 6).alias("l"), F.round(F.col("c")[1], 6).alias("r"))


@query("SELECT episode_index, frame_index, CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS pos, round(unnest(v), 6) AS x FROM (SELECT *, list_concat(list_transform(range(1, 8), lambda i: action[i] - state[i]), action[8:8], state[16:16]) AS v FROM frms)")
def feature_map(spark, sf):
    f = V.feature_map(frames(spark, sf), {"arm": {"origins": [("action", 0, 7)], "subtract": "state"}, "hand": {"origins": [("action", 7, 8), ("state", 15, 16)]}})
    return elements(f.withColumn("v", F.concat("arm", "hand")), ["episode_index", "frame_index"], "v")


@query("--with c AS (SELECT *, list_transform(state, lambda x: greatest(least(x, 0.2), -0.2)) AS v FROM frms) SELECT episode_index, frame_index, CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS pos, round(CASE WHEN list_max(v) > list_min(v) THEN (unnest(v) - list_min(v)) / (list_max(v) - list_min(v)) * 255.0 ELSE 0.0 END, 6) AS x FROM c")
def normalize_depth(spark, sf):
    return elements(frames(spark, sf).withColumn("v", V.normalize_depth("state", -0.2, 0.2)), ["episode_index", "frame_index"], "v")


@query("SELECT episode_index, frame_index, CASE WHEN label % 3 = 0 THEN 'width' WHEN label % 3 = 1 THEN 'empty;width' ELSE '' END AS reasons FROM frms")
def check_actions(spark, sf):
    v = F.when(F.col("label") % 3 == 0, F.slice("action", 1, 7)).when(F.col("label") % 3 == 1, F.array().cast("array<double>")).otherwise(F.col("action"))
    return frames(spark, sf).select("episode_index", "frame_index", F.concat_ws(";", V.violations(v, 16)).alias("reasons"))


@query("SELECT episode_index, frame_index, CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS pos, round(unnest(v), 6) AS x FROM (SELECT *, list_concat(state[1:8], action[1:8], state[9:16], action[9:16]) AS v FROM frms)")
def assemble_state(spark, sf):
    return elements(frames(spark, sf).withColumn("v", V.assemble_state(["state", "action"])), ["episode_index", "frame_index"], "v")


@query()
def add_noise(spark, sf):
    return frames(spark, sf).select("episode_index", "frame_index", V.add_noise("state", 0.01, 7).alias("state"))


@query("SELECT event_id, CASE WHEN event_type = 'click' THEN '<set>' ELSE event_type END AS v FROM events")
def redact(spark, sf):
    m = F.create_map(F.when(F.col("event_type") == "click", F.lit("api_key")).otherwise(F.lit("name")), F.col("event_type"))
    return table(spark, sf, "events").select("event_id", F.map_values(V.redact(m))[0].alias("v"))
