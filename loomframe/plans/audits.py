"""Queries of audits, events, cycles and lineage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import align, audit, clocks, cycles, events, lineage, topics
from ..sources import io
from .standins import ACTION, BUCKET, HAND, MASTER, STATE, TABLES, frames, messages, query, table, targets

_HOLD = "s AS (SELECT episode_id, header_us AS s_us, v0 FROM msgs WHERE topic = 'click'), h AS (SELECT t.episode_id, t.frame_index, t.t_us, (t_us - s_us) / 1000.0 AS age_ms FROM tgts t ASOF LEFT JOIN s ON t.episode_id = s.episode_id AND t.t_us >= s.s_us)"
_AGES = f"--with {_HOLD}, ag AS (SELECT episode_id, round(quantile_cont(age_ms, 0.5), 6) AS p50_ms, round(quantile_cont(age_ms, 0.95), 6) AS p95_ms, round(quantile_cont(age_ms, 0.99), 6) AS p99_ms, max(age_ms) AS max_ms, count(*) - count(age_ms) AS missing FROM h GROUP BY 1)"


def ages(spark, sf):
    b = align.hold(align.bracket(targets(spark, sf), align.samples(messages(spark, sf), STATE), BUCKET))
    return audit.age_stats(b.withColumn("age_ms", F.col("age_us") / 1000.0), ["episode_id"])


@query(_AGES + " SELECT * FROM ag -- tgts msgs")
def age_stats(spark, sf):
    return ages(spark, sf).select("episode_id", *[F.round(c, 6).alias(c) for c in ("p50_ms", "p95_ms", "p99_ms")], "max_ms", "missing")


@query("""SELECT episode_id, topic, count(*) AS n, (max(header_us) - min(header_us)) / 1e6 AS span_s, CASE WHEN count(*) > 1 AND max(header_us) > min(header_us) THEN round((count(*) - 1) * 1e6 / (max(header_us) - min(header_us)), 9) END AS source_hz,
CASE WHEN count(*) > 1 AND max(bag_us) > min(bag_us) THEN round((count(*) - 1) * 1e6 / (max(bag_us) - min(bag_us)), 9) END AS receive_hz FROM msgs GROUP BY 1, 2""")
def rate_stats(spark, sf):
    return clocks.rate_stats(messages(spark, sf)).withColumns({c: F.round(c, 9) for c in ("source_hz", "receive_hz")})


@query("""--with m AS (SELECT episode_id, min(header_us) AS m0, max(header_us) AS m1 FROM msgs WHERE topic = 'view' GROUP BY 1), s AS (SELECT episode_id, min(header_us) AS s0, max(header_us) AS s1 FROM msgs WHERE topic = 'click' GROUP BY 1)
SELECT episode_id, CASE WHEN s0 IS NULL OR m1 <= m0 THEN 0.0 ELSE round(greatest(0, least(m1, s1) - greatest(m0, s0)) / CAST(m1 - m0 AS DOUBLE), 6) END AS coverage FROM m LEFT JOIN s USING (episode_id)""")
def coverage(spark, sf):
    return clocks.coverage(messages(spark, sf), STATE, MASTER).withColumn("coverage", F.round("coverage", 6))


@query("SELECT episode_id, topic, count(*) FILTER (step <= 0) AS nonmonotonic FROM (SELECT *, header_us - lag(header_us) OVER (PARTITION BY episode_id, topic ORDER BY seq) AS step FROM msgs) GROUP BY 1, 2")
def nonmonotonic(spark, sf):
    return clocks.nonmonotonic(messages(spark, sf))


@query("""SELECT episode_id, topic, round(quantile_cont((bag_us - header_us) / 1000.0, 0.5), 6) AS p50_ms, round(quantile_cont((bag_us - header_us) / 1000.0, 0.95), 6) AS p95_ms, round(quantile_cont((bag_us - header_us) / 1000.0, 0.99), 6) AS p99_ms,
max((bag_us - header_us) / 1000.0) AS max_ms, arg_max((bag_us - header_us) / 1000.0, seq) AS final_ms FROM msgs GROUP BY 1, 2""")
def backlog(spark, sf):
    out = clocks.backlog(messages(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in ("p50_ms", "p95_ms", "p99_ms")})


@query("""--with c AS (SELECT episode_id, min(bag_us) AS m0, max(bag_us) AS m1 FROM msgs WHERE topic = 'view' GROUP BY 1),
b AS (SELECT episode_id, (bag_us - m0) // 86400000000 AS bin, median((bag_us - header_us) / 1000.0) AS age FROM msgs JOIN c USING (episode_id) WHERE topic = 'click' AND bag_us >= m0 AND (bag_us - m0) // 86400000000 <= ceil((m1 - m0) / 86400000000.0) GROUP BY 1, 2),
e AS (SELECT b.episode_id, min(b.bin) AS bin FROM b JOIN b AS n ON n.episode_id = b.episode_id AND n.bin = b.bin + 1 WHERE b.age > 140 AND n.age > 140 GROUP BY 1)
SELECT episode_id, CASE WHEN m1 <= m0 OR episode_id NOT IN (SELECT episode_id FROM msgs WHERE topic = 'click') THEN 0.0 ELSE coalesce(bin * 86400000000, m1 - m0) / 1e6 END AS reliable_s FROM c LEFT JOIN e USING (episode_id) -- msgs""")
def reliable_prefix(spark, sf):
    return clocks.reliable_prefix(messages(spark, sf), STATE, MASTER, 140.0, 86_400_000_000)


_LEVELS = (("A", 8e7, 4e8), ("B", 1.2e8, 6e8), ("C", 3e8, 9e8))


@query(_AGES + ", g AS (SELECT episode_id, " + "CASE " + " ".join(f"WHEN coalesce(p50_ms, 1e300) <= {a!r} AND coalesce(p99_ms, 1e300) <= {b!r} THEN '{x}'" for x, a, b in _LEVELS) + " ELSE 'D' END AS grade FROM ag) SELECT * FROM g -- tgts msgs")
def grade(spark, sf):
    levels = [(x, audit.at_most("p50_ms", a) & audit.at_most("p99_ms", b)) for x, a, b in _LEVELS]
    return audit.grade(ages(spark, sf), levels).select("episode_id", "grade")


@query(_AGES + ", g AS (SELECT " + "CASE " + " ".join(f"WHEN coalesce(p50_ms, 1e300) <= {a!r} AND coalesce(p99_ms, 1e300) <= {b!r} THEN '{x}'" for x, a, b in _LEVELS) + " ELSE 'D' END AS grade FROM ag) SELECT l.grade, count(g.grade) AS n FROM (VALUES ('A'), ('B'), ('C'), ('D')) l(grade) LEFT JOIN g USING (grade) GROUP BY 1 -- tgts msgs")
def grade_counts(spark, sf):
    return audit.grade_counts(grade(spark, sf))


_LOOSE = (("A", 1e8, 5e8), ("B", 2e8, 9e8))


@query(_AGES + ", g AS (SELECT episode_id, " + "CASE " + " ".join(f"WHEN coalesce(p50_ms, 1e300) <= {a!r} AND coalesce(p99_ms, 1e300) <= {b!r} THEN '{x}'" for x, a, b in _LOOSE) + " ELSE 'D' END AS grade FROM ag) SELECT * FROM g -- tgts msgs")
def regrade(spark, sf):
    """Metrics stored with their grades, graded anew by looser limits."""
    path = io.scratch(spark)
    of = lambda levels: [(x, audit.at_most("p50_ms", a) & audit.at_most("p99_ms", b)) for x, a, b in levels]
    audit.grade(ages(spark, sf), of(_LEVELS)).write.parquet(path)
    return audit.regrade(spark.read.parquet(path), of(_LOOSE)).select("episode_id", "grade")


@query("SELECT episode_index, round(min(state[16]), 6) AS least, round(max(state[16]), 6) AS most, min(state[16]) >= -0.2 AND max(state[16]) <= 0.2 AS ok FROM frms GROUP BY 1")
def hand_range(spark, sf):
    return audit.hand_range(frames(spark, sf), "state", ["episode_index"], -0.2, 0.2).withColumns({c: F.round(c, 6) for c in ("least", "most")})


_TIERS = {"direct": {"p50_ms": 9e7, "max_ms": 6e8}, "causal": {"p95_ms": 4e8}}
_QUAL = _AGES + """, ql AS (SELECT *, list_filter([CASE WHEN coalesce(p50_ms, 1e300) > 9e7 THEN 'p50_ms_' || coalesce(printf('%.1f', p50_ms), 'missing') END, CASE WHEN coalesce(max_ms, 1e300) > 6e8 THEN 'max_ms_' || coalesce(printf('%.1f', max_ms), 'missing') END], lambda x: x IS NOT NULL) AS dr,
list_filter([CASE WHEN coalesce(p95_ms, 1e300) > 4e8 THEN 'p95_ms_' || coalesce(printf('%.1f', p95_ms), 'missing') END], lambda x: x IS NOT NULL) AS cr FROM ag)"""


def qualified(spark, sf):
    a = ages(spark, sf)
    return audit.qualify(a.withColumns({c: F.round(c, 6) for c in ("p50_ms", "p95_ms")}), _TIERS)


@query(_QUAL + " SELECT episode_id, array_to_string(dr, ';') AS direct_reasons, len(dr) = 0 AS direct, array_to_string(cr, ';') AS causal_reasons, len(cr) = 0 AS causal FROM ql -- tgts msgs")
def qualify(spark, sf):
    q = qualified(spark, sf)
    return q.select("episode_id", F.concat_ws(";", "direct_reasons").alias("direct_reasons"), "direct", F.concat_ws(";", "causal_reasons").alias("causal_reasons"), "causal")


@query(_QUAL + " SELECT regexp_replace(r, '_[^_]*$', '') AS reason, count(*) AS n FROM (SELECT unnest(dr) AS r FROM ql) GROUP BY 1 -- tgts msgs")
def reason_counts(spark, sf):
    return audit.reason_counts(qualified(spark, sf), "direct_reasons")


@query(_QUAL + " SELECT count(*) AS total, count(*) FILTER (len(dr) = 0) AS direct, count(*) FILTER (len(cr) = 0) AS causal FROM ql -- tgts msgs")
def tier_counts(spark, sf):
    return audit.tier_counts(qualified(spark, sf), ["direct", "causal"])


@query("""--with e AS (SELECT episode_index, list_transform(list_zip(state, action), lambda x: abs(x[1] - x[2])) AS e FROM frms)
SELECT episode_index, round(avg(list_avg(e)), 6) AS mae, round(quantile_cont(list_max(e), 0.95), 6) AS p95_max, round(max(list_max(e)), 6) AS max FROM e GROUP BY 1""")
def tracking_error(spark, sf):
    out = audit.tracking_error(frames(spark, sf), ["episode_index"], "state", "action")
    return out.select("episode_index", *[F.round(c, 6).alias(c) for c in ("mae", "p95_max", "max")])


@query("SELECT episode_index, dim, round(min(x), 6) AS min, round(max(x), 6) AS max FROM (SELECT episode_index, CAST(generate_subscripts(action, 1) - 1 AS INTEGER) AS dim, unnest(action) AS x FROM frms) GROUP BY 1, 2")
def dim_range(spark, sf):
    return audit.dim_range(frames(spark, sf), ["episode_index"], "action").select("episode_index", "dim", F.round("min", 6).alias("min"), F.round("max", 6).alias("max"))


@query("SELECT episode_id, topic, count(*) AS n, CAST(0 AS BIGINT) AS empty, count(*) FILTER (NOT isfinite(v0)) AS invalid FROM msgs GROUP BY 1, 2")
def topic_inventory(spark, sf):
    return clocks.topic_inventory(messages(spark, sf), [], 2)[0]


@query("SELECT e.episode_id, t.topic FROM (SELECT DISTINCT episode_id FROM msgs) e, (VALUES ('view'), ('click'), ('purchase'), ('error'), ('signup'), ('gripper')) t(topic) WHERE NOT EXISTS (FROM msgs m WHERE m.episode_id = e.episode_id AND m.topic = t.topic)")
def missing_topics(spark, sf):
    return clocks.topic_inventory(messages(spark, sf), ["view", "click", "purchase", "error", "signup", "gripper"], 2)[1]


@query("SELECT count(*) AS episodes, count(*) FILTER (ok) AS successes, count(*) FILTER (ok) / count(*) AS rate FROM (SELECT user_id, max(value) > 400 AS ok FROM events GROUP BY 1)")
def success_rate(spark, sf):
    e = table(spark, sf, "events").groupBy("user_id").agg(F.max("value").alias("v"))
    return audit.success_rate(e, F.col("v") > 400)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT (o_orderkey % 3 = 0 AND o_custkey % 2 = 0)")
def pending_jobs(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return audit.pending_jobs(o, o.where("o_orderkey % 3 = 0 and o_custkey % 2 = 0"), ["o_orderkey", "o_custkey"])


@query("SELECT 'good' AS side, count(*) FILTER (n_chars >= 100) AS n FROM documents UNION ALL SELECT 'failed', count(*) FILTER (n_chars < 100) FROM documents")
def split_failures(spark, sf):
    good, bad = audit.split_failures(table(spark, sf, "documents"), F.when(F.col("n_chars") < 100, "short"))
    return good.agg(F.lit("good").alias("side"), F.count("*").alias("n")).union(bad.agg(F.lit("failed").alias("side"), F.count("*").alias("n")))


@query("SELECT url, dense_rank() OVER (ORDER BY url) - 1 AS ordinal FROM (SELECT DISTINCT url FROM pages)")
def index_recordings(spark, sf):
    return audit.index_recordings(table(spark, sf, "pages"), "url")


# ---- events


def commands(spark, sf):
    m = messages(spark, sf).where(F.col("topic") == HAND)
    return m.select("episode_id", F.col("header_us").alias("t_us"), "seq", F.col("values")[1].alias("x"))


_EDGE = "c AS (SELECT episode_id, header_us AS t_us, seq, v1 > 50 AS closed, lag(v1 > 50) OVER (PARTITION BY episode_id ORDER BY header_us, seq) AS was FROM msgs WHERE topic = 'error'), ed AS (SELECT episode_id, t_us, seq, CASE WHEN closed THEN 'close' ELSE 'open' END AS kind FROM c WHERE closed <> was)"
_HOUR = 3_600_000_000


@query(f"--with {_EDGE} SELECT * FROM ed -- msgs")
def edges(spark, sf):
    return events.edges(commands(spark, sf), 50.0)


@query(f"--with {_EDGE}, n AS (SELECT episode_id, max(header_us) AS end_us FROM msgs GROUP BY 1), u AS (SELECT ed.*, coalesce(lead(t_us) OVER (PARTITION BY episode_id ORDER BY t_us, seq), end_us) AS until FROM ed JOIN n USING (episode_id)) SELECT *, until - t_us >= {48 * _HOUR} AS stable FROM u -- msgs")
def stable_edges(spark, sf):
    m = messages(spark, sf)
    return events.stable_edges(events.edges(commands(spark, sf), 50.0), m.groupBy("episode_id").agg(F.max("header_us").alias("end_us")), 48 * _HOUR)


def responses(spark, sf):
    e = events.edges(commands(spark, sf), 50.0).select("episode_id", F.col("seq").alias("event_id"), F.col("t_us").alias("at_us"), "kind")
    s = messages(spark, sf).where(F.col("topic") == STATE).select("episode_id", F.col("header_us").alias("s_us"), F.col("values")[0].alias("x"))
    return e, s


_RESP = f"""--with {_EDGE}, ev AS (SELECT episode_id, seq AS event_id, t_us AS at_us, kind, least(t_us + {240 * _HOUR}, coalesce(lead(t_us) OVER (PARTITION BY episode_id ORDER BY t_us, seq), t_us + {240 * _HOUR})) AS end_us FROM ed),
nr AS (SELECT ev.*, m.header_us AS s_us, m.v0 AS x FROM ev JOIN msgs m ON m.topic = 'click' AND m.episode_id = ev.episode_id AND m.header_us >= at_us - {120 * _HOUR} AND m.header_us < end_us),
md AS (SELECT episode_id, event_id, median(CASE WHEN s_us < at_us THEN x END) AS baseline, median(CASE WHEN s_us >= end_us - {120 * _HOUR} THEN x END) AS final FROM nr GROUP BY 1, 2),
dl AS (SELECT episode_id, event_id, """ + ", ".join(f"min(CASE WHEN s_us >= at_us AND (CASE WHEN final > baseline THEN x >= baseline + {s} * (final - baseline) ELSE x <= baseline + {s} * (final - baseline) END) THEN s_us - at_us END) AS delay{n}_us" for s, n in ((0.05, 5), (0.5, 50), (0.95, 95))) + f""" FROM nr JOIN md USING (episode_id, event_id) WHERE baseline IS NOT NULL AND final IS NOT NULL GROUP BY 1, 2),
rs AS (SELECT ev.episode_id, ev.event_id, kind, baseline, final, final - baseline AS move, delay5_us, delay50_us, delay95_us, CASE WHEN baseline IS NULL THEN 'no_baseline' WHEN final IS NULL THEN 'no_final' WHEN abs(final - baseline) < 10 THEN 'no_move' WHEN CASE WHEN kind = 'close' THEN final < baseline ELSE final > baseline END THEN 'direction' WHEN delay50_us IS NULL THEN 'no_crossing' WHEN delay50_us > {200 * _HOUR} THEN 'slow' END AS reason
FROM ev LEFT JOIN md USING (episode_id, event_id) LEFT JOIN dl USING (episode_id, event_id))"""


@query(_RESP + " SELECT episode_id, event_id, kind, round(baseline, 6) AS baseline, round(final, 6) AS final, round(move, 6) AS move, delay5_us, delay50_us, delay95_us, reason FROM rs -- msgs")
def response_events(spark, sf):
    e, s = responses(spark, sf)
    out = events.response_events(e, s, 240 * _HOUR, 120 * _HOUR, 120 * _HOUR, 10.0, 200 * _HOUR)
    return out.withColumns({c: F.round(c, 6) for c in ("baseline", "final", "move")})


@query(_RESP + " SELECT kind, count(*) AS events, median(delay50_us) AS median_delay50_us, max(delay50_us) AS max_delay50_us, median(delay95_us) AS median_delay95_us, max(delay95_us) AS max_delay95_us FROM rs WHERE reason IS NULL GROUP BY 1 -- msgs")
def delay_summary(spark, sf):
    e, s = responses(spark, sf)
    return events.delay_summary(events.response_events(e, s, 240 * _HOUR, 120 * _HOUR, 120 * _HOUR, 10.0, 200 * _HOUR), ["kind"])


@query(f"--with {_EDGE} SELECT ed.episode_id, ed.seq AS event_id, m.header_us AS s_us, m.v0 AS x FROM ed JOIN msgs m ON m.topic = 'click' AND m.episode_id = ed.episode_id AND m.header_us >= t_us - {24 * _HOUR} AND m.header_us < t_us + {48 * _HOUR} -- msgs")
def event_samples(spark, sf):
    e, s = responses(spark, sf)
    return events.event_samples(e, s, 24 * _HOUR, 48 * _HOUR).select("episode_id", "event_id", "s_us", "x")


@query(f"--with {_EDGE}, x AS (SELECT ed.episode_id, ed.seq AS event_id, min(CASE WHEN m.v0 >= 100 THEN m.header_us - t_us END) AS delay_us FROM ed JOIN msgs m ON m.topic = 'click' AND m.episode_id = ed.episode_id AND m.header_us >= t_us AND m.header_us < t_us + {48 * _HOUR} GROUP BY 1, 2) SELECT * FROM x -- msgs")
def first_crossing(spark, sf):
    e, s = responses(spark, sf)
    near = events.event_samples(e, s, 24 * _HOUR, 48 * _HOUR).withColumns({"level": F.lit(100.0), "rising": F.lit(True)})
    return events.first_crossing(near, ["episode_id", "event_id"], "level", "rising")


# ---- cycles

_DEB = """ob AS (SELECT episode_index, frame_index, CASE WHEN action[1] >= 0.04 THEN 1 WHEN action[1] <= -0.04 THEN 0 END AS obs FROM frms),
il AS (SELECT *, sum(CASE WHEN p IS NOT DISTINCT FROM obs AND f > 1 THEN 0 ELSE 1 END) OVER (PARTITION BY episode_index ORDER BY frame_index) AS run FROM (SELECT *, lag(obs) OVER w AS p, row_number() OVER w AS f FROM ob WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index))),
rn AS (SELECT episode_index, run, obs, min(frame_index) AS frame_index FROM il WHERE obs IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) >= 2),
db AS (SELECT episode_index, frame_index, CASE WHEN obs = 1 THEN 'close' ELSE 'open' END AS kind FROM (SELECT *, lag(obs) OVER (PARTITION BY episode_index ORDER BY frame_index) AS b FROM rn) WHERE obs <> b),
pr AS (SELECT episode_index, CASE WHEN kind = 'open' AND p = 'close' THEN pf WHEN kind = 'close' THEN frame_index END AS close_frame, CASE WHEN kind = 'open' THEN frame_index END AS open_frame, CASE WHEN kind = 'open' AND p = 'close' THEN 'cycle' WHEN kind = 'open' THEN 'orphan_open' WHEN n IS NULL THEN 'unclosed' END AS pair
FROM (SELECT *, lag(kind) OVER w AS p, lead(kind) OVER w AS n, lag(frame_index) OVER w AS pf FROM db WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index))),
cs AS (SELECT *, CASE WHEN cycles = 0 AND orphans + unclosed = 0 THEN 'none' WHEN unclosed > 0 THEN 'unclosed' WHEN orphans > 0 THEN 'orphan_open' WHEN shortest < 2 THEN 'too_short' WHEN cycles = 2 THEN 'expected' WHEN cycles > 2 THEN 'extra' ELSE 'missing' END AS status
FROM (SELECT episode_index, count(*) FILTER (pair = 'cycle') AS cycles, count(*) FILTER (pair = 'orphan_open') AS orphans, count(*) FILTER (pair = 'unclosed') AS unclosed, min(CASE WHEN pair = 'cycle' THEN open_frame - close_frame END) AS shortest FROM pr WHERE pair IS NOT NULL GROUP BY 1))"""


def transitions(spark, sf):
    return cycles.debounce(frames(spark, sf).withColumn("x", F.col("action")[0]), "x", -0.04, 0.04)


@query(f"--with {_DEB} SELECT * FROM db -- frms")
def debounce(spark, sf):
    return transitions(spark, sf)


@query(f"--with {_DEB} SELECT * FROM pr WHERE pair IS NOT NULL -- frms")
def pair_cycles(spark, sf):
    return cycles.pair_cycles(transitions(spark, sf))


@query(f"--with {_DEB} SELECT * FROM cs -- frms")
def cycle_status(spark, sf):
    return cycles.cycle_status(cycles.pair_cycles(transitions(spark, sf)), 2)


@query(f"--with {_DEB} SELECT episode_index, CASE WHEN bool_and(status = 'expected') THEN 'nominal' WHEN bool_and(status IN ('expected', 'extra')) THEN 'recovery_candidate' ELSE 'anomaly' END AS episode_status FROM cs GROUP BY 1 -- frms")
def episode_status(spark, sf):
    return cycles.episode_status(cycle_status(spark, sf))


@query(f"--with {_DEB} SELECT 'cycles' AS name, CAST(cycles AS VARCHAR) AS value, count(*) AS n FROM cs GROUP BY 2 UNION ALL SELECT 'status', status, count(*) FROM cs GROUP BY 2 -- frms")
def cycle_distribution(spark, sf):
    return cycles.cycle_distribution(cycle_status(spark, sf))


# ---- lineage

TABLES["edgs"] = "edgs AS (SELECT l_orderkey AS output, l_partkey AS source, CAST(0 AS BIGINT) AS start, CAST(l_quantity AS BIGINT) AS \"end\" FROM lineitem)"


def manifest(spark, sf):
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("output"), F.col("l_partkey").alias("source"), F.lit(0).cast("long").alias("start"), F.col("l_quantity").cast("long").alias("end"))


def good_parts(spark, sf):
    return table(spark, sf, "part").where("p_size <= 40").select(F.col("p_partkey").alias("source"))


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def keep_ids(spark, sf):
    return lineage.keep(table(spark, sf, "documents").select("doc_id", "n_chars"), table(spark, sf, "labels").where("quality = 1"), "doc_id")


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def skip_ids(spark, sf):
    return lineage.skip(table(spark, sf, "documents").select("doc_id", "n_chars"), table(spark, sf, "labels").where("quality = 1"), "doc_id")


@query("SELECT DISTINCT l_partkey AS p_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40)")
def missing_ids(spark, sf):
    asked = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    return lineage.missing_ids(asked, table(spark, sf, "part").where("p_size <= 40"), "p_partkey")


@query("SELECT DISTINCT o_custkey AS output, source FROM orders JOIN edgs ON o_orderkey = output")
def trace_sources(spark, sf):
    second = table(spark, sf, "orders").select(F.col("o_custkey").alias("output"), F.col("o_orderkey").alias("source"))
    return lineage.trace_sources([manifest(spark, sf), second])


@query("SELECT output, count(*) AS sources, bool_and(p_partkey IS NOT NULL) AS qualified FROM edgs LEFT JOIN (SELECT p_partkey FROM part WHERE p_size <= 40) ON source = p_partkey GROUP BY 1")
def all_sources_ok(spark, sf):
    return lineage.all_sources_qualified(manifest(spark, sf), good_parts(spark, sf))


@query("""SELECT output, source, rs + start AS start, least(rs + "end", re) AS "end" FROM edgs JOIN (SELECT p_partkey AS source, CAST(p_partkey % 5 AS BIGINT) AS rs, CAST(p_size AS BIGINT) AS re FROM part) USING (source) WHERE least(rs + "end", re) > rs + start""")
def compose_trims(spark, sf):
    raw = table(spark, sf, "part").select(F.col("p_partkey").alias("source"), (F.col("p_partkey") % 5).cast("long").alias("raw_start"), F.col("p_size").cast("long").alias("raw_end"))
    return lineage.compose_trims(manifest(spark, sf), raw)


@query("SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS kept_index FROM part WHERE p_size <= 40")
def remap_kept(spark, sf):
    return lineage.remap_kept(table(spark, sf, "part").select("p_partkey", (F.col("p_size") > 40).alias("dropped")), "p_partkey")


@query("SELECT output, source, o_custkey, c_nationkey FROM edgs LEFT JOIN orders ON o_orderkey = output LEFT JOIN customer ON c_custkey = o_custkey")
def traceability(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("output"), "o_custkey")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return lineage.traceability(manifest(spark, sf), (o, "output"), (c, "o_custkey")).select("output", "source", "o_custkey", "c_nationkey")


@query("SELECT r.n, count(k.output) AS outputs FROM range(9) r(n) LEFT JOIN (SELECT output, count(p_partkey) AS n FROM edgs LEFT JOIN (SELECT p_partkey FROM part WHERE p_size <= 40) ON source = p_partkey GROUP BY 1) k USING (n) GROUP BY 1")
def source_histogram(spark, sf):
    return lineage.source_histogram(manifest(spark, sf), good_parts(spark, sf), 8)


@query("SELECT episode_index, round(avg(d), 6) AS mae, round(max(d), 6) AS max FROM (SELECT episode_index, unnest(list_transform(list_zip(action, state), lambda x: abs(x[1] - x[2]))) AS d FROM frms) GROUP BY 1")
def compare_frames(spark, sf):
    f = frames(spark, sf)
    return lineage.compare_frames(f, f.withColumn("action", F.col("state"))).select("episode_index", F.round("mae", 6).alias("mae"), F.round("max", 6).alias("max"))


_FEAT = "ft AS (SELECT source AS dataset, lang AS name, CASE WHEN max(n_chars) > 20000 THEN 'long' ELSE 'short' END AS description FROM documents GROUP BY 1, 2)"


@query(f"--with {_FEAT}, w AS (SELECT d.dataset, r.name, r.description AS expected FROM (SELECT DISTINCT dataset FROM ft WHERE dataset <> 'src0') d, (SELECT * FROM ft WHERE dataset = 'src0') r) SELECT dataset, name, expected, description AS found FROM w FULL JOIN (FROM ft WHERE dataset <> 'src0') USING (dataset, name) WHERE expected IS DISTINCT FROM description")
def schema_diff(spark, sf):
    d = table(spark, sf, "documents").groupBy(F.col("source").alias("dataset"), F.col("lang").alias("name")).agg(F.when(F.max("n_chars") > 20000, "long").otherwise("short").alias("description"))
    return lineage.schema_diff(d, "src0")


@query("--with a AS (SELECT episode_id, count(*) AS n FROM msgs WHERE topic = 'click' GROUP BY 1), b AS (SELECT episode_id, count(*) AS n FROM msgs WHERE topic = 'purchase' GROUP BY 1) SELECT episode_id, coalesce(a.n, 0) AS n_a, coalesce(b.n, 0) AS n_b FROM a FULL JOIN b USING (episode_id) WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)")
def check_counts(spark, sf):
    m = messages(spark, sf)
    return lineage.check_counts(m.where(F.col("topic") == STATE), m.where(F.col("topic") == ACTION), "episode_id")


@query("""--with n AS (SELECT episode_id, count(*) AS frames FROM tgts GROUP BY 1), m AS (SELECT episode_id, count(*) AS e FROM msgs WHERE topic = 'click' GROUP BY 1)
SELECT episode_id, CAST(0 AS BIGINT) AS start, e AS "end", coalesce(frames, 0) AS frames FROM m LEFT JOIN n USING (episode_id) WHERE e > coalesce(frames, 0)""")
def trims_outside(spark, sf):
    trims = messages(spark, sf).where(F.col("topic") == STATE).groupBy("episode_id").agg(F.lit(0).cast("long").alias("start"), F.count("*").alias("end"))
    return lineage.trims_outside(trims, targets(spark, sf), "episode_id")


@query("SELECT url, sha1(url)[1:10] AS id FROM pages")
def path_id(spark, sf):
    return table(spark, sf, "pages").select("url", topics.path_id("url").alias("id"))


@query("SELECT doc_id, coalesce(task, 'default') AS task FROM documents LEFT JOIN (SELECT item_id AS doc_id, text[1:20] AS task FROM benchmark) USING (doc_id)")
def lookup(spark, sf):
    dim = table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), F.substring("text", 1, 20).alias("task"))
    return lineage.lookup(table(spark, sf, "documents").select("doc_id"), dim, "doc_id", "task", "default")


@query("SELECT id FROM (SELECT doc_id AS id FROM labels WHERE quality = 1 INTERSECT SELECT doc_id FROM documents WHERE lang = 'en') EXCEPT SELECT doc_id FROM labels WHERE toxic = 1")
def id_algebra(spark, sf):
    l = table(spark, sf, "labels")
    ids = lambda df: df.select(F.col("doc_id").alias("id"))
    return ids(l.where("quality = 1")).intersect(ids(table(spark, sf, "documents").where("lang = 'en'"))).subtract(ids(l.where("toxic = 1")))
