"""Scans and sinks of datasets, sidecar documents, lists, logs and reports.

parse_* take a table of text lines (column value) or documents, read_* a path; every reader has a fixed schema.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import stats as st

FRAME_SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("observation.state", T.ArrayType(T.FloatType())), ("action", T.ArrayType(T.FloatType())), ("timestamp", T.FloatType()), ("frame_index", T.LongType()), ("episode_index", T.LongType()), ("index", T.LongType()), ("task_index", T.LongType()))])
STATS = ("count", "min", "max", "mean", "std", *st.QUANTILES)
SCALARS = ("timestamp", "frame_index", "episode_index", "index", "task_index")
FULL_WIDTH = {"，": ",", "－": "-", "、": ",", "；": ",", ";": ","}


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Unset, a temporary one where driver and executors are one process, and an error elsewhere."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared one, deleted when the driver ends."""
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    until_exit(spark, path)
    return path


def until_exit(spark: SparkSession, path: str) -> None:
    """Have a folder deleted when the driver's JVM ends."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that no later plan reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


# ---- frames, episodes, tasks, info


def read_frames(spark: SparkSession, root: str, columns: list[str] | None = None) -> DataFrame:
    """Frames with column pruning; optional columns that the files lack are null."""
    df = spark.read.parquet(f"{root}/data")
    wanted = columns or [f.name for f in FRAME_SCHEMA]
    return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(FRAME_SCHEMA[c].dataType if c in FRAME_SCHEMA.names else "string").alias(c) for c in wanted])


def with_optional(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Named columns, null of the given type where the table has none."""
    return df.select(*[F.col(c).cast(t).alias(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in columns.items()])


def read_episodes(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/meta/episodes")


def full_segments(episodes: DataFrame) -> DataFrame:
    """Each episode as one segment of itself."""
    return episodes.select(F.col("episode_index").alias("output"), F.col("episode_index").alias("source"), F.lit(0).cast("long").alias("start"), F.col("length").alias("end"))


def read_tasks(spark: SparkSession, root: str, names: tuple[str, ...] = ("task", "task_name", "__index_level_0__")) -> DataFrame:
    """(task_index, task): the first of some column names that the table has."""
    df = spark.read.parquet(f"{root}/meta/tasks.parquet")
    return df.select("task_index", F.coalesce(*[F.col(n) for n in names if n in df.columns]).alias("task"))


def read_info(spark: SparkSession, root: str, default_fps: float = 10.0) -> DataFrame:
    schema = "codebase_version string, fps double, robot_type string, total_episodes long, total_frames long, features map<string, struct<dtype:string,shape:array<int>,names:array<string>>>"
    return spark.read.schema(schema).json(f"{root}/meta/info.json", multiLine=True).withColumn("fps", F.coalesce("fps", F.lit(default_fps)))


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    """(feature, an array for each statistic) from a document {feature: {statistic: [...]}}."""
    kinds = ", ".join(f"{n}: array<{'bigint' if n == 'count' else 'double'}>" for n in STATS)
    d = F.from_json("value", f"map<string, struct<{kinds}>>")
    return spark.read.text(path, wholetext=True).select(F.explode(d).alias("feature", "s")).select("feature", "s.*")


def parse_trims(docs: DataFrame, column: str = "value") -> DataFrame:
    """(episode_index, start, end, dropped) from trim documents {"trims": {episode: {start, end, drop}}}."""
    d = F.from_json(column, "trims map<string, struct<start:bigint,end:bigint,drop:boolean>>")
    return docs.select(F.explode(d["trims"]).alias("e", "t")).select(F.col("e").cast("long").alias("episode_index"), F.col("t.start").alias("start"), F.col("t.end").alias("end"), F.coalesce("t.drop", F.lit(False)).alias("dropped"))


def parse_manifest(docs: DataFrame, column: str = "value") -> DataFrame:
    """Segment edges (output, source, start, end) from manifests {"exported": [{output_episode, source_segments: [...]}]}."""
    d = F.from_json(column, "exported array<struct<output_episode:bigint,source_segments:array<struct<source_episode:bigint,start:bigint,end:bigint>>>>")
    out = docs.select(F.explode(d["exported"]).alias("x")).select(F.col("x.output_episode").alias("output"), F.explode("x.source_segments").alias("s"))
    return out.select("output", F.col("s.source_episode").alias("source"), F.col("s.start").alias("start"), F.col("s.end").alias("end"))


def mixture_specs(docs: DataFrame, column: str = "value") -> DataFrame:
    """One row a specification [{repo_id, weight, name}]: its sources in order, and what is wrong with it (empty if nothing is).

    A source without a name is source_01, source_02, ... by its place. Weights must be positive and names unique, and a
    source must be there.
    """
    spec = F.from_json(column, "array<struct<repo_id:string,weight:double,name:string>>")
    named = F.transform(spec, lambda m, i: F.struct(F.coalesce(F.nullif(m["name"], F.lit("")), F.format_string("source_%02d", i + 1)).alias("source"), m["repo_id"].alias("repo_id"), m["weight"].alias("weight")))
    s = F.col("sources")
    wrong = [F.when(s.isNull() | (F.size("sources") < 1), "no sources"), F.when(F.exists(s, lambda m: m["weight"].isNull() | ~(m["weight"] > 0) | F.isnan(m["weight"])), "weights must be positive"), F.when(F.size(F.array_distinct(F.transform(s, lambda m: m["source"]))) < F.size(s), "names must be unique"), F.when(F.exists(s, lambda m: m["repo_id"].isNull()), "a source without repo_id")]
    return docs.select(column, named.alias("sources")).withColumn("violations", F.array_compact(F.array(*wrong)))


def parse_mixture(docs: DataFrame, column: str = "value") -> DataFrame:
    """(source, repo_id, weight) of each specification, weights normalised in it; a specification with a violation is an error."""
    out = mixture_specs(docs, column)
    sources = F.when(F.size("violations") > 0, F.raise_error(F.concat(F.lit("mixture: "), F.concat_ws("; ", "violations")))).otherwise(F.col("sources"))
    total = F.aggregate("sources", F.lit(0.0), lambda t, m: t + m["weight"])
    return out.select(sources.alias("sources")).withColumn("total", total).select(F.explode("sources").alias("m"), "total").select("m.source", "m.repo_id", (F.col("m.weight") / F.col("total")).alias("weight"))


# ---- lists


def id_list_parts(lines: DataFrame, column: str = "value") -> DataFrame:
    """The parts of lists such as "3, 17, 28 - 30", one row each: its ends a <= b, null where it is neither a number nor a range.

    Ranges go in either direction; commas, semicolons and white space part them, full-width ones too; comments follow #.
    """
    text = F.regexp_replace(column, "#.*", "")
    for mark, plain in FULL_WIDTH.items():
        text = F.replace(text, F.lit(mark), F.lit(plain))
    text = F.regexp_replace(text, r"\s*-\s*", "-")
    part = lines.select(F.explode(F.split(text, r"[,\s]+")).alias("part")).where("part <> ''")
    ends = F.transform(F.when(F.col("part").rlike(r"^\d+(-\d+)?$"), F.split("part", "-")), lambda x: x.try_cast("long"))
    return part.select("part", F.array_min(ends).alias("a"), F.array_max(ends).alias("b"))


def id_list_violations(lines: DataFrame, column: str = "value") -> DataFrame:
    """Parts of lists that are neither a number nor a range."""
    return id_list_parts(lines, column).where("a is null").select("part").distinct()


def parse_id_list(lines: DataFrame, column: str = "value") -> DataFrame:
    """Distinct ids of lists; a part that id_list_violations() names is an error."""
    known = F.when(F.col("a").isNull(), F.raise_error(F.concat(F.lit("not an id or a range: "), "part"))).otherwise(F.sequence("a", "b"))
    return id_list_parts(lines, column).select(F.explode(known).alias("id")).distinct()


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    return parse_id_list(spark.read.text(path))


def parse_bad_list(docs: DataFrame, column: str = "value") -> DataFrame:
    """Ids of a text list, of a JSON list, or of a JSON map of drop marks."""
    t = F.trim(F.col(column))
    lists = docs.where(t.startswith("[")).select(F.explode(F.from_json(column, "array<bigint>")).alias("id"))
    maps = docs.where(t.startswith("{")).select(F.explode(F.from_json(column, "map<string,boolean>")).alias("k", "v")).where("v").select(F.col("k").cast("long").alias("id"))
    return parse_id_list(docs.where(~t.rlike(r"^[\[{]")), column).union(lists).union(maps).distinct()


# ---- logs


def parse_vector_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """(tag, values, malformed) of lines such as "STATE: [1, 2]"; lines without a tag have a null tag."""
    tag = F.lower(F.regexp_extract(column, r"(?i)\b(state|clip action|action)\s*:\s*\[", 1))
    values = F.transform(F.split(F.regexp_extract(column, r"\[(.*)\]", 1), r"\s*,\s*"), lambda x: F.trim(x).try_cast("double"))
    out = lines.select(F.when(tag != "", tag).alias("tag"), values.alias("values"))
    return out.withColumn("malformed", F.col("tag").isNotNull() & F.exists("values", lambda x: x.isNull()))


TELEMETRY = "episode bigint, wall_time double, step bigint, action array<double>, observation_state array<double>, reward double, infer_time_sec double, action_infer_time_sec double, exec_time_sec double"


def read_telemetry(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(TELEMETRY).json(root)


def read_loss(spark: SparkSession, root: str) -> DataFrame:
    """A training run's log, a row for each step and source."""
    return spark.read.schema("step bigint, epoch double, source string, loss double, grad_norm double, lr double, step_time double").json(root)


def read_telemetry_stream(spark: SparkSession, root: str) -> DataFrame:
    return spark.readStream.schema(TELEMETRY).json(root)


def read_audit(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


# ---- sinks


def write_dataset(frames: DataFrame, root: str, fps: float, tasks: DataFrame | None = None, episodes_per_file: int = 1000, cameras: dict[str, list[int]] | None = None) -> None:
    """Frames by buckets of episodes, the episode table with each episode's statistics, tasks, statistics, info.

    frames: as ep.reindex() gives them, with new_episode and new_frame. tasks: task_index, task; one task by default.
    cameras: the shape of each camera feature, whose videos are kept elsewhere.
    """
    data = frames.select(F.col("state").cast("array<float>").alias("observation.state"), F.col("action").cast("array<float>").alias("action"), "timestamp", F.col("new_frame").alias("frame_index"), F.col("new_episode").alias("episode_index"), "index", F.lit(0).cast("long").alias("task_index"))
    data = data.withColumn("chunk_index", F.floor(F.col("episode_index") / episodes_per_file))
    # by range of episodes: a bucket of many frames is several tasks' files
    data.repartitionByRange("chunk_index", "episode_index").sortWithinPartitions("episode_index", "frame_index").write.partitionBy("chunk_index").parquet(f"{root}/data")
    spark = frames.sparkSession
    data = read_frames(spark, root)
    features = ["observation.state", "action", *SCALARS]

    def statistics(by: list[str], small: bool) -> DataFrame:
        return st.as_arrays(st.feature_stats(data, features, by, small=small, sketches=small), [*by, "feature"]).select(*by, "feature", *STATS, *(["sketch"] if small else []))

    own = statistics(["episode_index"], True)
    wide = own.groupBy("episode_index").agg(*[F.first(F.when(F.col("feature") == f, F.col(n)), True).alias(f"stats/{f}/{n}") for f in features for n in (*STATS, "sketch")])
    e = data.groupBy("episode_index").agg(F.count("*").alias("length"), F.min("index").alias("dataset_from_index"), (F.max("index") + 1).alias("dataset_to_index"))
    e.join(wide, "episode_index").write.parquet(f"{root}/meta/episodes")
    tasks = spark.range(1).select(F.col("id").alias("task_index"), F.lit("task").alias("task")) if tasks is None else tasks
    tasks.write.parquet(f"{root}/meta/tasks.parquet")
    norm_document(statistics([], False)).coalesce(1).write.text(f"{root}/meta/stats.json")  # one row
    info = spark.read.parquet(f"{root}/meta/episodes").agg(F.lit("v3.0").alias("codebase_version"), F.lit(fps).alias("fps"), F.count("*").alias("total_episodes"), F.sum("length").alias("total_frames"))
    widths = data.agg(*[F.max(F.size(f"`{f}`")).alias(f) for f in ("observation.state", "action")])
    feature = lambda name, dtype, shape: F.struct(F.lit(name).alias("key"), F.struct(F.lit(dtype).alias("dtype"), shape.cast("array<int>").alias("shape"), F.lit(None).cast("array<string>").alias("names")).alias("value"))
    listed = [feature(f, "float32", F.array(F.col(f"`{f}`"))) for f in ("observation.state", "action")]
    listed += [feature(c, "float32" if c == "timestamp" else "int64", F.array(F.lit(1))) for c in SCALARS]
    listed += [feature(c, "video", F.array(*map(F.lit, shape))) for c, shape in (cameras or {}).items()]
    info = info.join(F.broadcast(widths.select(F.map_from_entries(F.array(*listed)).alias("features"))))
    info = info.join(F.broadcast(tasks.agg(F.count("*").alias("total_tasks")))).withColumn("splits", F.struct(F.concat(F.lit("0:"), "total_episodes").alias("train")))
    info.coalesce(1).write.json(f"{root}/meta/info.json")


def merged_stats(spark: SparkSession, roots: list[str]) -> DataFrame:
    """Statistics (feature, dim, ...) of several datasets together, from their episodes' statistics and sketches; no frame is read."""
    features = ["observation.state", "action", *SCALARS]
    names = [*STATS, "sketch"]
    parts = [F.struct(F.lit(f).alias("feature"), F.arrays_zip(*[F.col(f"`stats/{f}/{n}`").alias(n) for n in names]).alias("s")) for f in features]
    rows = None
    for root in roots:
        one = read_episodes(spark, root).select(F.inline(F.array(*parts))).select("feature", F.posexplode("s").alias("dim", "s")).select("feature", "dim", "s.*")
        rows = one if rows is None else rows.unionByName(one)
    return st.merge_sketched(rows, ["feature", "dim"])


def report_columns(df: DataFrame, joined: tuple[str, ...] = ()) -> DataFrame:
    """Nested columns as JSON cells, lists of reasons joined by ;."""
    cell = lambda f: F.concat_ws(";", f.name) if f.name in joined else F.to_json(f.name) if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(f.name)
    return df.select(*[cell(f).alias(f.name) for f in df.schema])


def write_report(df: DataFrame, path: str, joined: tuple[str, ...] = ()) -> None:
    report_columns(df, joined).write.csv(path, header=True)


def write_events(df: DataFrame, path: str) -> None:
    df.write.json(path)


def write_id_lists(df: DataFrame, path: str, id_col: str, class_col: str) -> None:
    """A text list for each class, sorted from one file to the next; a class of many ids is several tasks' files."""
    rows = df.select(F.col(id_col).cast("string").alias("value"), class_col, F.col(id_col).alias("o"))
    rows.repartitionByRange(class_col, "o").sortWithinPartitions(class_col, "o").drop("o").write.partitionBy(class_col).text(path)


def manifest(edges: DataFrame) -> DataFrame:
    """One manifest row for each output, its segments in order."""
    return edges.groupBy("output").agg(F.sort_array(F.collect_list(F.struct("start", "source", "end"))).alias("source_segments"))


def write_manifest(edges: DataFrame, path: str) -> None:
    """Manifests as JSON lines, one for each output: what parse_manifest() reads."""
    segments = F.transform("source_segments", lambda s: F.struct(s["source"].alias("source_episode"), s["start"].alias("start"), s["end"].alias("end")))
    manifest(edges).select(F.array(F.struct(F.col("output").alias("output_episode"), segments.alias("source_segments"))).alias("exported")).write.json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return parse_manifest(spark.read.text(path))


def norm_document(stats: DataFrame, feature: str = "feature") -> DataFrame:
    """{feature: {statistic: [...]}} as one JSON document from arrays of statistics; one row a feature goes in."""
    names = [c for c in stats.columns if c != feature]
    return stats.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct(feature, F.struct(*names)))))).alias("norm_stats"))


def write_norm_stats(stats: DataFrame, path: str, widths: dict[str, int], required: list[str]) -> None:
    """The document, once nothing is wrong with it; read back, it must give what was written."""
    # computed once: the order in which parts' sums come in from other executors changes their last bits
    spark, kept = stats.sparkSession, scratch(stats.sparkSession)
    stats.write.parquet(kept)
    stats = spark.read.schema(stats.schema).parquet(kept)
    wrong = [f"{r.feature} {r.violation}" for r in norm_violations(stats, widths, required).collect()]  # a few for each feature
    if wrong:
        raise ValueError("; ".join(sorted(wrong)))
    norm_document(stats).coalesce(1).write.text(path)
    back = read_stats(spark, path).select(*stats.columns)
    if stats.exceptAll(back).count():
        raise ValueError(f"{path} doesn't give back what was written")
    remove(spark, kept)


def norm_violations(stats: DataFrame, widths: dict[str, int], required: list[str], feature: str = "feature") -> DataFrame:
    """What is wrong with arrays of statistics: missing keys, widths, non-finite values, counts that differ between features."""
    expected = F.create_map(*[F.lit(x) for kv in widths.items() for x in kv])
    checks = [F.when(F.size(n) != expected[F.col(feature)], F.concat(F.lit("width:"), F.lit(n))) for n in required if n in stats.columns]
    checks += [F.when(F.exists(n, lambda x: x.isNull() | F.isnan(x)), F.concat(F.lit("non_finite:"), F.lit(n))) for n in required if n in stats.columns]
    checks += [F.lit(f"missing:{n}") for n in required if n not in stats.columns]
    if "count" in stats.columns:
        counts = F.array_distinct(F.flatten(F.collect_set("count").over(Window.partitionBy(F.lit(0)))))  # one row a feature
        stats = stats.withColumn("__counts", counts)
        checks.append(F.when(F.size("__counts") > 1, F.lit("count")))
    return stats.select(feature, F.explode(F.array_compact(F.array(*checks))).alias("violation"))


# ---- checks


def check_dataset(frames: DataFrame) -> DataFrame:
    """Row totals, index from 0 without holes, finite vectors: one row with what is wrong (zeros if nothing is)."""
    bad = F.exists("action", lambda x: x.isNull() | F.isnan(x))
    return frames.agg(F.count("*").alias("rows"), (F.max("index") + 1 - F.count("*")).alias("holes"), (F.count("*") - F.count_distinct("index")).alias("repeats"), F.count_if(bad).alias("non_finite"))


def accept_dataset(info: DataFrame, frames: DataFrame, tasks: DataFrame, expected: dict) -> DataFrame:
    """Reasons why a dataset isn't the expected one.

    expected: codebase_version, fps, width (of actions, and of states unless state_width is named), and cameras, the exact set of its camera features; episodes and frames are
    compared with info's totals, and with expected's where it names them. Depth features are never accepted, and there must
    be one task.
    """
    widths = {"action": expected["width"], "observation.state": expected.get("state_width", expected["width"])}
    n = frames.agg(F.count("*").alias("n"), F.count_distinct("episode_index").alias("e"), F.count_if(reduce(Column.__or__, [F.size(f"`{f}`") != w for f, w in widths.items()])).alias("w"))
    t = tasks.agg(F.count("*").alias("tasks"))
    all_ = info.join(n).join(t)  # one row each
    names = F.coalesce(F.map_keys("features"), F.array().cast("array<string>"))
    shape = lambda f: F.col("features")[f]["shape"]
    cameras = F.array_sort(F.filter(names, lambda k: k.startswith("observation.images.")))
    wanted = F.array(*map(F.lit, sorted(expected.get("cameras", ())))).cast("array<string>")
    checks = {
        "version": ~F.col("codebase_version").eqNullSafe(F.lit(expected["codebase_version"])),
        "fps": ~F.col("fps").eqNullSafe(F.lit(float(expected["fps"]))),
        "frames": (F.col("total_frames") != F.col("n")) | (F.col("n") != expected.get("frames", F.col("n"))),
        "episodes": (F.col("total_episodes") != F.col("e")) | (F.col("e") != expected.get("episodes", F.col("e"))),
        "width": reduce(Column.__or__, [~shape(f).eqNullSafe(F.array(F.lit(w))) for f, w in widths.items()], F.col("w") > 0),
        "cameras": cameras != wanted,
        "depth": F.exists(names, lambda k: F.lower(k).contains("depth")),
        "tasks": F.col("tasks") != 1,
    }
    return all_.select(F.explode(F.array_compact(F.array(*[F.when(c, k) for k, c in checks.items()]))).alias("violation"))


def feature_kinds(features: DataFrame) -> DataFrame:
    """Kind of each feature (name, dtype) from its name and type."""
    n, d = F.lower("name"), F.lower("dtype")
    kind = F.when(n.contains("depth"), "DEPTH").when(d.isin("image", "video"), "RGB").when(n.startswith("action"), "ACTION").when(n.contains("environment_state"), "ENV").when(n.startswith("observation.state"), "STATE").when(n.contains("reward"), "REWARD")
    return features.withColumn("kind", kind)


def project_features(frames: DataFrame, drop: list[str], keep_prefix: str | None = "next.") -> DataFrame:
    """Frames without some features; with keep_prefix=None user columns of that kind go too."""
    gone = set(drop) | ({c for c in frames.columns if c.startswith("next.")} if keep_prefix is None else set())
    return frames.select(*[F.col(f"`{c}`") for c in frames.columns if c not in gone])


def segments_of(df: DataFrame, key: str, n: str) -> DataFrame:
    w = Window.orderBy(key)
    return df.select(key, (F.sum(n).over(w) - F.col(n)).alias("dataset_from_index"), F.sum(n).over(w).alias("dataset_to_index"))
