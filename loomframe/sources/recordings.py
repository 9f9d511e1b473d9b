"""Recordings as files: quarantine while reading, identity by file, a message store by topic, incremental results.

A recording is a file of JSON lines, one a message, and a last line {"messages": n} that says how many there are. A file
without it, or with another number of lines, has been cut off.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .io import scratch

MESSAGE = "topic string, seq bigint, header_us bigint, bag_us bigint, values array<double>"
LINE = f"{MESSAGE}, messages bigint, broken string"


def write_recordings(messages: DataFrame, root: str, key: str = "episode_id", broken: Column | None = None, cut: Column | None = None) -> None:
    """A folder key=... for each recording, with its messages in order of arrival and the closing line in one file.

    For tests of readers: `broken` marks messages whose line is to be cut short, `cut` those after which a file ends early.
    """
    body = F.to_json(F.struct("topic", "seq", "header_us", "bag_us", "values"))
    lost = F.lit(False) if cut is None else cut
    body = body if broken is None else F.when(broken, F.substring(body, 1, 20)).otherwise(body)
    lines = messages.select(key, "seq", lost.alias("lost"), body.alias("value"))
    ends = messages.groupBy(key).agg(F.count("*").alias("n"), F.max(lost).alias("lost")).where("not lost").select(key, F.lit(None).cast("long").alias("seq"), F.lit(False).alias("lost"), F.to_json(F.struct(F.col("n").alias("messages"))).alias("value"))
    rows = lines.where("not lost").union(ends)
    rows.repartition(key).sortWithinPartitions(key, F.asc_nulls_last("seq")).select(key, "value").write.partitionBy(key).text(root)


def files(spark: SparkSession, root: str) -> DataFrame:
    """(file, size, modified) of every recording, from the listing alone: no file is opened."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("modified"))


def read_recordings(spark: SparkSession, root: str, folder: str = "episode_id bigint") -> tuple[DataFrame, DataFrame]:
    """Messages (file, folder's column, MESSAGE) of whole recordings, and the quarantine (file, reason, line).

    A line that isn't a message is quarantined alone. A recording that has been cut off is quarantined as a whole, as is one
    that can't be read to its end (a damaged archive); neither stops the others. Lines count as such however broken they are.
    """
    key = folder.split()[0]
    rows = spark.read.schema(f"{LINE}, {folder}").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "broken").option("ignoreCorruptFiles", True).json(root)
    rows = rows.withColumn("file", F.col("_metadata.file_path"))
    # a line of valid JSON that lacks what a message has is broken as well
    bad = F.col("broken").isNotNull() | F.col("messages").isNull() & (F.col("topic").isNull() | F.col("header_us").isNull())
    rows = rows.withColumn("bad", bad)
    own = rows.groupBy("file").agg(F.max("messages").alias("said"), F.count_if(F.col("messages").isNull()).alias("came"))
    lost = own.where("said is null or said <> came").select("file", F.when(F.col("said").isNull(), "cut off").otherwise("lines are missing").alias("reason"))
    body = rows.where("messages is null")
    good = body.where("not bad").join(lost.select("file"), "file", "left_anti")
    lines = body.where("bad").join(lost.select("file"), "file", "left_anti").select("file", F.lit("broken line").alias("reason"), F.coalesce("broken", F.to_json(F.struct("topic", "seq"))).alias("line"))
    unread = files(spark, root).join(own.select("file"), "file", "left_anti").select("file", F.lit("unreadable or empty").alias("reason"), F.lit(None).cast("string").alias("line"))
    quarantine = lines.union(lost.select("file", "reason", F.lit(None).cast("string"))).union(unread)
    return good.select("file", key, *[c.split()[0] for c in MESSAGE.split(", ")]), quarantine


def quarantined(spark: SparkSession, root: str, out: str, folder: str = "episode_id bigint") -> tuple[DataFrame, DataFrame]:
    """Both sinks of a reading: messages by topic under out/messages, and out/quarantine as JSON lines; read back."""
    good, bad = read_recordings(spark, root, folder)
    write_store(good, f"{out}/messages")
    bad.write.json(f"{out}/quarantine")
    return read_store(spark, f"{out}/messages"), spark.read.schema("file string, reason string, line string").json(f"{out}/quarantine")


def replace(spark: SparkSession, fresh: str, root: str) -> None:
    """Put the recordings under `fresh` in the place of those of the same folders under `root`."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in fs.listStatus(hadoop(fresh)):
        if folder.isDirectory():
            target = hadoop(f"{root}/{folder.getPath().getName()}")
            fs.delete(target, True)
            fs.rename(folder.getPath(), target)


# ---- messages by topic


def write_store(messages: DataFrame, root: str) -> None:
    """Messages by topic, sorted by recording and time in their files; a topic of many rows is several tasks' files."""
    order = [c for c in ("topic", "episode_id", "header_us", "seq") if c in messages.columns]
    messages.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("topic").parquet(root)


def read_store(spark: SparkSession, root: str, topics: list[str] | None = None) -> DataFrame:
    """Messages of all or some topics; only these topics' files are read."""
    df = spark.read.parquet(root)
    return df if topics is None else df.where(F.col("topic").isin(*topics))


def read_wanted(spark: SparkSession, root: str, wanted: DataFrame) -> DataFrame:
    """Messages of the topics that a table (topic, and columns that pass) names; its topics, known as it runs, prune the files."""
    return spark.read.parquet(root).join(F.broadcast(wanted), "topic")  # a task's table of topics, a row each


# ---- results that follow the recordings


def fingerprint(version: str, parameters: dict) -> Column:
    """What a result depends on: the audit's version and parameters, and the file's name, size and time."""
    told = F.lit(f"{version}|{sorted(parameters.items())}")
    return F.sha2(F.concat_ws("|", told, "file", F.col("size").cast("string"), F.unix_micros("modified").cast("string")), 256)


def refresh(spark: SparkSession, root: str, out: str, work: Callable[[DataFrame], DataFrame], version: str, parameters: dict, folder: str = "episode_id bigint") -> int:
    """Bring the results under `out` up to date: recordings whose fingerprint is there already are not read again.

    work: messages of whole recordings (with file) -> a row for each file and more if it likes. Results lie in a partition for
    each recording, by its folder's column, which a run replaces as a whole and only when its rows are all written: one that
    is killed before leaves the earlier partition. Returns the number of recordings that were worked on.
    """
    key = folder.split()[0]
    marked = files(spark, root).withColumn("fingerprint", fingerprint(version, parameters))
    try:
        done = spark.read.parquet(out).select("fingerprint").distinct()
        pending = marked.join(done, "fingerprint", "left_anti")
    except Exception as e:  # nothing has been written yet
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        pending = marked
    at = scratch(spark)
    pending.select("file", "fingerprint").write.parquet(at)
    pending = spark.read.schema("file string, fingerprint string").parquet(at)
    n = pending.count()
    if n:
        good, _ = read_recordings(spark, root, folder)
        rows = work(good.join(pending.select("file"), "file", "left_semi")).join(pending, "file")
        rows.repartition(key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(out)
    return n
