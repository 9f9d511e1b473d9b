"""Lines that many documents share: levelled sorted runs of line hashes, merged now and then; DataFrame functions only.

A run is a bucketed, sorted table (h1, h2, docs, keep): a key's two hashes, the number of documents that hold it and the
largest of their ids. Runs share one bucketing, so a new batch is anti-joined with them bucket by bucket, without a
shuffle of what is stored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: White space cut from both ends of a line before its key is made.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Code points a key needs, documents that make it a shared one, batches of the table, runs of a level that are merged into one of the next.
MIN_CHARS, MIN_DOCS, BATCHES, FANOUT = 40, 5, 4, 2


def lines_of(text: Column) -> Column:
    """A text's lines; null is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class Runs:
    """Levelled sorted runs of line hashes.

    add() takes a batch of keys (h1, h2, doc), leaves out those that a stored run already counts in `least` documents or
    more, and adds the rest as a run of level 0; `fanout` runs of a level become one run of the next. The document kept
    for a key is the largest of the first batch that holds it, so batches come by falling ids where the largest of all
    is wanted. A key's count is exact until it reaches `least`, and at least that from there on.
    """

    def __init__(self, spark: SparkSession, tables: common.Tables, least: int = MIN_DOCS, fanout: int = FANOUT):
        self.spark, self.tables, self.least, self.fanout = spark, tables, least, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _write(self, df: DataFrame) -> str:
        name = f"loomframe_{uuid.uuid4().hex}"
        df = df.repartition(self.buckets, "h1", "h2")
        df.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", f"{self.tables.root}/{name}").saveAsTable(name)
        return name

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"drop table {name}")
            common.remove(self.spark, f"{self.tables.root}/{name}")

    def _summed(self, names: list[str]) -> DataFrame:
        # read as files: Spark 4.1 takes a union of bucketed tables as bucketed, and would sum each table's buckets apart
        df = self.spark.read.schema("h1 long, h2 long, docs long, keep long").parquet(*[f"{self.tables.root}/{n}" for n in names])
        return df.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("keep").alias("keep"))

    def add(self, keys: DataFrame) -> None:
        """keys: (h1, h2, doc), once or more for each key and document; rows with a null doc count for nothing."""
        once = keys.where("doc is not null").select("h1", "h2", "doc").distinct()
        new = once.groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("doc").alias("keep"))
        for level in self.levels:
            for run in level:
                new = new.join(self.spark.table(run).where(F.col("docs") >= self.least).select("h1", "h2"), ["h1", "h2"], "left_anti")
        self._put(0, self._write(new))

    def _put(self, level: int, run: str) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            old, self.levels[level] = self.levels[level], []
            merged = self._write(self._summed(old))
            self._drop(old)
            self._put(level + 1, merged)

    def shared(self) -> DataFrame:
        """(h1, h2, keep) of the keys that at least `least` documents hold."""
        runs = [r for level in self.levels for r in level]
        if not runs:
            return self.spark.createDataFrame([], "h1 long, h2 long, keep long")
        return self._summed(runs).where(F.col("docs") >= self.least).select("h1", "h2", "keep")

    def close(self) -> None:
        """Drop every run."""
        self._drop([r for level in self.levels for r in level])
        self.levels = []


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, row, pos, h1, h2) of every line whose key has min_chars code points; row tells texts of one id apart."""
    lines = docs.select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("row"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    lines = lines.where(F.length("line") >= min_chars).select("doc", "row", "pos", F.btrim("line", F.lit(SPACE)).alias("key")).where(F.length("key") >= min_chars)
    lines = lines.withColumn("key", F.translate("key", UPPER, LOWER))
    # two chained hashes with different seeds: 128 bits
    return lines.select("doc", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def drop_shared(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """Documents without the lines that min_docs documents share, but for the largest doc_id's copy.

    docs: doc_id and text, other columns pass. Adds n_lines and n_dropped, both long, and replaces text by what is left.
    Columns of these names give way. A line's key is the line without `[\\x20\\x09-\\x0D]` at both ends, A-Z in lower case;
    shorter keys than min_chars never go. A null or empty text is one empty line, and a null stays null. Rows with one
    doc_id are one document: a line counts once for them, and the largest id keeps its copies on each of its rows. Rows
    without a doc_id keep all their lines and count for nothing. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    tables = common.Tables(spark)
    docs = docs.drop("n_lines", "n_dropped")
    bounds = docs.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 10000)).first()[0] or [] if batches > 1 else []
    batch = F.lit(0)
    for b in sorted(set(bounds)):
        batch = batch + (F.col("doc") < F.lit(b)).cast("int")  # the largest ids come first
    keys = tables.write(line_keys(docs, min_chars).withColumn("batch", F.coalesce(batch, F.lit(0))), "batch")
    runs = Runs(spark, tables, min_docs, fanout)
    for b in range(len(set(bounds)) + 1):
        runs.add(keys.where(F.col("batch") == b).select("h1", "h2", "doc"))
    shared = tables.write(runs.shared())
    runs.close()
    # a line that a third of all documents hold is a skewed side of an inner join, which Spark splits
    gone = keys.join(shared, ["h1", "h2"]).where("doc <> keep").groupBy("doc", "row").agg(F.sort_array(F.collect_set("pos")).alias("__gone"))
    gone = tables.write(gone.withColumnsRenamed({"doc": "__doc", "row": "__row"}))
    out = docs.withColumn("__own", F.xxhash64("text")).join(gone, (F.col("doc_id") == F.col("__doc")) & (F.col("__own") == F.col("__row")), "left")
    lines, at = F.col("__lines"), F.col("__gone")
    # what stays are the stretches between dropped places, so that a long text costs no more than its length
    ends = F.concat(at, F.array(F.size(lines)))
    starts = F.concat(F.array(F.lit(0)), F.transform(at, lambda p: p + 1))
    kept = F.flatten(F.zip_with(starts, ends, lambda a, z: F.slice(lines, a + 1, z - a)))
    out = out.withColumn("__lines", lines_of(F.col("text")))
    text = F.when(at.isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c != "text"], text.alias("text"), F.size(lines).cast("long").alias("n_lines"), F.coalesce(F.size(at), F.lit(0)).cast("long").alias("n_dropped"))


def digest(out: DataFrame) -> DataFrame:
    """The columns of the query: kept_sha256 is of what is left, in UTF-8."""
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def sql() -> str:
    return rf"""
with lines as (
  select doc_id, unnest(string_split(text, chr(10))) as line from documents where text is not null
), keys as (
  select distinct doc_id, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), '{UPPER}', '{LOWER}') as k from lines
  where length(line) >= {MIN_CHARS}
), shared as (
  select k, max(doc_id) as keep from keys where length(k) >= {MIN_CHARS} group by k having count(distinct doc_id) >= {MIN_DOCS}
), gone as (
  select doc_id, list(k) as ks from keys join shared using (k) where doc_id <> keep group by doc_id
), parts as (
  select d.doc_id, coalesce(string_split(d.text, chr(10)), ['']) as ls, coalesce(ks, []) as ks from documents d left join gone using (doc_id)
), kept as (
  select doc_id, ls, case when ks = [] then ls else list_filter(ls, lambda x: not list_contains(ks, translate(trim(x, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), '{UPPER}', '{LOWER}'))) end as left_over from parts
)
select doc_id, len(ls)::bigint as n_lines, (len(ls) - len(left_over))::bigint as n_dropped,
       sha256(array_to_string(left_over, chr(10))) as kept_sha256
from kept
"""
