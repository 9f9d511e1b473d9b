"""Which recordings stand behind which output: manifests as edges, chains of joins, nested trims, set algebra on ids.

edges: output, source, start, end (half open, in the source's kept frames).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids, key, "left_semi")


def skip(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids, key, "left_anti")


def missing_ids(ids: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """Requested ids that are absent."""
    return ids.select(key).distinct().join(df, key, "left_anti")


def trace_sources(manifests: list[DataFrame]) -> DataFrame:
    """Last manifest's outputs to the first one's sources: one equi-join a manifest."""
    last = manifests[-1].select("output", "source")
    for m in reversed(manifests[:-1]):
        last = last.withColumnRenamed("source", "mid").join(m.select(F.col("output").alias("mid"), "source"), "mid").select("output", "source")
    return last.distinct()


def all_sources_qualified(edges: DataFrame, ok: DataFrame) -> DataFrame:
    """Outputs and whether each of their sources is listed."""
    marked = edges.join(ok.select("source").distinct().withColumn("ok", F.lit(True)), "source", "left")
    return marked.groupBy("output").agg(F.count("*").alias("sources"), F.bool_and(F.coalesce("ok", F.lit(False))).alias("qualified"))


def compose_trims(edges: DataFrame, trims: DataFrame) -> DataFrame:
    """Segments in raw frames: the raw trim's start shifted by the segment, and not beyond its end. trims: source, raw_start, raw_end."""
    start, end = F.col("raw_start") + F.col("start"), F.least(F.col("raw_start") + F.col("end"), F.col("raw_end"))
    return edges.join(trims, "source").select("output", "source", start.alias("start"), end.alias("end")).where(F.col("end") > F.col("start"))


def remap_kept(trims: DataFrame, key: str) -> DataFrame:
    """Number among the kept, for each recording that isn't dropped."""
    return trims.where("not dropped").select(key, (F.row_number().over(Window.orderBy(key)) - 1).cast("long").alias("kept_index"))


def traceability(edges: DataFrame, *tables: tuple[DataFrame, str]) -> DataFrame:
    """Edges with each table's columns, by left joins in turn."""
    return reduce(lambda out, t: out.join(t[0], t[1], "left"), tables, edges)


def source_histogram(edges: DataFrame, ok: DataFrame, most: int) -> DataFrame:
    """Outputs by their number of listed sources, 0 to most, counts of 0 included."""
    marked = edges.join(ok.select("source").distinct().withColumn("ok", F.lit(1)), "source", "left")
    n = marked.groupBy("output").agg(F.count("ok").alias("n")).groupBy("n").agg(F.count("*").alias("outputs"))
    bins = edges.sparkSession.range(most + 1).withColumnRenamed("id", "n")
    return bins.join(n, "n", "left").select("n", F.coalesce("outputs", F.lit(0)).cast("long").alias("outputs"))


def compare_frames(old: DataFrame, new: DataFrame, v: str = "action") -> DataFrame:
    """Mean and largest difference by episode."""
    both = old.select("episode_index", "frame_index", F.col(v).alias("a")).join(new.select("episode_index", "frame_index", F.col(v).alias("b")), ["episode_index", "frame_index"])
    d = both.select("episode_index", F.explode(F.zip_with("a", "b", lambda x, y: F.abs(x - y))).alias("d"))
    return d.groupBy("episode_index").agg(F.avg("d").alias("mae"), F.max("d").alias("max"))


def schema_diff(features: DataFrame, reference: str) -> DataFrame:
    """Features whose description differs from the reference dataset's, or that one side lacks. features: dataset, name, description."""
    ref = features.where(F.col("dataset") == reference).select("name", F.col("description").alias("expected"))
    # the reference's features travel as one row to each dataset: a schema's length, whatever the number of datasets
    wanted = ref.agg(F.collect_list(F.struct("name", "expected")).alias("w"))
    every = features.where(F.col("dataset") != reference).select("dataset").distinct()
    wanted = every.join(F.broadcast(wanted)).select("dataset", F.inline("w"))
    return wanted.join(features.where(F.col("dataset") != reference), ["dataset", "name"], "full").where("expected is distinct from description").select("dataset", "name", "expected", F.col("description").alias("found"))


def check_counts(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys whose numbers of rows differ."""
    count = lambda df, n: df.groupBy(key).agg(F.count("*").alias(n))
    out = count(a, "n_a").join(count(b, "n_b"), key, "full").select(key, F.coalesce("n_a", F.lit(0)).alias("n_a"), F.coalesce("n_b", F.lit(0)).alias("n_b"))
    return out.where("n_a <> n_b")


def trims_outside(trims: DataFrame, master: DataFrame, key: str) -> DataFrame:
    """Trims that aren't a non-empty part of their recording's master clock. trims: key, start, end; master: one row a frame."""
    n = master.groupBy(key).agg(F.count("*").alias("frames"))
    out = trims.join(n, key, "left").withColumn("frames", F.coalesce("frames", F.lit(0)))
    inside = (F.col("start") >= 0) & (F.col("start") < F.col("end")) & (F.col("end") <= F.col("frames"))
    return out.where(~F.coalesce(inside, F.lit(False))).select(key, "start", "end", "frames")


def lookup(df: DataFrame, dim: DataFrame, key: str, value: str, default: str) -> DataFrame:
    """A dimension's value, with a default where there is none."""
    return df.join(dim, key, "left").withColumn(value, F.coalesce(value, F.lit(default)))
