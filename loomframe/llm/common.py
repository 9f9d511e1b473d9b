"""Shared pieces of the training-data operators: written tables, components, block pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ship import ship
from ..sources.io import remove, scratch

#: Rows of a batch handed to Python at once; texts are long, so fewer than Spark's default.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Before a table goes to Python: send the package, and lower the rows per Arrow batch unless the session already has fewer."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


class Tables:
    """Intermediate results written to the shared folder, so that lineage ends there."""

    def __init__(self, spark: SparkSession):
        ship(spark)
        self.spark, self.root = spark, scratch(spark)
        self.count = 0

    def write(self, df: DataFrame, *folders: str) -> DataFrame:
        """df as a table, in a folder for each value of the named columns."""
        self.count += 1
        path = f"{self.root}/t{self.count}"
        df.write.partitionBy(*folders).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._written_at = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a written table that no later plan reads."""
        remove(self.spark, df._written_at)


def components(spark: SparkSession, edges: DataFrame, tables: Tables | None = None) -> DataFrame:
    """Connected components of links (a, b), both long: rows (node, component), the smallest node.

    Alternates large-star and small-star contraction. Each half is a grouped minimum joined back to the links, so that
    no task gathers a node's neighbours, and hubs are left to the skew-join rule. Self links and repeated links change
    nothing; nodes without a link to another node have no row; an empty input gives an empty result.
    """
    tables = tables or Tables(spark)
    links = tables.write(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        new = tables.write(small.where("u <> v").distinct())
        tables.drop(links)
        links = new
        state = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def block_pairs(df: DataFrame, n: str, block: int, salt: F.Column) -> DataFrame:
    """Deal a group's rows to pairs of blocks, so that every two rows meet in a bounded group.

    df: rows with their group's size in column n. Adds bi <= bj and mine, the row's own block. A group of up to `block`
    rows is one pair (0, 0); a larger one has ceil(n / block) blocks and each of its rows goes to each pair with its own.
    """
    k = F.ceil(F.col(n) / F.lit(block)).cast("int")
    df = df.withColumn("mine", F.pmod(salt, k).cast("int"))
    other = F.explode(F.sequence(F.lit(0), k - 1)).alias("other")
    df = df.select("*", other)
    return df.withColumns({"bi": F.least("mine", "other"), "bj": F.greatest("mine", "other")}).drop("other")


def runs(key: np.ndarray) -> np.ndarray:
    """Bounds of the runs of equal values in a sorted array, its length last."""
    if not len(key):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])


class Forest:
    """Union-find over the members of one block; keeps the links that join two trees."""

    def __init__(self):
        self.up: dict = {}
        self.kept: list = []

    def root(self, x):
        up = self.up
        while (p := up.get(x, x)) != x:
            up[x] = up.get(p, p)
            x = p
        return x

    def link(self, a, b) -> None:
        a0, b0 = self.root(a), self.root(b)
        if a0 != b0:
            self.up[max(a0, b0)] = min(a0, b0)
            self.kept.append((a, b))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def texts(batch: pa.RecordBatch, name: str = "text"):
    """The texts of a batch as UTF-8 bytes, null as empty, without a Python string for each."""
    col = column(batch, name).cast(pa.large_binary()).fill_null(b"")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = memoryview(col.buffers()[2] or b"")
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        yield data[a:b]


def sorted_groups(batches, keys: list[str]):
    """Groups of rows with equal keys from batches sorted by them: dicts of arrays. A group may span batches."""
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        t = pa.concat_tables([held, t]) if held is not None else t
        new = np.zeros(t.num_rows, bool)
        for k in keys:
            v = t.column(k).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        at = [0, *np.flatnonzero(new).tolist()]
        cols = {n: t.column(n) for n in t.column_names}
        if len(at) > 1:
            arrays = {n: c.slice(0, at[-1]).to_numpy() for n, c in cols.items()}
            for a, z in zip(at[:-1], at[1:]):
                yield {n: v[a:z] for n, v in arrays.items()}
        held = t.slice(at[-1])
    if held is not None:
        yield {n: held.column(n).to_numpy() for n in held.column_names}
