"""Variable-capacity best-fit packing of documents into training sequences.

A document is as long as its words (runs of anything but white space) and one end mark. Those longer than the longest
permitted sequence are cut into pieces of that length and a rest. Pieces are dealt by hash to shards of bounded size, and
each shard is packed by decreasing length: a piece goes to the open bin that it leaves least room in; if none has room, a
bin is opened at the permitted length with the least cost for each token that can still fill it. In the end each bin
shrinks to the smallest permitted length that holds its contents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

LENGTHS = (512, 1024, 2048, 4096)
#: Cost of a bin besides its length, in tokens.
FIXED_COST = 64
#: Pieces of a shard, about.
SHARD = 20_000


def pack(lengths: np.ndarray, sizes: tuple[int, ...], fixed: int = FIXED_COST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset in it and capacity of each length; lengths are 1 to max(sizes), in the order to place them."""
    most = max(sizes)
    counts = np.bincount(lengths, minlength=most + 1)
    below = np.cumsum(counts * np.arange(most + 1))  # tokens of pieces up to a length, not yet placed
    left_tokens = int(below[-1])
    rooms: list[list[int]] = [[] for _ in range(most + 1)]  # open bins by room
    open_rooms = 0  # bit r: some bin has room r
    bins, offsets, filled, size_of = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), [], []
    for i, n in enumerate(lengths.tolist()):
        fits = open_rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                open_rooms ^= 1 << room
        else:
            # what can still come is no longer than n and at most left_tokens: the least cost for each token
            b, cost = len(filled), lambda s: ((s + fixed) / min(s, left_tokens), s)
            room = min((s for s in sizes if s >= n), key=cost)
            filled.append(0)
            size_of.append(room)
        bins[i], offsets[i] = b, filled[b]
        filled[b] += n
        left_tokens -= n
        room -= n
        if room:
            if not rooms[room]:
                open_rooms |= 1 << room
            rooms[room].append(b)
    ordered = np.array(sorted(sizes))
    shrunk = ordered[np.searchsorted(ordered, np.array(filled, np.int64))] if filled else np.empty(0, np.int64)
    return bins, offsets, shrunk[bins]


def pieces(docs: DataFrame, most: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, hash, piece, start, length): pieces of up to `most` tokens. Null and empty texts are an end mark alone."""
    n = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"\S+")).cast("long") + 1
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("hash"), n.alias("n"))
    each = F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(most).cast("long")))
    return rows.select("id", "hash", "n", each.alias("piece", "start")).select("id", "hash", "piece", "start", F.least(F.lit(most), F.col("n") - F.col("start")).cast("int").alias("length"))


def bins(docs: DataFrame, sizes: tuple[int, ...] = LENGTHS, fixed: int = FIXED_COST, shard: int = SHARD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, piece, start, length, bin_id, bin_offset, capacity): every token of every row in one bin.

    start counts words in the text, and the end mark is the last token of the last piece. bin_id is shard * 2**32 + bin.
    Repeated rows are packed each; null ids stay null. The shard of a piece depends on its row's id and text, so that rows
    that are equal share one: a copied row that makes a third of the table is spread by its place in the input instead.
    An empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    tables = common.Tables(spark)
    cut = tables.write(pieces(docs, max(sizes), id_col, text_col).withColumn("salt", F.monotonically_increasing_id()))
    shards = max(1, -(-cut.count() // shard))
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("hash", "piece", "salt"), F.lit(shards)).cast("int"))

    def run(batches):
        for g in common.sorted_groups(batches, ["shard"]):
            b, o, c = pack(g["length"], sizes, fixed)
            n = len(b)
            yield pa.record_batch([pa.array(g["id"], id_type, from_pandas=True), pa.array(g["piece"]), pa.array(g["start"]), pa.array(g["length"]), pa.array(b + (g["shard"].astype(np.int64) << 32)), pa.array(o), pa.array(c.astype(np.int32) if n else c, pa.int32())], ["id", "piece", "start", "length", "bin_id", "bin_offset", "capacity"])

    kind = docs.schema[id_col].dataType
    id_type = pa.int64() if kind.simpleString() == "bigint" else pa.int32() if kind.simpleString() == "int" else pa.string()
    order = [F.col("shard"), F.desc("length"), F.col("hash"), F.col("piece")]
    rows = dealt.repartition(shards, "shard").sortWithinPartitions(*order).select("shard", F.coalesce("id", F.lit(None)).alias("id"), "piece", "start", "length")
    out = rows.mapInArrow(run, f"id {kind.simpleString()}, piece int, start bigint, length int, bin_id bigint, bin_offset bigint, capacity int")
    return out.withColumnRenamed("id", id_col)
