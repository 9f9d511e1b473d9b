"""SimHash near-duplicates, linked by deletion-variant signatures.

A fingerprint of 64 bits is cut into k // 2 + 1 segments, so that of two fingerprints that differ in at most k bits one
segment differs in at most one. Each segment is indexed once for each of its bits with that bit left out; equal variants
are joined and verified. Equal fingerprints are one row before that, so copies cost nothing.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from . import common

#: Rows of one block where fingerprints that share a variant are compared with each other.
BLOCK = 256
#: Fingerprints whose 64 variants each one task makes.
VARIANT_ROWS = 50_000
#: Texts of one block whose shingle sets are compared, and the min-hashes, a byte of each, that are looked at before.
COMPARE, MARKS = 128, 128
#: Bands of min-hashes and the min-hashes of each: at Jaccard 0.8 a pair shares no band with probability (1 - 0.8 ** 6) ** 40, 5e-6.
BANDS, ROWS = 40, 6
#: Shingles whose min-hashes are taken at once.
MIN_CHUNK = 1 << 8
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16


def bit_sums(h: np.ndarray) -> np.ndarray:
    """How many of the big-endian hashes set each bit, the highest first."""
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)


def majority(ones: np.ndarray, n: int) -> int:
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def set_fingerprint(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is set in over half of a set's hashes."""
    return majority(sum(bit_sums(hashes[at : at + CHUNK].astype(">u8")) for at in range(0, len(hashes), CHUNK)), len(hashes))


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """Bit i is 1 if it is set in over half of the hashes of the word shingles, repeats included; 0 without words."""
    w = text.lower().split()  # A-Z only, and ASCII white space
    if not w:
        return 0
    line = b" ".join(w)
    n = max(1, len(w) - words + 1)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[:n].tolist()
    ends = (ends[min(words, len(w)) - 1 :] - 1).tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        h = np.array([xxh64_intdigest(line[a:b], seed) for a, b in zip(starts[at : at + CHUNK], ends[at : at + CHUNK])], ">u8")
        ones += bit_sums(h)
    return majority(ones, n)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """Rows (id, fp long), one per input row. Null and empty texts, and texts of white space, have fingerprint 0."""
    common.small_batches(df.sparkSession)

    def run(batches):
        for b in batches:
            fps = [fingerprint(bytes(t), words) for t in common.texts(b, "text")]
            yield pa.record_batch([common.column(b, "id"), pa.array(fps, pa.int64())], ["id", "fp"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, fp bigint").withColumnRenamed("id", id_col)


def variants(fp: Column, bits: int) -> Column:
    """Array of 64 keys: a bit's number, and the bit's segment without it."""
    n = max(2, bits // 2 + 1)
    bounds = [round(64 * i / n) for i in range(n + 1)]
    keys = []
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        segment = F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
        keys += [segment.bitwiseAND(F.lit(((1 << (hi - lo)) - 1) & ~(1 << (bit - lo)))).bitwiseOR(F.lit(bit << 32)) for bit in range(lo, hi)]
    return F.array(*keys)


def links(fps: DataFrame, bits: int, tables: common.Tables) -> DataFrame:
    """Links (a, b) that connect all fingerprints (column fp, distinct) which differ in 1 to `bits` bits, 1 <= bits <= 31.

    A variant of two fingerprints is a pair. One of more goes to blocks, where all are compared and only the links that
    join two parts are kept: what is connected stays connected, and no group's pairs are written out.
    """
    # fingerprints are few bytes and would be read by few tasks; their variants are 64 times as many
    tasks = max(fps.sparkSession.sparkContext.defaultParallelism, -(-fps.count() // VARIANT_ROWS))
    every = fps.repartition(tasks, "fp").select("fp", F.explode(variants(F.col("fp"), bits)).alias("key"))
    shared = tables.write(every.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"))
    two = shared.where("n = 2").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits).select("a", "b")
    # never broadcast: keys of many grow with the table, and the same plan should hold at every size
    more = every.hint("merge").join(shared.where("n > 2").select("key", "n"), "key")
    dealt = common.block_pairs(more, "n", BLOCK, F.xxhash64("fp")).select("key", "bi", "bj", "mine", "fp")

    def run(batches):
        for g in common.sorted_groups(batches, ["key", "bi", "bj"]):
            fp, forest = g["fp"], common.Forest()
            same = g["bi"][0] == g["bj"][0]
            left, right = (fp, fp) if same else (fp[g["mine"] == g["bi"]], fp[g["mine"] == g["bj"]])
            for i, x in enumerate(left.tolist()):
                others = right[i + 1 :] if same else right
                for y in others[np.bitwise_count((others ^ x).view(np.uint64)) <= bits].tolist():
                    forest.link(x, y)
            if forest.kept:
                yield pa.record_batch([pa.array(v, pa.int64()) for v in zip(*forest.kept)], ["a", "b"])

    found = dealt.repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj").mapInArrow(run, "a bigint, b bigint")
    return two.union(found)


def classes(df: DataFrame, bits: int = 3, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, fp, component_id), one per input row: the smallest id reachable over links, itself included.

    Null ids are never the smallest; where a class has no other, component_id is null. Empty texts are copies of each
    other. An empty table gives an empty result; other columns are not read.
    """
    spark = df.sparkSession
    tables = common.Tables(spark)
    rows = tables.write(fingerprints(df, id_col, text_col, words))
    one = tables.write(rows.groupBy("fp").agg(F.min(id_col).alias("least")))
    part = common.components(spark, links(one.select("fp"), bits, tables), tables)
    part = one.join(part, one.fp == part.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    least = part.groupBy("component").agg(F.min("least").alias("component_id"))
    part = tables.write(part.join(least, "component").select("fp", "component_id"))
    return rows.join(part, "fp").select(id_col, "fp", "component_id")


def shingles(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; of all words where there are fewer."""
    w = text.lower().split()
    line, n = b" ".join(w), max(1, len(w) - words + 1)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) if w else np.ones(1, np.int64)
    starts = np.concatenate([[0], ends[:-1]])[:n].tolist()
    ends = (ends[min(words, len(ends)) - 1 :] - 1).tolist()
    return np.unique(np.fromiter((xxh64_intdigest(line[a:b]) for a, b in zip(starts, ends)), np.uint64, n))


@cache
def odd_factors(n: int) -> np.ndarray:
    return np.random.default_rng(42).integers(1 << 63, size=n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def min_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """The least of a set's hashes under each of n multiplications."""
    least = np.full(n, np.iinfo(np.uint64).max)
    factors = odd_factors(n)
    for at in range(0, len(hashes), MIN_CHUNK):
        np.minimum(least, (hashes[at : at + MIN_CHUNK, None] * factors).min(0), out=least)
    return least


def band_keys(hashes: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A key for each band of `rows` min-hashes of a set of hashes: two sets of Jaccard similarity s share one with probability s ** rows."""
    least = min_hashes(hashes, bands * rows)
    return np.array([xxh64_intdigest(b.tobytes(), i) for i, b in enumerate(least.reshape(bands, rows))], np.uint64).view(np.int64)


def similar(x: np.ndarray, y: np.ndarray, least: float) -> bool:
    """Jaccard similarity of two sorted distinct arrays; sizes alone often tell."""
    if min(len(x), len(y)) < least * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= least * (len(x) + len(y) - both)


def near_duplicates(df: DataFrame, words: int = 5, least: float = 0.8, bits: int = 3, bands: int = BANDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, component_id) of the non-null ids in groups of copies and near copies; component_id is the smallest id.

    Near copies have a Jaccard similarity of at least `least` over their sets of `words`-word shingles. Candidates are all
    texts whose SimHash fingerprints of that very set differ in at most `bits` bits, found by deletion variants, which is
    exact. Similar texts further apart than that come by bands beside it: texts that share one of `bands` keys, each of ROWS
    min-hashes of the set, so that neither a text's length nor its vocabulary matters; a pair of similarity s that SimHash
    doesn't reach is missed with probability (1 - s ** ROWS) ** bands. Of a fingerprint's and of a key's texts each is
    linked with the smallest id, so that no pairs are made. What candidates connect is
    compared exactly: each text with the smallest id of its candidates first, and those that aren't similar to that one with
    all others, in blocks, as far as MARKS min-hashes of a byte let them be similar (a similar pair fails that with a
    probability of 1e-6). One text stands for all of equal word sequences. Texts without words are copies of each other.
    An empty table gives no rows.
    """
    spark = df.sparkSession
    common.small_batches(spark)
    tables = common.Tables(spark)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id is not null")

    def sketch(batches):
        for b in batches:
            same, fps, keys = [], [], []
            for t in common.texts(b, "text"):
                t = bytes(t)
                same.append(xxh64_intdigest(b" ".join(t.lower().split()), 3) - (1 << 63))
                found = shingles(t, words)
                fps.append(set_fingerprint(found))
                keys.append(band_keys(found, bands))
            yield pa.record_batch([common.column(b, "id"), pa.array(same, pa.int64()), pa.array(fps, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["id", "same", "fp", "keys"])

    sketched = tables.write(rows.mapInArrow(sketch, "id bigint, same bigint, fp bigint, keys array<bigint>"))
    one = tables.write(sketched.groupBy("same").agg(F.min_by("keys", "id").alias("keys"), F.min_by("fp", "id").alias("fp"), F.min("id").alias("rep")))
    by_print = tables.write(one.groupBy("fp").agg(F.min("rep").alias("least")))
    near = links(by_print.select("fp"), bits, tables)
    near = near.join(by_print.select(F.col("fp").alias("a"), F.col("least").alias("x")), "a").join(by_print.select(F.col("fp").alias("b"), F.col("least").alias("y")), "b").select("x", "y")
    near = near.union(one.join(by_print, "fp").select("least", "rep"))
    keyed = tables.write(one.select("rep", F.explode("keys").alias("key")))
    shared = tables.write(keyed.groupBy("key").agg(F.min("rep").alias("a"), F.count("*").alias("n")).where("n > 1").select("key", "a"))
    edges = near.toDF("a", "b").union(keyed.join(shared, "key").select("a", F.col("rep").alias("b"))).where("a <> b")
    part = tables.write(common.components(spark, edges, tables))
    # of an id's texts the one with the least hash, so that a rerun takes the same
    members = part.withColumnRenamed("node", "id").join(rows, "id").groupBy("component", "id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def shingled(batches):
        for b in batches:
            sets = [shingles(bytes(t), words) for t in common.texts(b, "text")]
            marks = [min_hashes(x, MARKS).astype(np.uint8).tobytes() for x in sets]
            yield pa.record_batch([common.column(b, "component"), common.column(b, "id"), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64())), pa.array(marks, pa.binary())], ["component", "id", "set", "marks"])

    sets = tables.write(members.select("component", "id", "text").mapInArrow(shingled, "component bigint, id bigint, set array<bigint>, marks binary"))

    def by_leader(batches):
        for b in batches:
            ok = [similar(x.values.to_numpy(), y.values.to_numpy(), least) for x, y in zip(common.column(b, "set"), common.column(b, "leader"))]
            yield pa.record_batch([*(common.column(b, c) for c in ("component", "id", "set", "marks")), pa.array(ok)], ["component", "id", "set", "marks", "led"])

    leaders = sets.where("id = component").select("component", F.col("set").alias("leader"))
    led = tables.write(sets.join(leaders, "component").mapInArrow(by_leader, "component bigint, id bigint, set array<bigint>, marks binary, led boolean"))
    sizes = tables.write(led.groupBy("component").agg(F.count("*").alias("n"), F.count_if(~F.col("led")).alias("rest")).where("rest > 0"))
    blocks = lambda n: F.ceil(F.col(n) / COMPARE).cast("int")
    every = led.join(sizes, "component").withColumns({"bi": F.pmod(F.xxhash64("id"), blocks("n")).cast("int"), "bj": F.pmod(F.xxhash64("id"), blocks("rest")).cast("int")})
    # the rest against all: a block of all and a block of the rest meet
    all_side = every.select("component", "bi", F.explode(F.sequence(F.lit(0), blocks("rest") - 1)).alias("bj"), F.lit(False).alias("is_rest"), "led", "id", "set", "marks")
    rest_side = every.where("not led").select("component", F.explode(F.sequence(F.lit(0), blocks("n") - 1)).alias("bi"), "bj", F.lit(True).alias("is_rest"), "led", "id", "set", "marks")

    # the share of equal marks is the similarity but for 5 standard deviations
    enough = MARKS * (least - 5 * math.sqrt(least * (1 - least) / MARKS))

    def verify(batches):
        for g in common.sorted_groups(batches, ["component", "bi", "bj"]):
            forest, leader = common.Forest(), int(g["component"][0])
            rest, others = np.flatnonzero(g["is_rest"]).tolist(), np.flatnonzero(~g["is_rest"]).tolist()
            for j in others:
                if g["led"][j]:
                    forest.link(leader, int(g["id"][j]))
            known = len(forest.kept)
            marks = np.frombuffer(b"".join(g["marks"]), np.uint8).reshape(len(g["id"]), MARKS)
            for i in rest:
                alike = (marks[others] == marks[i]).sum(1) >= enough if others else []
                for j in np.array(others)[alike].tolist() if others else []:
                    x, y = int(g["id"][i]), int(g["id"][j])
                    if x != y and forest.root(x) != forest.root(y) and similar(g["set"][i], g["set"][j], least):
                        forest.link(x, y)
            if len(forest.kept) > known:
                yield pa.record_batch([pa.array([k[i] for k in forest.kept[known:]], pa.int64()) for i in (0, 1)], ["a", "b"])

    keys = ["component", "bi", "bj"]
    found = all_side.union(rest_side).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(verify, "a bigint, b bigint")
    found = found.union(led.where("led").select(F.col("component").alias("a"), F.col("id").alias("b")))
    copies = sketched.join(sketched.groupBy("same").agg(F.min("id").alias("a"), F.count("*").alias("c")).where("c > 1"), "same").select("a", F.col("id").alias("b"))
    return common.components(spark, found.union(copies), tables).select(F.col("node").alias(id_col), F.col("component").alias("component_id"))
