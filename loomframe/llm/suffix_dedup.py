"""Removal of long repeated passages, exact to the byte, over suffix arrays.

A passage is `size` bytes that start at more than one place. Its GRAM-byte substring with the least hash is the same
wherever the passage stands, so every passage start belongs to one such anchor, and equal passages to equal ones.

1. Each text gives its anchors and the hash of each anchor's context, the bytes of all passages that belong to it.
   Anchors whose gram stands alone end here.
2. A context that occurs again repeats whole. Contexts that differ though their grams agree are cut into blocks of STARTS
   neighbouring passage starts. All passages of a block share its core, so only blocks with equal cores can have some in
   common; where such blocks are not equal, the suffix array of the core's surroundings (the core one symbol) shows which.
3. The starts found for a context hold wherever it occurs; texts lose the bytes that any of their repeated passages covers.

Texts travel twice, keyed by a hash of id and text; all else is rows of a few numbers. Copies of a passage, however many,
are one row after the first grouped count.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_digest, xxh64_intdigest

from . import common
from .suffix_array import suffix_array

SIZE, GRAM, STARTS = 400, 128, 20
#: Bytes of a word's hash where passages are counted in words; a passage is many words, so chance never makes one.
WORD = 4
#: Passage starts of a text that are hashed at once, and the low bits of a hash that give way to a place among them.
CHUNK = 1 << 20
PLACES = np.uint64((1 << 22) - 1)
#: Anchors that go to Spark at once.
ROWS = 200_000
#: Symbols of one suffix array; blocks of one core from which single passages are counted instead.
SYMBOLS, MANY = 60_000, 2_000
#: Blocks that one task sorts, about.
SORT_ROWS = 20_000
DIGEST = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
BASE, MIX = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9)


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A mixed polynomial hash of the k bytes at each place, by doubling."""
    h, length, power, out, have = data.astype(np.uint64), 1, BASE, None, 0
    while True:
        if k & length:
            if out is None:
                out, have = h, length
            else:
                n = len(data) - have - length + 1
                out, have = out[:n] * np.uint64(power) + h[have : have + n], have + length
        if 2 * length > k:
            break
        n = len(data) - 2 * length + 1
        h = h[:n] * np.uint64(power) + h[length : length + n]
        length, power = 2 * length, power * power % (1 << 64)
    out = (out ^ (out >> np.uint64(31))) * MIX
    return out ^ (out >> np.uint64(29))


def least_in_window(h: np.ndarray, w: int) -> np.ndarray:
    """Place of the least value in each window of w, the first of those that are equal but for the bits of PLACES."""
    v, length = (h & ~PLACES) | np.arange(len(h), dtype=np.uint64), 1
    while length < w:
        step = min(length, w - length)
        v = np.minimum(v[:-step], v[step:])
        length += step
    return (v & PLACES).astype(np.int64)


def anchors(text: bytes, size: int, gram: int, unit: int = 1):
    """(gram hash, context hash, first start, number of starts, anchor's distance from the first start) of each anchor, in symbols of `unit` bytes."""
    gram = min(gram, size)
    for at in range(0, len(text) // unit - size + 1, CHUNK):
        part = text[at * unit : (at + CHUNK + size - 1) * unit]
        h = gram_hashes(np.frombuffer(part, f"<u{unit}"), gram)
        p = least_in_window(h, size - gram + 1)
        cut = common.runs(p)
        lo, n = cut[:-1], np.diff(cut)
        ctx = [xxh64_intdigest(part[a:z], 7) for a, z in zip((lo * unit).tolist(), ((cut[1:] - 1 + size) * unit).tolist())]
        yield h[p[lo]].view(np.int64), np.array(ctx, np.uint64).view(np.int64), lo + at, n, p[lo] - lo


def blocks(text: bytes, lo: int, n: int, rel: int, size: int, starts: int, unit: int = 1):
    """(block, core hash, bytes before the core, bytes after it, starts that lie before the core at least) of a context, all places in symbols of `unit` bytes.

    Block j has the starts whose distance before the anchor is j * starts to j * starts + starts - 1; the core is what
    all these passages share.
    """
    anchor = lo + rel
    for j in range((rel - n + 1) // starts, rel // starts + 1):
        most, least = min(rel, j * starts + starts - 1), max(rel - n + 1, j * starts)
        core = anchor - j * starts
        end = core + size - starts + 1
        before, after = core - most + j * starts, end + starts - 1 - (least - j * starts)
        yield j, xxh64_intdigest(text[core * unit : end * unit], 11), text[before * unit : core * unit], text[end * unit : after * unit], least - j * starts


def common_starts(rows: list[tuple[int, bytes, bytes, int]], starts: int, unit: int = 1) -> list[int]:
    """For each (core number, before, after, least) the starts it shares with another row of its core, as bits: bit a is the start a symbols before the core."""
    text, owner, back, at = [], [], [], 0
    sides = np.frombuffer(b"".join(side for r in rows for side in r[1:3]), f"<u{unit}")
    sides = (sides.astype(np.int64) + 2).tolist()
    for r, (core, before, after, _) in enumerate(rows):
        mid = at + len(before) // unit
        end = mid + len(after) // unit
        text += sides[at:mid]
        text.append((1 << 8 * unit) + 2 + core)
        text += sides[mid:end]
        text.append(1)
        owner += [r] * (end - at + 2)
        back += [*range(mid - at, -1, -1), *[-1] * (end - mid + 1)]
        at = end
    sa = np.array(suffix_array(text), np.int64)
    t, owner, back = np.array([*text, *[0] * starts]), np.array(owner), np.array(back)
    least = np.array([r[3] for r in rows])
    sa = sa[(back[sa] >= 0) & (back[sa] >= least[owner[sa]])]
    equal = np.ones(max(0, len(sa) - 1), bool)
    for k in range(starts):
        equal &= t[sa[:-1] + k] == t[sa[1:] + k]
    found = [0] * len(rows)
    for i in np.flatnonzero(equal).tolist():
        for s in (sa[i], sa[i + 1]):
            found[owner[s]] |= 1 << int(back[s])
    return found


def repeats(docs: DataFrame, text_col: str, key: str, tables: common.Tables, size: int = SIZE, gram: int = GRAM, starts: int = STARTS, many: int = MANY, unit: int = 1) -> DataFrame:
    """Rows (key, found): the contexts of a text's passages that start elsewhere too, once however many rows are equal to it.

    Texts are symbols of `unit` bytes, and sizes and places are counted in these.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text_col).alias("text"))

    def together(held):
        g, c, lo, n, rel = (np.concatenate(x) for x in list(zip(*held))[:5])
        k = np.repeat(np.array([x[5] for x in held], np.int64), [len(x[0]) for x in held])
        return pa.record_batch([pa.array(g), pa.array(c), pa.array(k), pa.array(lo.astype(np.int64)), pa.array(n.astype(np.int32)), pa.array(rel.astype(np.int32))], ["gram", "ctx", "key", "lo", "n", "rel"])

    def find(batches):
        held, n = [], 0
        for b in batches:
            for k, t in zip(common.column(b, "key").to_numpy().tolist(), common.texts(b, "text")):
                if len(t) >= size * unit:
                    for found in anchors(t, size, gram, unit):
                        held.append((*found, k))
                        n += len(found[0])
                        if n >= ROWS:
                            yield together(held)
                            held, n = [], 0
        if held:
            yield together(held)

    # equal rows have equal anchors: one row each, with the number of them
    every = rows.mapInArrow(find, "gram bigint, ctx bigint, key bigint, lo bigint, n int, rel int")
    every = tables.write(every.groupBy("gram", "ctx", "key", "lo", "n", "rel").agg(F.count("*").alias("c")))
    # counts are written before they are joined, so that a gram of very many anchors can be split
    again = tables.write(every.groupBy("gram").agg(F.sum("c").alias("c")).where("c > 1").select("gram"))
    kept = tables.write(every.join(again, "gram", "left_semi"))
    tables.drop(every)
    contexts = kept.groupBy("gram", "ctx").agg(F.sum("c").alias("c"), F.min(F.struct("key", "lo", "n", "rel")).alias("one"))
    contexts = tables.write(contexts.select("gram", "ctx", "c", "one.*"))
    differ = tables.write(contexts.groupBy("gram").agg(F.count("*").alias("m")).where("m > 1").select("gram"))
    wanted = contexts.join(differ, "gram", "left_semi").groupBy("key").agg(F.collect_list(F.struct("gram", "ctx", "c", "lo", "n", "rel")).alias("list"))

    def cut(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(9)]
            for t, many_ in zip(common.texts(b, "text"), common.column(b, "list")):
                for c in many_.as_py():
                    for j, core, before, after, least in blocks(t, c["lo"], c["n"], c["rel"], size, starts, unit):
                        for col, v in zip(out, (c["gram"], c["ctx"], c["c"] > 1, j, core, bytes(before), bytes(after), least, len(before) // unit)):
                            col.append(v)
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.uint64(), pa.binary(), pa.binary(), pa.int32(), pa.int32()]
            cols = [pa.array(v, k) for v, k in zip(out, kinds)]
            cols[4] = pa.array(cols[4].to_numpy().view(np.int64))
            yield pa.record_batch(cols, ["gram", "ctx", "whole", "j", "core", "before", "after", "least", "most"])

    cut_schema = "gram bigint, ctx bigint, whole boolean, j int, core bigint, before binary, after binary, least int, most int"
    pieces = tables.write(rows.join(wanted, "key").select("text", "list").mapInArrow(cut, cut_schema))
    sides = ["gram", "core", "before", "after"]
    one = pieces.groupBy(*sides).agg(F.max("whole").alias("whole"), F.min("ctx").alias("c0"), F.max("ctx").alias("c1"), F.first("least").alias("least"), F.first("most").alias("most"))
    one = tables.write(one.select(*sides, (F.col("whole") | (F.col("c0") != F.col("c1"))).alias("whole"), "least", "most"))
    counts = one.groupBy("gram", "core").agg(F.count("*").alias("m"), F.bool_and("whole").alias("all_whole")).where("m > 1 and not all_whole")
    mixed = tables.write(one.join(counts, ["gram", "core"]))
    some = mixed.where(F.col("m") <= many)

    def sort(batches):
        held: list = []
        symbols, cores = 0, 0

        def done():
            rows = [(c, bytes(b), bytes(a), int(least)) for c, g in held for b, a, least in zip(g["before"], g["after"], g["least"])]
            bits = common_starts(rows, starts, unit)
            cat = lambda n: np.concatenate([g[n] for _, g in held])
            return pa.record_batch([pa.array(cat("gram")), pa.array(cat("core")), pa.array(cat("before"), pa.binary()), pa.array(cat("after"), pa.binary()), pa.array(bits, pa.int64())], [*sides, "bits"])

        for g in common.sorted_groups(batches, ["gram", "core"]):
            held.append((cores, g))
            cores += 1
            symbols += (sum(map(len, g["before"])) + sum(map(len, g["after"]))) // unit + 2 * len(g["core"])
            if symbols >= SYMBOLS:
                yield done()
                held, symbols, cores = [], 0, 0
        if held:
            yield done()

    columns = [*sides, "least"]
    # sorting takes time, not bytes: enough tasks, which Spark would otherwise size by bytes
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-mixed.count() // SORT_ROWS))
    by_array = some.select(*columns).repartition(tasks, "gram", "core").sortWithinPartitions("gram", "core").mapInArrow(sort, "gram bigint, core bigint, before binary, after binary, bits bigint")
    # cores with many surroundings: each passage is a row of its own, and rows are counted
    ends = mixed.where(F.col("m") > many).select(*columns, F.explode(F.sequence("least", "most")).alias("a"))
    passage = ends.withColumn("p", F.concat(F.substring("before", F.length("before") - F.col("a") * unit + 1, F.col("a") * unit), F.substring("after", F.lit(1), (F.lit(starts - 1) - F.col("a")) * unit)))
    twice = passage.groupBy("gram", "core", "a", "p").agg(F.count("*").alias("c")).where("c > 1").drop("c")
    by_count = passage.join(twice, ["gram", "core", "a", "p"]).groupBy(*sides).agg(F.expr("bit_or(shiftleft(1L, a))").alias("bits"))
    every_bit = F.expr("shiftleft(1L, most + 1) - shiftleft(1L, least)")
    bits = by_array.union(by_count).union(one.where("whole").select(*sides, every_bit.alias("bits"))).where("bits <> 0")
    hit = pieces.where("not whole").select("gram", "ctx", "j", *sides[1:]).join(bits, sides).groupBy("gram", "ctx").agg(F.collect_list(F.struct("j", "bits")).alias("hits"))
    flags = contexts.select("gram", "ctx", (F.col("c") > 1).alias("whole")).join(hit, ["gram", "ctx"], "left").where(F.col("whole") | F.col("hits").isNotNull())
    flags = tables.write(flags.select("gram", "ctx", F.when(~F.col("whole"), F.col("hits")).alias("hits")))
    for done in (again, contexts, differ, pieces, one, mixed):
        tables.drop(done)
    found = tables.write(kept.join(flags, ["gram", "ctx"]).groupBy("key").agg(F.collect_list(F.struct("lo", "n", "rel", "hits")).alias("found")))
    tables.drop(kept)
    tables.drop(flags)
    return found


def united(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint spans, in order, that cover the same places."""
    if not len(first):
        return first, end
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.concatenate([[True], first[1:] > end[:-1]]))
    return first[new], end[np.append(new[1:] - 1, len(end) - 1)]


def covered(found: pa.StructArray, size: int, starts: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs (first places, ends) that the passages found cover."""
    lo, n, rel = (found.field(c).to_numpy().astype(np.int64) for c in ("lo", "n", "rel"))
    hits = found.field("hits")
    whole = hits.is_null().to_numpy(zero_copy_only=False)
    first, end = [lo[whole]], [lo[whole] + n[whole] - 1 + size]
    if not whole.all():
        flat = hits.flatten()
        owner = np.repeat(np.arange(len(found)), np.where(whole, 0, hits.value_lengths().fill_null(0).to_numpy()))
        j, bits = (flat.field(c).to_numpy().astype(np.int64) for c in ("j", "bits"))
        row, back = np.nonzero(bits[:, None] >> np.arange(starts) & 1)
        at = (lo + rel)[owner[row]] - j[row] * starts - back
        first.append(at)
        end.append(at + size)
    return united(np.concatenate(first), np.concatenate(end))


def hashed_words(rows: DataFrame, text_col: str, key: str) -> DataFrame:
    """Rows (key, text): a text's white-space words, each as a hash of WORD bytes."""

    def run(batches):
        for b in batches:
            yield pa.record_batch([common.column(b, "key"), pa.array([b"".join(map(xxh32_digest, bytes(t).split())) for t in common.texts(b, "text")], pa.binary())], ["key", "text"])

    return rows.select(F.col(key).alias("key"), F.col(text_col).alias("text")).mapInArrow(run, "key bigint, text binary")


SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_spans(text: bytes, found: pa.StructArray, size: int, starts: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the words that passages found among the hashes of a text's words cover whole."""
    inside = np.diff(np.concatenate([[False], ~SPACE[np.frombuffer(text, np.uint8)], [False]]).view(np.int8))
    word, stop = np.flatnonzero(inside == 1), np.flatnonzero(inside == -1)
    first, end = covered(found, size, starts)
    return word[first], stop[end - 1]


def remove(docs: DataFrame, text_col: str = "text", size: int = SIZE, gram: int = GRAM, starts: int = STARTS, many: int = MANY, digest: bool = False, words: int | None = None) -> DataFrame:
    """All columns, text_col without the bytes that a repeated passage of `size` bytes covers, and removed_spans.

    words: passages of so many white-space words that stand elsewhere go too, however few bytes they have and whatever
    white space parts their words.

    Texts count as UTF-8 bytes; matches never cross rows, and are judged on the input. removed_spans: array of (first
    byte, end). Null texts stay null; a character that loses some of its bytes goes whole. With digest=True come n_bytes (of
    the input), n_removed, n_spans and kept_sha256 (of the exact remaining bytes), all of passages of `size` bytes alone,
    whatever `words` says; a null text counts as empty. Rows that are equal in id and text repeat each other. Columns of
    these names are replaced. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    tables = common.Tables(spark)
    docs = docs.drop("removed_spans", *(DIGEST if digest else []))
    names = docs.columns
    ids = [c for c in ("doc_id",) if c in names]
    keyed = docs.withColumn("__key", F.xxhash64(*ids, text_col))
    found = repeats(keyed, text_col, "__key", tables, size, gram, starts, many).select(F.col("key").alias("__key"), F.col("found").alias("__found"))
    if words:
        hashed = tables.write(hashed_words(keyed, text_col, "__key"))
        by_words = repeats(hashed, "text", "key", tables, words, min(GRAM, words * WORD // 3) // WORD or 1, min(STARTS // WORD, words), many, WORD)
        tables.drop(hashed)
        found = found.join(by_words.select(F.col("key").alias("__key"), F.col("found").alias("__by_words")), "__key", "full")

    def left(t, first, end):
        return b"".join(t[a:z] for a, z in zip([0, *end.tolist()], [*first.tolist(), len(t)]))

    def run(batches):
        for b in batches:
            spans, offsets, kept, numbers = [np.empty((2, 0), np.int64)], [0], [], []
            null = common.column(b, text_col).is_null().to_pylist()
            word_found = common.column(b, "__by_words") if words else pa.nulls(b.num_rows)
            for t, f, w, none in zip(common.texts(b, text_col), common.column(b, "__found"), word_found, null):
                first, end = covered(f.values, size, starts) if f.is_valid else (np.empty(0, np.int64),) * 2
                rest = left(t, first, end)
                if digest:
                    numbers.append((len(t), int((end - first).sum()), len(first), hashlib.sha256(rest).hexdigest()))
                if w.is_valid:
                    more_first, more_end = word_spans(t, w.values, words, min(STARTS // WORD, words))
                    first, end = united(np.concatenate([first, more_first]), np.concatenate([end, more_end]))
                    rest = left(t, first, end)
                spans.append(np.stack([first, end]))
                offsets.append(offsets[-1] + len(first))
                kept.append(None if none else rest.decode("utf-8", "ignore") if len(first) else rest.decode())
            cols = {c: common.column(b, c) for c in names}
            cols[text_col] = pa.array(kept, pa.string())
            flat = np.concatenate(spans, axis=1)
            cols["removed_spans"] = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(flat[0], pa.int64()), pa.array(flat[1], pa.int64())], ["first", "end"]))
            if digest:
                cols |= {n: pa.array([x[i] for x in numbers], pa.string() if n == "kept_sha256" else pa.int64()) for i, n in enumerate(DIGEST)}
            yield pa.record_batch(list(cols.values()), list(cols))

    more = {"removed_spans": F.array(F.struct(F.lit(0).cast("long").alias("first"), F.lit(0).cast("long").alias("end")))}
    if digest:
        more |= {n: F.lit("" if n == "kept_sha256" else 0).cast("string" if n == "kept_sha256" else "long") for n in DIGEST}
    schema = docs.select("*", *[v.alias(k) for k, v in more.items()]).schema
    out = keyed.join(found, "__key", "left").drop("__key").mapInArrow(run, schema)
    return out if digest else out.select(*[F.col(c) for c in [*names, "removed_spans"]])
