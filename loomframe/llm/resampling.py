"""Importance resampling towards a target corpus: hashed word n-grams, gains by bucket, a seeded draw of the highest scores."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.places import places
from . import common
from .crc_spans import crc32

#: Buckets of features, words in the longest feature, words a document needs to be drawn, share drawn in percent, seed.
BUCKETS, GRAMS, MIN_WORDS, PERCENT, SEED = 10_000, 3, 20, 5, 42
#: Bytes of text whose spans are hashed at once; bounds a task's memory however long a text is.
CHUNK_BYTES = 1 << 17

_byte = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte).astype(np.uint8)
# what is left outside a word once A-Z are in lower case: all ASCII but digits and a-z
_WORD = ~((_byte <= 0x2F) | ((_byte >= 0x3A) & (_byte <= 0x60)) | ((_byte >= 0x7B) & (_byte <= 0x7F)))


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text in lower case."""
    edge = np.diff(_WORD[data].astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def hashed(texts: list[memoryview]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Features of some texts, piece by piece: their buckets, the text of each, and the text of each of the piece's words.

    Texts lie in one buffer with a line feed between them. A piece has about CHUNK_BYTES of words and looks ahead by as many
    words as its last features need, so that a long text is hashed whole.
    """
    data = _LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
    start, end = words_of(data)
    owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), start, side="right")
    at = 0
    while at < len(start):
        own = max(1, int(np.searchsorted(end, start[at] + CHUNK_BYTES, side="right")) - at)
        here = slice(at, at + own + GRAMS - 1)
        a, who = start[here], owner[here]
        own, size = min(own, len(a)), end[here] - a
        first = np.cumsum(size + 1) - size - 1  # words joined by one space: every feature is a span
        last = first + size
        joined = np.full(int(last[-1]), 32, np.uint8)
        inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        joined[np.repeat(first, size) + inside] = data[np.repeat(a, size) + inside]
        spans = []
        for k in range(GRAMS):
            w = np.arange(min(own, len(a) - k))
            w = w[who[w] == who[w + k]]
            spans.append((first[w], last[w + k], who[w]))
        f, z, of = (np.concatenate(x) for x in zip(*spans))
        yield (crc32(joined, f, z - f) % BUCKETS).astype(np.int64), of, who[:own]
        at += own


def groups(batch: pa.RecordBatch) -> Iterator[tuple[int, list[memoryview]]]:
    """Texts of a batch that are hashed together, with the place of the first."""
    held, size, at = [], 0, 0
    for text in common.texts(batch):
        if held and size + len(text) > CHUNK_BYTES:
            yield at, held
            at, held, size = at + len(held), [], 0
        held.append(text)
        size += len(text)
    if held:
        yield at, held


def counts(docs: DataFrame) -> np.ndarray:
    """Features of all texts by bucket. Each task sends its sums only, and the driver gets a row a bucket."""

    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, texts in groups(batch):
                for bucket, _, _ in hashed(texts):
                    total += np.bincount(bucket, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    common.small_batches(docs.sparkSession)
    rows = docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a weight, in thousandths, rounded down."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """docs (doc_id, text) as (doc_id, n_words, n_features, weight), all long."""

    def sums(batches):
        for batch in batches:
            n, words, features, weight = batch.num_rows, *np.zeros((3, batch.num_rows), np.int64)
            for at, texts in groups(batch):
                for bucket, of, who in hashed(texts):
                    features += np.bincount(of + at, minlength=n)
                    words += np.bincount(who + at, minlength=n)
                    # sums of whole numbers below 2^53 are exact in doubles
                    weight += np.bincount(of + at, gain[bucket], n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([common.column(batch, "doc_id"), *map(pa.array, (words, features, weight))], ["doc_id", "n_words", "n_features", "weight"])

    common.small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(sums, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """Draw percent in a hundred of the documents of min_words words and more, without replacement, by their likeness to a target.

    docs: doc_id and text; target: text. Returns (doc_id, n_features, weight, score, rank), all long: rank counts the drawn
    from 1 by falling score, ties to the smaller doc_id, and is null for the others. Text in lower case (A-Z only) gives
    words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`; features are runs of 1 to 3 of them. Null, empty and wordless texts
    have no feature and weight 0. Each row is a document, also where rows repeat. Rows without a doc_id have a weight but
    no score, and are never drawn nor counted among those to draw from. An empty target gives every bucket its count's
    share; an empty table gives an empty one. Other columns do not pass.
    """
    spark = docs.sparkSession
    tables = common.Tables(spark)
    docs = docs.select("doc_id", "text")
    found = weigh(docs, gains(counts(docs), counts(target)))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    found = tables.write(found.withColumn("score", F.col("weight") + noise))
    fits = F.col("score").isNotNull() & (F.col("n_words") >= min_words)
    fit = found.where(fits)
    ranked = places(fit, [F.col("score").desc(), F.col("doc_id").asc(), F.col("n_features").asc()], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= fit.count() * percent // 100, F.col("rank")))
    out = ranked.union(found.where(~fits).withColumn("rank", F.lit(None).cast("long")))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
