"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader updates.

Words are runs of letters, of digits, or of other marks; a word in capitals counts as one and the same word, digits as 0.
Features are hashed one- and two-word n-grams (a word and itself again: always the same pair) with damped, normalised counts. A text's score is the sigmoid of a sparse
dot product. Training takes a bounded sample of the labelled rows, dealt to a fixed number of shards; each shard makes its
updates in a fixed order, and the shards' weights are averaged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

BUCKET_BITS, SHARDS, EPOCHS = 18, 4, 20
#: Most labelled rows that training reads; beyond it a sample by hash of the id.
MAX_TRAIN = 12_000
ALPHA, BETA, L1, L2 = 40.0, 1.0, 0.02, 0.0
#: Bytes whose words are found at once.
BLOCK = 1 << 20

KIND = np.full(256, 3, np.uint8)  # 0 white space, 1 letter, 2 digit, 3 other
KIND[[9, 10, 11, 12, 13, 32]] = 0
KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
KIND[48:58] = 2
LOWER = np.arange(256, dtype=np.uint64)
LOWER[65:91] += 32
LOWER[48:58] = 48
POWER = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))
MIX, CAPITALS, AGAIN = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x2545F4914F6CDD1D), np.uint64(0x94D049BB133111EB)


def words(data: bytes) -> np.ndarray:
    """A hash for each word of a text."""
    a = np.frombuffer(data, np.uint8)
    if not len(a):
        return np.empty(0, np.uint64)
    kind = KIND[a]
    cut = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
    length = np.diff(np.append(cut, len(a)))
    place = np.arange(len(a)) - np.repeat(cut, length)
    h = np.add.reduceat(LOWER[a] * POWER[place & 63], cut)
    upper = np.add.reduceat(((a >= 65) & (a <= 90)).astype(np.int64), cut)
    h[(upper == length) & (length > 1)] = CAPITALS
    h[kind[cut] == 2] = 48
    return h[kind[cut] != 0]


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a text: one- and two-word n-grams; values are 1 + log(count), with the text's length 1."""
    at, parts, carry = 0, [], np.empty(0, np.uint64)
    while at < len(text):
        end = at + BLOCK
        while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c" and end < at + 2 * BLOCK:
            end += 1
        w = words(text[at:end])
        with np.errstate(over="ignore"):
            both = np.concatenate([carry, w])
            parts.append(w * MIX)
            pair = both[:-1] * POWER[7] + both[1:]
            pair[both[:-1] == both[1:]] = AGAIN
            parts.append(pair * MIX)
        carry, at = both[-1:], end
    if not parts:
        return np.empty(0, np.int32), np.empty(0)
    h = np.concatenate(parts)
    bucket, n = np.unique(((h ^ (h >> np.uint64(32))) * MIX >> np.uint64(64 - BUCKET_BITS)).astype(np.int32), return_counts=True)
    value = 1 + np.log(n)
    return bucket, value / np.sqrt((value**2).sum()) if len(n) else value


class Leader:
    """Follow-the-regularised-leader updates of a logistic regression; the last weight is the bias."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, i=slice(None)) -> np.ndarray:
        z = self.z[i]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(self.n[i])) / ALPHA + L2))

    def update(self, i: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(i)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
        step = (np.sqrt(self.n[i] + g * g) - np.sqrt(self.n[i])) / ALPHA
        self.z[i] += g - step * w
        self.n[i] += g * g


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_TRAIN) -> np.ndarray:
    """Weights from the texts whose ids have a label 0 or 1; an id with differing labels counts as its smallest.

    At most about max_rows rows take part, a sample by hash of the id where there are more. Without a labelled row all
    weights are 0, and every score is one half.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)").groupBy("id").agg(F.min("y").alias("y"))
    share = max_rows / max(1, marks.count())
    if share < 1:
        marks = marks.where(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1_000_000)) < int(share * 1_000_000))
    # max_rows rows of an id and a mark: bounded, so it may be broadcast
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(marks), "id")

    def extract(batches):
        for b in batches:
            got = [features(bytes(t)) for t in common.texts(b, "text")]
            yield pa.record_batch([common.column(b, "id"), common.column(b, "y"), pa.array([g[0] for g in got], pa.list_(pa.int32())), pa.array([g[1].astype(np.float32) for g in got], pa.list_(pa.float32()))], ["id", "y", "i", "x"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        size = 1 << BUCKET_BITS
        leader, pdf = Leader(size), pdf.sort_values("place")
        rows = [(np.append(i, size), np.append(x, 1.0), y) for i, x, y in zip(pdf.i, pdf.x, pdf.y)]
        for _ in range(EPOCHS):
            for row in rows:
                leader.update(*row)
        w = leader.weights()
        at = np.flatnonzero(w)
        return pd.DataFrame({"i": [at.tolist()], "w": [w[at].tolist()]})

    sample = rows.mapInArrow(extract, f"id {docs.schema[id_col].dataType.simpleString()}, y int, i array<int>, x array<float>")
    sample = sample.withColumn("place", F.xxhash64("id", F.lit("place"))).withColumn("shard", F.pmod("place", F.lit(SHARDS)))
    weights = np.zeros((1 << BUCKET_BITS) + 1)
    fitted = sample.groupBy("shard").applyInPandas(fit, "i array<bigint>, w array<double>").collect()  # SHARDS sparse vectors
    for row in fitted:
        weights[row.i] += np.array(row.w) / len(fitted)
    return weights


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns and score (in place of one of that name): the chance of label 1. Null and empty texts get the score of a text without words."""
    docs = docs.drop("score")
    common.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        w = shared.value
        for b in batches:
            got = []
            for t in common.texts(b, text_col):
                i, x = features(bytes(t))
                got.append(w[-1] + w[i] @ x)
            p = 1 / (1 + np.exp(-np.clip(np.array(got), -30, 30)))
            yield pa.record_batch([*b.columns, pa.array(p)], [*b.schema.names, "score"])

    schema = docs.select("*", F.lit(0.0).alias("score")).schema
    return docs.mapInArrow(run, schema)
