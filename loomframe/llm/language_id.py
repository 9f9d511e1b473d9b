"""Language identification by a string kernel.

The kernel of two texts is the number of byte n-grams of 1 to 4 bytes that both hold (a blended spectrum of presences),
normalised. Kernel ridge regression, one language against the rest, is solved on Nystroem landmarks. A text's kernel row
times the coefficients is one product of its presences with (landmark presences x coefficients), made for a batch of texts
at once over the presences that aren't zero; n-grams are hashed to a table of fixed size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

SIZE_BITS, LENGTHS = 16, 4
SIZE = 1 << SIZE_BITS
#: Most texts that training reads (but one of each language at least), and how many of them are landmarks, shared evenly by the languages.
MAX_TRAIN, LANDMARKS = 2000, 256
RIDGE, SHARPNESS = 1e-3, 6.0
#: Texts of one matrix product; bytes whose n-grams are found at once.
ROWS, BLOCK = 64, 1 << 20
HAS_LETTER = regex.compile(r"\p{L}").search
ODD = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def presences(text: bytes, out: np.ndarray) -> None:
    """Set the places of a text's n-grams in a row of SIZE zeros."""
    for at in range(0, len(text), BLOCK):
        a = np.frombuffer(text[at : at + BLOCK + LENGTHS - 1], np.uint8).astype(np.uint32)
        gram = np.zeros(len(a), np.uint32)
        for n in range(LENGTHS):
            if len(a) <= n:
                break
            gram = (gram[: len(a) - n] << np.uint32(8)) | a[n:]
            h = (gram ^ (gram >> np.uint32(15))) * ODD[n]
            out[(h ^ (h >> np.uint32(13))) * ODD[(n + 1) % 4] >> np.uint32(32 - SIZE_BITS)] = 1


def product(flags: np.ndarray, m: np.ndarray) -> np.ndarray:
    """flags @ m for rows of mostly zeros: one sum of m's rows for each row of flags, no BLAS threads in a task."""
    at = [np.flatnonzero(row) for row in flags.view(bool)]
    n = np.array([len(x) for x in at])
    out = np.zeros((len(flags), m.shape[1]), np.float32)
    if n.any():
        out[n > 0] = np.add.reduceat(m[np.concatenate(at)], np.concatenate([[0], np.cumsum(n)[:-1]])[n > 0])
    return out


def lowered(text: bytes) -> bytes:
    return bytes(text).decode("utf-8", "replace").lower().encode()


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = MAX_TRAIN, landmarks: int = LANDMARKS) -> tuple[list[str], np.ndarray]:
    """Languages, and the matrix that presences are multiplied with, from rows with a non-null language.

    Every language is learned. Its share of max_rows, one row at least, is a sample by hash of the id; rows without a letter
    or an id take no part. Each language has a landmark at least, also where they are more than `landmarks`. The model has
    SIZE numbers (256 KB) for each language. Without rows there are no languages.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("id is not null and lang is not null and text is not null")
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return [], np.zeros((SIZE, 0), np.float32)
    each = max(1, max_rows // len(counts))
    place = F.xxhash64("id", F.lit("sample"))
    # a row a language
    cut = spark.createDataFrame([(lang, min(1.0, 1.5 * each / n + 20 / n)) for lang, n in counts.items()], "lang string, cut double")
    few = rows.join(F.broadcast(cut), "lang").where(F.pmod(place, F.lit(1_000_000)) < F.col("cut") * 1_000_000).where(F.col("text").rlike(r"\p{L}"))

    def extract(batches):
        for b in batches:
            packed = []
            for t in common.texts(b, "text"):
                row = np.zeros(SIZE, np.uint8)
                presences(lowered(t), row)
                packed.append(np.packbits(row).tobytes())
            yield pa.record_batch([common.column(b, "place"), common.column(b, "lang"), pa.array(packed, pa.binary())], ["place", "lang", "row"])

    ranked = few.withColumn("place", place).withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("place", "id", "text"))).where(F.col("r") <= each)
    got = sorted(ranked.select("place", "lang", "text").mapInArrow(extract, "place bigint, lang string, row binary").collect(), key=lambda r: (r.lang, r.place, bytes(r.row)))  # at most max_rows rows of SIZE bits
    langs = sorted({r.lang for r in got})
    if not langs:
        return [], np.zeros((SIZE, 0), np.float32)
    packed = np.stack([np.frombuffer(r.row, np.uint8) for r in got])
    lang = np.array([r.lang for r in got])

    size = np.sqrt(np.maximum(np.bitwise_count(packed).sum(axis=1, dtype=np.int64), 1)).astype(np.float32)
    chosen = np.concatenate([np.flatnonzero(lang == k)[: max(1, landmarks // len(langs))] for k in langs])
    marks = np.unpackbits(packed[chosen], axis=1).T.astype(np.float32) / size[chosen]  # SIZE x landmarks
    k_nm = np.concatenate([product(np.unpackbits(packed[at : at + 4], axis=1), marks) for at in range(0, len(packed), 4)]).astype(float) / size[:, None]
    k_mm = k_nm[chosen]
    y = np.where(lang[:, None] == np.array(langs)[None], 1.0, -1.0)
    coef = np.linalg.lstsq(k_nm.T @ k_nm + RIDGE * len(packed) * k_mm, k_nm.T @ y, rcond=None)[0]
    return langs, marks @ coef.astype(np.float32)


def predict(docs: DataFrame, langs: list[str], matrix: np.ndarray, text_col: str = "text") -> DataFrame:
    """All columns, lang_pred and score (0 to 1), in place of any of these names. Texts that are null or have no letter, and all if no language is known: und, 0."""
    docs, spark = docs.drop("lang_pred", "score"), docs.sparkSession
    common.small_batches(spark)
    shared = spark.sparkContext.broadcast((langs, np.hstack([matrix, np.ones((SIZE, 1), np.float32)])))

    def run(batches):
        langs, m = shared.value
        for b in batches:
            raw = [bytes(t) for t in common.texts(b, text_col)]
            pred, conf = ["und"] * len(raw), [0.0] * len(raw)
            with_letters = [i for i, t in enumerate(raw) if langs and HAS_LETTER(t.decode("utf-8", "replace"))]
            for at in range(0, len(with_letters), ROWS):
                part = with_letters[at : at + ROWS]
                flags = np.zeros((len(part), SIZE), np.uint8)
                for row, i in zip(flags, part):
                    presences(lowered(raw[i]), row)
                f = product(flags, m)
                f = f[:, :-1] / np.sqrt(np.maximum(f[:, -1:], 1))
                e = np.exp(SHARPNESS * (f - f.max(axis=1, keepdims=True)))
                e /= e.sum(axis=1, keepdims=True)
                for i, top, p in zip(part, e.argmax(axis=1).tolist(), e.max(axis=1).tolist()):
                    pred[i], conf[i] = langs[top], p
            yield pa.record_batch([*b.columns, pa.array(pred), pa.array(conf)], [*b.schema.names, "lang_pred", "score"])

    schema = docs.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return docs.mapInArrow(run, schema)
