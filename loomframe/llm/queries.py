"""Queries of the training-data operators: (spark, sf_dir) -> DataFrame, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, html_text, language_id, license_scan, line_dedup, near_vectors, packing, quality, resampling, simhash, suffix_dedup, token_alignment, topk


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(n: int, col: str = "doc_id") -> Column:
    return F.crc32(F.col(col).cast("string")) % n


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.classes(table(spark, sf_dir, "embeddings"), 0.93)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    weights = quality.train(docs, labels.where(fold(5) != 0))
    out = quality.score(docs, weights)
    return out.select("doc_id", (fold(5) == 0).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.where("vec_id % 100 = 0"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.classes(table(spark, sf_dir, "documents"), bits=3, words=3)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.bins(table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    langs, matrix = language_id.train(docs.where(fold(3) != 1))
    out = language_id.predict(docs.drop("lang"), langs, matrix)
    return out.select("doc_id", (fold(3) == 1).alias("held_out"), "lang_pred", "score")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's numbers are of 400-byte strings; text is what is left once passages of 50 words, often shorter, go too."""
    out = suffix_dedup.remove(table(spark, sf_dir, "documents").select("doc_id", "text"), digest=True, words=50)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.drop_shared(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return token_alignment.align(table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_near_vectors, op2_quality, op3_html_text, op4_license_scan, op5_topk, op6_simhash, op7_packing, op8_byte_bpe, op9_language_id, op10_suffix_dedup, op11_line_dedup, op12_resampling, op13_token_alignment)}
SQL: dict[str, str] = {"op4_license_scan": license_scan.sql(), "op11_line_dedup": line_dedup.sql()}
