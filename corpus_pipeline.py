"""The corpus pipeline: stages over documents, each one of the operators of loomframe.llm.

Each stage works on all rows that the one before has kept. run() writes every stage's rows to the shared folder, so that
no stage's work is done twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.llm import common, language_id, packing, quality, simhash, suffix_dedup

#: Scores below which the quality and the language stage reject a document.
LEAST_QUALITY, LEAST_LANGUAGE = 0.3, 0.35
#: Words of a passage that counts as repeated, however few bytes they have.
REPEATED_WORDS = 50


def aside(docs: DataFrame, *names: str) -> tuple[DataFrame, list]:
    """Documents with their own columns of these names set aside, and the columns that bring all back."""
    new = {c: f"__own_{c}" for c in docs.columns if c in names}
    return docs.withColumnsRenamed(new), [F.col(f"`{new.get(c, c)}`").alias(c) for c in docs.columns]


def name(column: str):
    return F.col(f"`{column}`")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects what the quality classifier, trained on all labels, scores below LEAST_QUALITY."""
    docs, own = aside(docs, "score")
    weights = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, weights).where(F.col("score") >= LEAST_QUALITY).select(*own)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and those that no language fits; a null lang becomes the predicted one."""
    docs, own = aside(docs, "score", "lang_pred")
    known = language_id.train(docs)
    out = language_id.predict(docs, *known).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE))
    return out.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*own)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of copies and near copies the document with the smallest id stays, once; rows without an id stay.

    SimHash links and, for similar texts beyond its reach, min-hash bands give the candidates; exact Jaccard decides.
    Of rows with one id and text the one whose columns hash least stays.
    """
    docs, own = aside(docs, "component_id", "__id")
    found = simhash.near_duplicates(docs).withColumnRenamed("doc_id", "__id")
    out = docs.join(found, docs.doc_id == found["__id"], "left").where("component_id is null or component_id = doc_id").select(*own)
    one = out.where("doc_id is not null").groupBy("doc_id", "text").agg(F.min_by(F.struct(*map(name, out.columns)), F.xxhash64(*map(name, out.columns))).alias("one")).select("one.*")
    return out.where("doc_id is null").union(one)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages of 50 words or of 400 bytes that stand elsewhere too; n_chars is counted anew."""
    docs, own = aside(docs, "removed_spans")
    return suffix_dedup.remove(docs, words=REPEATED_WORDS).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*own)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs every document that is left into training sequences."""
    return packing.bins(docs)


STAGES = [("quality", keep_quality), ("language", keep_language), ("near_duplicates", drop_near_duplicates), ("repeats", cut_repeats), ("packing", pack)]

#: None of the learning, linking and packing stages can be said in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = common.Tables(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = tables.write(stage(spark, docs, sf_dir))
    return docs
