"""Domain tables read from the given tables, and the same tables as DuckDB SQL, for the registered queries."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ship import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Events by their role in a recording.
MASTER, STATE, ACTION, HAND, COMMAND = "view", "click", "purchase", "error", "signup"

#: Time buckets of the alignments, in microseconds: the stand-in logs have few messages a day.
BUCKET = 7 * 86_400_000_000


def with_tables(sql: str) -> str:
    """SQL with the tables that it names put before it, and those that these name; it may begin with --with and its own."""
    used, text = set(), sql
    while new := {n for n in TABLES if n not in used and re.search(rf"\b{n}\b", text)}:
        used |= new
        text += " ".join(TABLES[n] for n in new)
    own = sql.split("--with", 1)[1].strip() if sql.startswith("--with") else ""
    recursive = own.startswith("recursive ")
    tables = ", ".join(t for n, t in TABLES.items() if n in used)
    if not own:
        return f"WITH {tables} {sql}" if tables else sql
    return f"WITH {'RECURSIVE ' * recursive}{tables + ', ' if tables else ''}{own.removeprefix('recursive ')}"


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL it must agree with."""

    def add(f):
        @wraps(f)
        def run(spark, sf):
            ship(spark)
            return f(spark, sf)

        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = with_tables(sql)
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def messages(spark: SparkSession, sf: str) -> DataFrame:
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return table(spark, sf, "events").select(F.col("user_id").alias("episode_id"), F.col("event_type").alias("topic"), F.col("event_id").alias("seq"), us.alias("header_us"), (us + F.col("event_id") % 7 * 50_000).alias("bag_us"), F.array("value", (F.col("event_id") % 100).cast("double")).alias("values"))


def targets(spark: SparkSession, sf: str, topic: str = MASTER) -> DataFrame:
    from ..operators import clocks

    return clocks.master_clock(messages(spark, sf), topic)


def frames(spark: SparkSession, sf: str) -> DataFrame:
    part = lambda a, n: F.slice(F.col("embedding").cast("array<double>"), a, n)
    return table(spark, sf, "embeddings").select(F.expr("vec_id div 50").alias("episode_index"), (F.col("vec_id") % 50).alias("frame_index"), part(1, 16).alias("state"), part(17, 16).alias("action"), part(33, 32).alias("chunk"), "label")


#: DuckDB twins; a query that names one of them gets it.
TABLES = {
    "msgs": "msgs AS (SELECT user_id AS episode_id, event_type AS topic, event_id AS seq, epoch_us(ts) AS header_us, epoch_us(ts) + event_id % 7 * 50000 AS bag_us, value AS v0, CAST(event_id % 100 AS DOUBLE) AS v1 FROM events)",
    "tgts": "tgts AS (SELECT user_id AS episode_id, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts), event_id) - 1 AS frame_index, epoch_us(ts) AS t_us FROM events WHERE event_type = 'view')",
    "frms": "frms AS (SELECT vec_id // 50 AS episode_index, vec_id % 50 AS frame_index, CAST(embedding[1:16] AS DOUBLE[]) AS state, CAST(embedding[17:32] AS DOUBLE[]) AS action, CAST(embedding[33:64] AS DOUBLE[]) AS chunk, label FROM embeddings)",
    "eps": "eps AS (SELECT vec_id // 50 AS episode_index, count(*) AS n FROM embeddings GROUP BY 1)",
}


def episodes(spark: SparkSession, sf: str) -> DataFrame:
    return frames(spark, sf).groupBy("episode_index").agg(F.count("*").alias("n"))


def elements(df: DataFrame, keys: list[str], v: str) -> DataFrame:
    """A vector as one rounded row for each component."""
    return df.select(*keys, F.posexplode(v).alias("pos", "x")).withColumn("x", F.round("x", 6))
