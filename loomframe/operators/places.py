"""Places of rows in a global order, counted without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import io


def places(df: DataFrame, order: list[Column], name: str = "place", parts: int | None = None) -> DataFrame:
    """df with each row's place, from 1, in the given order.

    Rows are dealt by range, sorted in their part and written once with their part and number, so that the sizes that are
    counted belong to the very parts that are numbered, whatever a later plan or a lost task does. Before a part lie the
    sizes of those before it: a table of one row a part. Rows that tie take their order from a hash of their columns, which
    also deals a large tie to several parts; equal rows are numbered as they come. An empty table gives an empty one.
    """
    spark = df.sparkSession
    hashed = [F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    order = [*order, F.xxhash64(*hashed)]
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = io.scratch(spark)
    df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__row", F.monotonically_increasing_id()).write.parquet(at)
    # the id is the part's number in its upper bits, and the row's number in the part below
    rows = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("__row", T.LongType())])).parquet(at).withColumn("__part", F.shiftright("__row", 33))
    sizes = rows.groupBy("__part").agg(F.count("*").alias("__size"))
    before = F.sum("__size").over(Window.orderBy("__part")) - F.col("__size")
    out = rows.join(F.broadcast(sizes.select("__part", before.alias("__before"))), "__part")
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c != name], (F.col("__before") + F.col("__row").bitwiseAND((1 << 33) - 1) + 1).alias(name))
