"""Message topics to features: a table of builders, each a column function of a topic's payload."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: feature key: (topic, function of the payload column). A topic may feed many keys; a pandas UDF is a column function too.
Builders = dict[str, tuple[str, Callable[[Column], Column]]]


def build(messages: DataFrame, builders: Builders, payload: str = "values") -> DataFrame:
    """Rows (all columns, key, vector): each message once for every key that its topic feeds; other topics leave."""
    topics = sorted({t for t, _ in builders.values()})
    each = [F.when(F.col("topic") == t, F.struct(F.lit(key).alias("key"), fn(F.col(payload)).alias("vector"))) for key, (t, fn) in builders.items()]
    return messages.where(F.col("topic").isin(topics)).select("*", F.explode(F.array_compact(F.array(*each))).alias("f")).select(*messages.columns, "f.*")


def require(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that have all of some vectors: neither null nor empty."""
    for k in keys:
        df = df.where(F.col(k).isNotNull() & (F.size(k) > 0))
    return df


def path_id(path: str | Column, n: int = 10) -> Column:
    """A short id of a recording from its path."""
    return F.substring(F.sha1(F.col(path) if isinstance(path, str) else path), 1, n)
