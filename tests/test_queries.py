"""Every registered query against its SQL on the smallest tables; those without SQL give rows."""

import math
import os

import duckdb
import pytest

from loomframe.plans import QUERIES, SQL

from .conftest import SF


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


def plain(v):
    return ("nan" if math.isnan(v) else round(v, 5) + 0.0) if isinstance(v, float) else v


def key(row):
    return tuple((x is None, str(x) if not isinstance(x, (int, float)) else "", x if isinstance(x, (int, float)) else 0) for x in row)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(x) for x in r) for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=key)
    res = duck.execute(SQL[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in res.fetchall()), key=key)
    assert got == want


@pytest.mark.parametrize(("name", "files"), [("session_split", 3), ("telemetry_window", 8), ("join_steps", 3), ("align_stream", 3), ("align_stream_interp", 3), ("align_stream_nearest", 3)])
def test_a_part_of_a_stream_may_be_several_files(spark, duck, sf, name, files):
    """No row is late because another file of its part was read before."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": str(files)}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        test_same_as_sql(spark, duck, sf, name)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns
