"""Registered queries against their SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from codexlake import queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return round(v, 8)
    return tuple(norm(x) for x in v) if isinstance(v, list | tuple) else v


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_against_sql(spark, duck, sf, name):
    df = queries.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    rows = [tuple(norm(r[c]) for c in cols) for r in df.collect()]
    r = duck.execute(queries.ORACLE[name])
    names = [d[0] for d in r.description]
    want = [tuple(norm(x[names.index(c)]) for c in cols) for x in r.fetchall()]
    assert sorted(names) == cols
    assert sorted(map(repr, rows)) == sorted(map(repr, want))


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_without_sql(spark, sf, name):
    assert queries.QUERIES[name](spark, sf).count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
