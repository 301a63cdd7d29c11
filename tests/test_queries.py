"""Every query with an SQL twin, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def db(tiny):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tiny}/{t}.parquet'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, db, tiny, name):
    df = entry.queries()[name](spark, tiny)
    cols = sorted(df.columns)
    cur = db.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = ordered(tuple(r[names.index(c)] for c in cols) for r in cur.fetchall())
    got = ordered(tuple(r) for r in df.select(*cols).collect())
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert all(
            x == y or (isinstance(x, float) and math.isclose(x, y, abs_tol=2e-6))
            for x, y in zip(g, w)
        ), (g, w)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "received_us", "p", "chunk_id"]
    assert df.count() > 0


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 90
