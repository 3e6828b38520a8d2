import os

import duckdb
import pytest

from sluice import queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_against_sql(spark, duck, small, name):
    df = queries.QUERIES[name](spark, small)
    columns = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=str)
    want = duck.sql(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE[name]})").fetchall()
    assert got == sorted((tuple(map(plain, r)) for r in want), key=str)


def test_every_query_has_sql():
    assert set(queries.QUERIES) == set(queries.ORACLE)


def test_entry_module():
    import __spark_entry__ as entry

    assert set(queries.QUERIES) <= set(entry.queries())
    assert os.path.exists(entry.__file__)
