"""Every query against its SQL on the smallest tables; those without SQL run and have rows."""

from pathlib import Path

import duckdb
import pytest

from sentweave.plans import catalog

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=key)
    if name not in SQL:
        assert rows
        return
    rel = duck.sql(SQL[name])
    assert sorted(rel.columns) == columns
    want = sorted((tuple(plain(r[rel.columns.index(c)]) for c in columns) for r in rel.fetchall()), key=key)
    assert rows == want


def test_names_match():
    assert set(SQL) <= set(QUERIES) and len(QUERIES) > 60
