"""Every query with an oracle agrees with DuckDB; the others run."""

import os

import duckdb
import pytest

from timeline_engine import catalog

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(DIR, t)}.parquet'")
    return con


def values(rows, columns):
    fix = lambda v: round(v, 6) if isinstance(v, float) else tuple(v) if isinstance(v, list) else v
    return sorted((tuple(fix(r[c]) for c in columns) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, DIR)
    got = df.collect()
    if name not in catalog.ORACLE_SQL:
        assert len(got) > 0
        return
    found = duck.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    want = [dict(zip(names, r, strict=True)) for r in found.fetchall()]
    columns = sorted(names)
    assert sorted(df.columns) == columns
    assert values(got, columns) == values(want, columns)


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) <= set(entry.queries())
