"""Every query with SQL agrees with DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from tessera.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def con():
    c = duckdb.connect()
    for name in os.listdir(SF):
        c.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return c


def plain(v):
    return float(f"{v:.9g}") if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_agrees(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    cur = con.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(plain(dict(zip(names, r, strict=True))[c]) for c in sorted(names)) for r in cur.fetchall()), key=repr)
    got = sorted((tuple(plain(r[c]) for c in sorted(names)) for r in df.collect()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, SF).count() >= 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 10
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
