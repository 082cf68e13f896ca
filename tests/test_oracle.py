"""Every registered query of the engine against its SQL in DuckDB."""

import datetime
import os
from collections import Counter

import duckdb
import pytest

from studyloom import registry
from studyloom.plans.adapters import TABLES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return round(v, 6)
    return str(v) if isinstance(v, (datetime.date, datetime.datetime)) else tuple(v) if isinstance(v, list) else v


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_equals_sql(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = con.execute(registry.ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    got = Counter(tuple(map(plain, r)) for r in df.select(*columns).collect())
    assert got == Counter(tuple(plain(r[i]) for i in at) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_runs_without_sql(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0
