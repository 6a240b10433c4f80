"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import math
from pathlib import Path

import pytest

import __spark_entry__ as driver
from queries import oracle_sql, queries

duckdb = pytest.importorskip("duckdb")
FOLDER = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem pages".split()

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are missing")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def sort_key(row):
    return [repr(round(v, 8)) if isinstance(v, float) else repr(v) for v in row]


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, database, name):
    frame = queries()[name](spark, str(FOLDER))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "MapInPandas"):
        assert unwanted not in plan
    columns = sorted(frame.columns)
    found = [tuple(row) for row in frame.select(*columns).collect()]
    result = database.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = [tuple(row[names.index(c)] for c in columns) for row in result.fetchall()]
    assert len(found) == len(expected)
    for got, want in zip(sorted(found, key=sort_key), sorted(expected, key=sort_key), strict=True):
        for a, b in zip(got, want, strict=True):
            if isinstance(a, float) and isinstance(b, float):
                assert math.isclose(a, b, rel_tol=0, abs_tol=2e-10)
            else:
                assert a == b


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert [r.position for r in rows] == list(range(1, 21))
