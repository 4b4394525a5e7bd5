"""Registered queries against their check SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from arealens.plans.standins import BASE_TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in BASE_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def same(a, b):
    if isinstance(a, float) or isinstance(b, float):
        return a is not None and b is not None and math.isclose(float(a), float(b), rel_tol=1e-9, abs_tol=1e-3)
    return a == b


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cursor = con.execute(ORACLES[name])
    found = [d[0] for d in cursor.description]
    assert sorted(found) == columns
    order = [found.index(c) for c in columns]

    def ordered(rows, places):
        return sorted(rows, key=lambda row: tuple((v is None, f"{v:.{places}f}" if isinstance(v, float) else str(v)) for v in row))

    want = [tuple(r[i] for i in order) for r in cursor.fetchall()]
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    assert len(got) == len(want)
    # Rows are lined up by rounded values; a value next to a rounding step may line up only at fewer places.
    assert any(all(same(x, y) for g, w in zip(ordered(got, places), ordered(want, places)) for x, y in zip(g, w)) for places in (6, 4, 2)), name


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_check_sql_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "AvgMinhh" in df.columns


def test_no_check_sql_without_query():
    assert set(ORACLES) <= set(QUERIES)
