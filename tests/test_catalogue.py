"""Each query against its SQL twin in DuckDB, on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{SF}/{name}'")
    return con


def cell(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return "-"
    if isinstance(x, float) and not isinstance(x, bool):
        return f"{x:.6g}"
    return f"{x:.6g}" if isinstance(x, int) and not isinstance(x, bool) and abs(x) < 1e5 else str(x)


def table(rows):
    return sorted(str({k: cell(r[k]) for k in sorted(r)}) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toArrow().to_pylist()
    if name in ORACLES:
        cursor = duck.execute(ORACLES[name])
        names = [d[0] for d in cursor.description]
        assert table(got) == table(dict(zip(names, r, strict=True)) for r in cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())
