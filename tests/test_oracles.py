"""Every registered query against its SQL oracle (DuckDB) on the same
tables: same columns, types, row count and values."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF001, SF01
from stationflow.plans.catalog import QUERIES as CATALOG

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
KEYS = sorted(CATALOG)


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    return v


def _sort_key(row):
    return tuple((v is None, "" if v is None else str(v)) for v in row)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{SF001}/lineitem.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(CATALOG) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["file_name", "month", "rank", "station", "connections"]
    assert df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF001)
    rel = duck.execute(entry.oracle_sql()[key])
    assert [f.name for f in df.schema.fields] == [d[0] for d in rel.description]
    assert [SPARK_TO_DUCK[f.dataType.simpleString()] for f in df.schema.fields] == [
        str(d[1]) for d in rel.description
    ]
    got = sorted((tuple(_norm(v) for v in r) for r in df.collect()), key=_sort_key)
    want = sorted((tuple(_norm(v) for v in r) for r in rel.fetchall()), key=_sort_key)
    assert len(got) == len(want)
    assert got == want


@pytest.mark.skipif(not os.path.exists(SF01), reason="sf0.01 not present")
@pytest.mark.parametrize("key", ["top_times_annual", "total_times_annual", "total_connections_all"])
def test_wider_scale_reports(spark, key):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{SF01}/lineitem.parquet')")
    got = sorted(tuple(r) for r in entry.queries()[key](spark, SF01).collect())
    want = sorted(tuple(r) for r in con.execute(entry.oracle_sql()[key]).fetchall())
    assert got == want
