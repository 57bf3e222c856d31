"""The named queries as the driver sees them, on the smallest test tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from workload import catalogue
from tools.check_oracles import TABLES, kind, table

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(catalogue.QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["forecast_date", "localTime"] and df.count() > 0


@pytest.mark.parametrize("name", [
    "silver_forecasts", "state_extremes_all_days", "merge_newer", "scd2_from_snapshots", "run_summary_daily", "cost_summary", "dq_summary",
    "pii_kpis", "find_orphans", "versioned_table", "zordered_layout",
])
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, str(SF))
    cursor = db.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert table(df.collect(), df.columns) == table(cursor.fetchall(), names)
    types = {r[0]: r[1] for r in db.execute(f"DESCRIBE {entry.oracle_sql()[name]}").fetchall()}
    assert {c: kind(t) for c, t in df.dtypes} == types
