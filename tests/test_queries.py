"""Registered queries against their SQL on the smallest test tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("orders", "lineitem", "part", "events", "customer", "supplier")
# One per family; the driver compares all of them at a larger scale.
CHECKED = [
    "mv_renewables_share_parsed", "parse_prices", "quarantine_generation", "modal_grain", "upsert_merge",
    "watermark_upsert", "dim_date", "dq_results", "dq_invariants", "demand_by_month_complete",
    "price_daily_avg30d", "price_min_max", "plan_daily", "landed_generation", "sink_upsert", "sink_delete",
    "sink_watermarks", "gate_effects", "mv_share_by_month_update", "mv_avg_price_by_month_update", "gold_row_counts",
]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    expected = con.sql(driver.oracle_sql()[name])
    df = driver.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    assert sorted(expected.columns) == columns
    place = [expected.columns.index(c) for c in columns]
    ours = sorted(repr(tuple(row[c] for c in columns)) for row in df.collect())
    theirs = sorted(repr(tuple(row[i] for i in place)) for row in expected.fetchall())
    assert ours == theirs
