"""Registered queries against their SQL. The slowest ones are left to tools/compare.py."""

import duckdb
import pytest

import __spark_entry__ as entry
from checks import registry
from tools.compare import TABLES, rows

SLOW = {
    "bucketed_increment", "load_after_season_delete", "load_quarantined_update", "load_partial_snapshot", "load_change_log", "load_stage_status", "backfill_range", "incremental_load", "silver_reload_idempotent", "stage_counts", "apply_changes_silver",
}
NAMES = [n for n in registry.QUERIES if n not in SLOW]


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, db, sf, name):
    df = entry.queries()[name](spark, sf)
    cursor = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, cursor.fetchall())


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() == 1500
