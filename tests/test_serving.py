import pytest

from checks.serving import written_lake
from matchlake.operators import analytics, gold, lakehouse
from matchlake.operators.analytics import Filters
from matchlake.sources import adapters
from matchlake.sources import lakehouse as lake_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_season_filter_prunes_partitions(spark, sf):
    table = lake_table.read_table(spark, written_lake(spark, sf))
    text = plan(lakehouse.season_matches(table, "1998"))
    assert "PartitionFilters: [isnotnull(season" in text
    assert "raw_payload" not in text


def test_filters_reach_the_scan(spark, sf):
    path = written_lake(spark, sf)
    table = lake_table.read_table(spark, path)
    text = plan(analytics.select_matches(table, Filters(venue="2-HIGH")).select("match_id"))
    assert "EqualTo(venue,2-HIGH)" in text


def test_team_dimension_has_no_nested_loop(spark, sf):
    df = gold.team_dimension(adapters.teams(spark, sf), adapters.matches(spark, sf), adapters.deliveries(spark, sf))
    assert "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)


@pytest.mark.parametrize("statement", ["DROP TABLE x", "", "insert into x values (1)", "selection"])
def test_console_refuses(spark, statement):
    with pytest.raises((PermissionError, ValueError)):
        lakehouse.run_readonly(spark, statement)


def test_console_runs(spark):
    assert lakehouse.run_readonly(spark, " select 1 as x").first()["x"] == 1
    assert lakehouse.run_readonly(spark, "SHOW TABLES").columns


def test_sample_is_limited_to_known_tables(spark, sf):
    tables = {"match": adapters.matches(spark, sf)}
    assert analytics.table_sample(tables, "match", "1998", order=["match_id"]).count() == 10
    with pytest.raises(PermissionError):
        analytics.table_sample(tables, "passwords")


def test_ddl(spark, tmp_path):
    lake_table.create_table(spark, "lake_matches", str(tmp_path / "t"))
    assert spark.catalog.tableExists("lake_matches")
    assert [r["col_name"] for r in spark.sql("DESCRIBE lake_matches").collect()][0] == "match_id"
    spark.sql("DROP TABLE lake_matches")


def test_upsert_keeps_what_vanished(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    assert sorted(map(tuple, gold.upsert(old, new, "k").collect())) == [("a", 1), ("b", 3), ("c", 4)]
