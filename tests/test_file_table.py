import datetime

import pytest

from pyspark.sql import functions as F

from matchlake.operators.maintenance import list_files
from matchlake.plans import maintenance_suite
from matchlake.plans.file_table import FileTable, compaction_bins
from matchlake.plans.publish import Conflict
from matchlake.session import scratch

LATER = "2100-01-01 00:00:00"
SCHEMA = "match_id string, season string, total_runs int"


@pytest.fixture
def table(spark):
    return FileTable(spark, scratch(spark, "table"), SCHEMA)


def rows(spark, season, ids):
    return spark.range(ids.start, ids.stop).select(
        F.col("id").cast("string").alias("match_id"), F.lit(season).alias("season"), F.col("id").cast("int").alias("total_runs")
    )


def content(df):
    return sorted((r.season, int(r.match_id)) for r in df.select("season", "match_id").collect())


def test_bins_hold_about_the_target(spark):
    sizes = {f"s{i}": 10 + i % 7 for i in range(50)} | {"big": 90, "bigger": 500}
    files = spark.createDataFrame([(f, "a", n, 1) for f, n in sizes.items()] + [("alone", "b", 5, 1)], "file string, season string, bytes bigint, rows bigint")
    found = compaction_bins(files, 100).collect()
    assert {r.file for r in found} <= set(sizes) - {"big", "bigger"}  # large files and a lone one stay
    by_bin = {}
    for r in found:
        by_bin[r.id] = by_bin.get(r.id, 0) + r.bytes
    assert sorted(by_bin) == list(range(len(by_bin))) and all(n < 200 for n in by_bin.values())
    assert len(by_bin) == -(-sum(n for f, n in sizes.items() if f.startswith("s")) // 100)


@pytest.mark.parametrize("season", ["2007/08", "a+b %41", "x"])
def test_compaction_leaves_readers_and_large_files_alone(spark, table, season):
    table.append(rows(spark, season, range(0, 20_000)))
    for part in range(4):
        table.append(rows(spark, season, range(100_000 + part, 100_001 + part)))
    large = table.files().where("rows = 20000").first()
    before, reader = content(table.read()), table.read()
    done = table.compact(large.bytes)
    assert done == {"compacted_seasons": 1, "files_before": 4, "files_after": 1, "rows": 4}
    assert sorted((r.file == large.file, r.rows) for r in table.files().collect()) == [(False, 4), (True, 20_000)]
    assert content(reader) == content(table.read()) == content(table.read(5)) == before
    assert table.compact(large.bytes)["files_before"] == 0 and table.head() == 6


def test_replaced_seasons_and_numbers(spark, table):
    assert table.replace(rows(spark, "a", range(3)).unionByName(rows(spark, "b", range(3, 5)))) == 1
    table.replace(rows(spark, "a", range(7, 8)))
    assert content(table.read()) == [("a", 7), ("b", 3), ("b", 4)]
    assert content(table.read(1)) == [("a", 0), ("a", 1), ("a", 2), ("b", 3), ("b", 4)]
    assert content(table.read(seasons=["b"])) == [("b", 3), ("b", 4)] and content(table.read(seasons=[])) == []


def test_a_commit_meets_another(spark, table):
    table.append(rows(spark, "a", range(3)))
    parent = table.head()
    mine = table.stage(rows(spark, "a", range(3, 6)))
    table.append(rows(spark, "b", range(1)))
    assert table._commit(mine, "append", parent) == 3  # another season does not hinder it
    late = table.stage(rows(spark, "a", range(9, 10)))
    with pytest.raises(Conflict):
        table._commit(late, "append", parent)
    assert content(table.read()) == [("a", n) for n in range(6)] + [("b", 0)]
    assert not table._rename(f"{table.root}/_writes", f"{table.root}/_files/number=3")


def test_expired_files_and_lost_writes(spark, table):
    for part in range(3):
        table.append(rows(spark, "a", range(part, part + 1)))
    table.compact()
    table.stage(rows(spark, "a", range(50, 60)))
    today = str(datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None))
    assert table.expired_files(today, 7, 1).count() == 0 == table.orphaned_writes(today).count()
    # numbers 2 to 4 are kept: the files that 4 took away are still named by 2 and 3
    assert table.expired_files(LATER, 7, 3).count() == 0
    steps = maintenance_suite.run(table, LATER, keep=1, apply=True).collect()
    assert [(r.step, r.status, r.row_count, r.affected) for r in steps] == [
        ("health_check", "HEALTHY", 3, 1), ("compaction", "SUCCESS", 0, 0), ("version_expiry", "SUCCESS", None, 3),
        ("orphan_cleanup", "SUCCESS", None, 1), ("audit", "HEALTHY", 3, 1)]
    assert list_files(spark, f"{table.root}/data", "*.parquet").count() == 1
    assert table.expired_files(LATER, 7, 1).count() == 0 == table.orphaned_writes(LATER).count()


def test_empty(spark, table):
    assert table.read().collect() == [] and table.compact()["rows"] == 0 and table.head() == 0
    assert [r.status for r in maintenance_suite.run(table, LATER).collect()] == ["HEALTHY", "SUCCESS", "SUCCESS", "SUCCESS", "HEALTHY"]
    table.append(rows(spark, "a", range(0)))
    assert table.read().collect() == []


def test_a_missing_row_is_not_healthy(spark, table):
    table.append(rows(spark, "a", range(5)))
    entry = table.files().withColumns({"rows": F.lit(6).cast("bigint"), "added": F.lit(True)})
    table._commit(entry, "append", table.head())
    assert [r.status for r in maintenance_suite.run(table, LATER).collect()] == ["UNHEALTHY"]
