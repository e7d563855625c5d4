"""Lakehouse maintenance."""

from pyspark.sql import functions as F

from checks.registry import check
from checks.serving import LAKE_COLUMNS, lake, written_lake
from checks.views import sql
from matchlake.operators import lakehouse, maintenance
from matchlake.plans import maintenance_suite
from matchlake.plans.file_table import FileTable
from matchlake.plans.publish import Store
from matchlake.session import scratch
from matchlake.sources import adapters
from matchlake.sources import lakehouse as lake_table

NOW = "2100-01-01 00:00:00"


def fragmented(spark, sf):
    """The lakehouse table in three commits, so in up to three files a season."""
    table = FileTable(spark, scratch(spark, "fragmented"))
    rows = lake(spark, sf).select(
        *LAKE_COLUMNS, F.lit(None).cast("string").alias("raw_payload"), F.current_timestamp().alias("ingested_at")
    )
    for part in range(3):
        table.append(rows.where(F.month("match_date") % 3 == part))
    return table


@check("lh_health", sql("match", "SELECT 'HEALTHY' AS status, count(*) AS row_count FROM match"))
def lh_health(spark, sf):
    return maintenance.health(lake_table.read_table(spark, written_lake(spark, sf))).drop("file_count")


@check(
    "lh_compact",
    sql("lake", "SELECT season, count(*) AS record_count, 1 AS file_count, CAST(sum(total_runs) AS BIGINT) AS total_runs, count(*) AS seen_by_reader FROM lake GROUP BY 1"),
)
def lh_compact(spark, sf):
    """A reader that opened the table before compaction still sees all its rows afterwards."""
    table = fragmented(spark, sf)
    reader = table.read().groupBy("season").agg(F.count("*").alias("seen_by_reader"))
    table.compact()
    after = table.read()
    totals = after.groupBy("season").agg(F.sum("total_runs").alias("total_runs"))
    return lakehouse.partitions(after).join(totals, "season").join(reader, "season")


PARTS = "part AS (SELECT season, count(DISTINCT month(match_date::DATE) % 3) AS files, count(*) AS n FROM lake GROUP BY 1)"


@check(
    "lh_files",
    sql("lake", "SELECT season, (month(match_date::DATE) % 3) + 1 AS number, count(*) AS row_count FROM lake GROUP BY ALL"),
)
def lh_files(spark, sf):
    """What the log of the table says of its files, without opening a folder."""
    table = fragmented(spark, sf)
    named = table.log().where("added").select("file", "number")
    return table.files().join(named, "file").select("season", F.col("number").cast("bigint").alias("number"), F.col("rows").alias("row_count"))


@check("lh_ddl", sql("lake", "SELECT season, count(*) AS record_count, CAST(sum(total_wickets) AS BIGINT) AS total_wickets FROM lake GROUP BY 1"))
def lh_ddl(spark, sf):
    """The table made by its DDL, filled and read by its name."""
    path = scratch(spark, "ddl")
    name = "lake_" + path.rsplit("-", 1)[1]
    for _ in range(2):  # making it again changes nothing
        lake_table.create_table(spark, name, path)
    rows = lake(spark, sf).select("*")
    rows.select(*spark.table(name).columns).write.insertInto(name)
    return spark.table(name).groupBy("season").agg(F.count("*").alias("record_count"), F.sum("total_wickets").alias("total_wickets"))


VERSIONS = (
    "ver AS (SELECT venue AS \"table\", season || '-' || substr(strftime(match_date, '%Y-%m'), 6) AS version, "
    "max(match_date)::TIMESTAMP AS created_at FROM match GROUP BY 1, 2)"
)


@check(
    "lh_expire_plan",
    sql(
        "match",
        "SELECT \"table\", version FROM (SELECT *, row_number() OVER (PARTITION BY \"table\" ORDER BY created_at DESC, version DESC) AS n FROM ver) "
        "WHERE n > 3 AND created_at < TIMESTAMP '2000-01-01' - INTERVAL 7 DAY",
        VERSIONS,
    ),
)
def lh_expire_plan(spark, sf):
    versions = adapters.matches(spark, sf).groupBy(
        F.col("venue").alias("table"), F.date_format("match_date", "yyyy-MM").alias("version")
    ).agg(F.max("match_date").cast("timestamp_ntz").alias("created_at"))
    return maintenance.expiry_plan(versions, "2000-01-01 00:00:00").select("table", "version")


@check(
    "lh_orphan_plan",
    sql("match", "SELECT DISTINCT 'run-2' AS version, season FROM match WHERE season >= '1998'"),
)
def lh_orphan_plan(spark, sf):
    """A run that wrote but never committed leaves exactly its own files as orphans."""
    store = Store(spark, scratch(spark, "orphans"))
    matches = adapters.matches(spark, sf)
    store.write("match", matches, "run-1")
    store.commit("run-1", [str(y) for y in range(1990, 2010)])
    store.write("match", matches.where("season >= '1998'"), "run-2")
    files = maintenance.list_files(spark, store.root, "*.parquet")
    orphans = maintenance.orphan_plan(files, store.commits(), NOW)
    season = F.regexp_extract("path", "/season=([^/]+)/", 1)
    return orphans.select("version", season.alias("season")).distinct()


@check(
    "lh_maintenance",
    sql(
        "lake",
        "SELECT 1 AS position, 'health_check' AS step, 'HEALTHY' AS status, sum(n)::BIGINT AS row_count, sum(files)::BIGINT AS affected FROM part UNION ALL "
        "SELECT 2, 'compaction', 'SUCCESS', sum(n) FILTER (files > 1)::BIGINT, sum(files - 1)::BIGINT FROM part UNION ALL "
        "SELECT 3, 'version_expiry', 'SUCCESS', NULL, sum(files) FILTER (files > 1)::BIGINT FROM part UNION ALL "
        "SELECT 4, 'orphan_cleanup', 'SUCCESS', NULL, 1 UNION ALL "
        "SELECT 5, 'audit', 'HEALTHY', sum(n)::BIGINT, count(*) FROM part",
        PARTS,
    ),
)
def lh_maintenance(spark, sf):
    """All five steps, with a write that was lost before its commit among the orphans."""
    table = fragmented(spark, sf)
    table.stage(table.read())
    return maintenance_suite.run(table, NOW, keep=1, apply=True)
