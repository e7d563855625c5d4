"""The whole maintenance sequence: health, compaction, expiry, orphans, audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.operators import maintenance
from matchlake.plans.file_table import FileTable
from matchlake.plans.publish import Store
from matchlake.sources.lakehouse import TARGET_FILE_BYTES


def versions_of(store: Store, table: str) -> DataFrame:
    """(table, version, created_at) from the commit log; a version still in use is not listed."""
    in_use = sorted(set(store.current().values()))
    written = store.commits().where("NOT removed").groupBy("version").agg(F.max("committed_at").alias("at"))
    free = written.where(~F.col("version").isin(in_use)) if in_use else written
    return free.select(F.lit(table).alias("table"), "version", F.col("at").cast("timestamp_ntz").alias("created_at"))


def run(
    table: FileTable, now: str, store: Store | None = None, days: int = maintenance.RETENTION_DAYS,
    keep: int = maintenance.KEPT_VERSIONS, apply: bool = False, target_bytes: int = TARGET_FILE_BYTES,
) -> DataFrame:
    """Run the five steps in order: (position, step, status, row_count, affected).

    Compaction is carried out. Files past their retention and what lost writes left behind, in ``table``
    and in ``store`` where one is given, are counted, and removed on ``apply``. A table whose files do not
    hold the rows that its log counts is not healthy, and an unhealthy one is not maintained.
    """
    spark, steps = table.spark, []

    def note(step: str, rows: int | None, affected: int | None, status: str = "SUCCESS") -> None:
        steps.append((len(steps) + 1, step, status, rows, affected))

    def check(step: str) -> bool:
        found = table.health()
        sound = found["found"] == found["rows"]
        note(step, found["found"], found["files"], "HEALTHY" if sound else "UNHEALTHY")
        return sound

    if check("health_check"):
        done = table.compact(target_bytes)
        note("compaction", done["rows"], done["files_before"] - done["files_after"])
        expired, lost = table.expired_files(now, days, keep), table.orphaned_writes(now, days)
        of_store = _of_store(spark, store, now, days) if store else ([], [])
        for step, paths, folders in (("version_expiry", expired, of_store[0]), ("orphan_cleanup", lost, of_store[1])):
            named = table.delete(paths) if apply else paths.count()
            note(step, None, named + _remove(spark, folders, apply))
        check("audit")
    return spark.createDataFrame(steps, "position int, step string, status string, row_count bigint, affected bigint")


def _of_store(spark: SparkSession, store: Store, now: str, days: int) -> tuple[list[str], list[str]]:
    """Folders of expired versions, and of runs that never committed."""
    expired = maintenance.expiry_plan(versions_of(store, "all"), now, days)
    folders = [f"{store.root}/*/version={row['version']}" for row in expired.select("version").collect()]
    orphans = maintenance.orphan_plan(maintenance.list_files(spark, store.root), store.commits(), now, days)
    parent = F.regexp_extract("path", "^(.*/version=[^/]+)/", 1)
    # whole version folders and single temporary files: one entry per abandoned run and table
    targets = orphans.select(F.when(F.col("version") != "", parent).otherwise(F.col("path")).alias("p")).distinct()
    return folders, [row["p"] for row in targets.collect()]


def _remove(spark: SparkSession, paths: list[str], apply: bool) -> int:
    if not apply:
        return len(paths)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for path in paths:
        pattern = jvm.org.apache.hadoop.fs.Path(path)
        matched = pattern.getFileSystem(conf).globStatus(pattern)
        found += [status.getPath().toString() for status in matched or []]
    return maintenance.delete_paths(spark, found)
