"""Lakehouse maintenance: health, expiry of versions, orphaned files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RETENTION_DAYS = 7
KEPT_VERSIONS = 3


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(path, length, modificationTime) of all files below a folder; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length", "modificationTime")


def health(lake: DataFrame) -> DataFrame:
    """Status, rows and files of the table: one row."""
    return lake.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("_metadata.file_path").alias("file_count")
    ).select(F.lit("HEALTHY").alias("status"), "row_count", "file_count")


def expiry_plan(
    versions: DataFrame, now: str, days: int = RETENTION_DAYS, keep: int = KEPT_VERSIONS
) -> DataFrame:
    """Versions of a table older than ``days``, except its ``keep`` newest.

    ``versions``: table, version, created_at. Ranked per table; a table has one row per run.
    """
    newest_first = Window.partitionBy("table").orderBy(F.desc("created_at"), F.desc("version"))
    cutoff = F.lit(now).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")
    ranked = versions.select("*", F.row_number().over(newest_first).alias("age_rank"))
    return ranked.where((F.col("age_rank") > keep) & (F.col("created_at") < cutoff)).drop("age_rank")


def orphan_plan(files: DataFrame, referenced: DataFrame, now: str, days: int = RETENTION_DAYS) -> DataFrame:
    """Files older than ``days`` that are temporary, or belong to a version nothing refers to.

    ``referenced``: the versions named in the commit log. Files outside version folders are left alone.
    """
    cutoff = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS")
    version = F.url_decode(F.regexp_extract("path", "/version=([^/]+)/", 1))
    aged = files.where(F.col("modificationTime") < cutoff).withColumn("version", version)
    temporary = aged.where(F.col("path").endswith(".tmp"))
    in_version = aged.where((F.col("version") != "") & ~F.col("path").endswith(".tmp"))
    return temporary.unionByName(in_version.join(referenced.select("version").distinct(), "version", "left_anti"))


def delete_paths(spark: SparkSession, paths: list[str]) -> int:
    """Remove files or folders through Spark's own file-system layer; how many were removed."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        removed += bool(target.getFileSystem(conf).delete(target, True))
    return removed
