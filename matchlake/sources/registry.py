"""Registry of source files by content fingerprint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(source_name, local_path, file_hash, file_size) of every file, hashed where it is read."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    )
    return files.select(
        F.regexp_extract("path", "([^/]+)$", 1).alias("source_name"),
        F.col("path").alias("local_path"),
        F.sha2("content", 256).alias("file_hash"),
        F.col("length").alias("file_size"),
    )


def unregistered(found: DataFrame, registry: DataFrame) -> DataFrame:
    """Files that are new, or whose content differs from what is registered."""
    return found.join(registry.select("source_name", "file_hash"), ["source_name", "file_hash"], "left_anti")


def register(found: DataFrame, registry: DataFrame) -> DataFrame:
    """The registry with new and changed files entered anew as AVAILABLE."""
    fresh = unregistered(found, registry).withColumn("status", F.lit("AVAILABLE"))
    kept = registry.join(fresh.select("source_name"), "source_name", "left_anti")
    return kept.select(*fresh.columns).unionByName(fresh)
