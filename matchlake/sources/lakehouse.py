"""The season-partitioned Parquet table: DDL, idempotent writes, pruned reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from matchlake.schemas import LAKEHOUSE

TARGET_FILE_BYTES = 256 * 1024 * 1024
ROWS_PER_FILE = 2_000_000


def create_table(spark: SparkSession, name: str, location: str, provider: str = "parquet") -> None:
    """Namespace and partitioned table. ``provider='iceberg'`` works where that catalog is configured."""
    if "." in name:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({LAKEHOUSE}) USING {provider} "
        f"PARTITIONED BY (season) LOCATION '{location}' "
        "TBLPROPERTIES ('write.format.default'='parquet', 'parquet.compression'='zstd')"
    )


def write_seasons(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Replace exactly the seasons present in ``df``, leaving the others untouched.

    The rows of a season are spread over several writers by a rebalance, which Spark's adaptive
    execution sizes at run time and splits where one season is much larger than the rest.
    """
    # the table's own types: totals of one match fit into an INT, those of the fact are wider
    typed = [F.col(f.name).cast(f.dataType) for f in StructType.fromDDL(LAKEHOUSE).fields]
    balanced = df.select(*typed).hint("rebalance", "season")
    (
        balanced.write.partitionBy("season")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(path)
    )


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Typed read: no inference, and the season stays text."""
    return spark.read.schema(LAKEHOUSE).parquet(path)
