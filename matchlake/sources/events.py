"""The process-event log: normalising, appending and reading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.constants import TERMINAL_STATUSES
from matchlake.functions.numbers import half_up, seconds_between
from matchlake.schemas import PROCESS_EVENT

RECENT_EVENTS = 200


def normalize(raw: DataFrame) -> DataFrame:
    """Events as they enter the log.

    Missing start: the logging time. Missing end of a finished event: the logging time. Missing
    duration: end minus start, to the millisecond. ``logged_at`` is a column of ``raw``.
    """
    start = F.coalesce("event_timestamp", "logged_at")
    finished = F.col("status").isin(TERMINAL_STATUSES)
    end = F.coalesce(F.col("end_timestamp"), F.when(finished, F.col("logged_at")))
    elapsed = half_up(seconds_between(start, end), 3)
    return raw.select(
        "event_id",
        F.col("case_id").cast("string").alias("case_id"),
        F.lower("activity").alias("activity"),
        start.alias("event_timestamp"),
        end.alias("end_timestamp"),
        F.coalesce(F.col("duration_seconds"), elapsed).alias("duration_seconds"),
        F.upper("status").alias("status"),
        F.coalesce("records_processed", F.lit(0)).cast("int").alias("records_processed"),
        F.nullif("error_message", F.lit("")).alias("error_message"),
        F.coalesce("metadata", F.lit("{}")).alias("metadata"),
    )


def append(events: DataFrame, path: str) -> None:
    """Append to the log, partitioned by day of the event."""
    (
        events.withColumn("event_date", F.to_date("event_timestamp"))
        .write.partitionBy("event_date")
        .mode("append")
        .parquet(path)
    )


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROCESS_EVENT + ", event_date date").parquet(path)


def recent(events: DataFrame, n: int = RECENT_EVENTS) -> DataFrame:
    """The newest n events: a top-k, not a full sort."""
    return events.orderBy(F.desc("event_timestamp"), F.desc("event_id")).limit(n)


def of_case(events: DataFrame, case_id: str, n: int | None = None) -> DataFrame:
    """The events of one case, oldest first; a page of n on request."""
    ordered = events.where(F.col("case_id") == str(case_id)).orderBy("event_timestamp", "event_id")
    return ordered.limit(n) if n else ordered
