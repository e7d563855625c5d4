"""The standing reports on process events."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.constants import EXTREME_LATENCY_SECONDS, SLA_REPORT_SECONDS
from matchlake.functions.numbers import exact, half_up, ratio, seconds, seconds_between
from matchlake.functions.scans import SLICE, slice_rows, split_hot
from matchlake.functions.text import event_season

AUDIT_ROWS = 50
PATH_SEPARATOR = " -> "
PATH_ROWS = 100_000


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def _last_seen() -> Column:
    return F.coalesce("end_timestamp", "event_timestamp")


def _micros(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def lead_time(events: DataFrame) -> DataFrame:
    """Average, least and greatest lead time over cases of at least two events: one row."""
    cases = events.groupBy("case_id").agg(
        F.min("event_timestamp").alias("first"), F.max(_last_seen()).alias("last"), F.count(F.lit(1)).alias("n")
    )
    spans = cases.where("n >= 2").select("case_id", _micros(F.col("first"), F.col("last")).alias("micros"))
    return spans.agg(
        F.count("case_id").alias("total_cases"),
        ratio(seconds(F.sum("micros")), F.count("micros"), 2).alias("avg_lead_time_seconds"),
        half_up(seconds(F.min("micros")), 2).alias("min_lead_time_seconds"),
        half_up(seconds(F.max("micros")), 2).alias("max_lead_time_seconds"),
    )


def _case_parts(df: DataFrame, *keys: str) -> DataFrame:
    steps = F.sort_array(F.collect_list(F.struct("event_timestamp", "event_id", "activity")))
    return df.groupBy(*keys).agg(
        F.min("event_timestamp").alias("process_start"),
        F.max(_last_seen()).alias("process_end"),
        F.sum("records_processed").alias("total_records_processed"),
        F.count(F.lit(1)).alias("total_stages_executed"),
        F.array_join(F.transform(steps, lambda s: s["activity"]), PATH_SEPARATOR).alias("executed_path"),
        F.bool_or(F.col("status") == "FAILED").alias("failed"),
        F.bool_or(F.col("status") == "QUARANTINED").alias("quarantined"),
    )


def _join_parts(parts: DataFrame) -> DataFrame:
    """The slices of a case put together: as many rows per case as it has slices."""
    texts = F.sort_array(F.collect_list(F.struct(SLICE, "executed_path")))
    return parts.groupBy("case_id").agg(
        F.min("process_start").alias("process_start"),
        F.max("process_end").alias("process_end"),
        F.sum("total_records_processed").alias("total_records_processed"),
        F.sum("total_stages_executed").alias("total_stages_executed"),
        F.array_join(F.transform(texts, lambda t: t["executed_path"]), PATH_SEPARATOR).alias("executed_path"),
        F.bool_or("failed").alias("failed"),
        F.bool_or("quarantined").alias("quarantined"),
    )


def case_breakdown(events: DataFrame, hot_rows: int = PATH_ROWS, slices: int | None = None) -> DataFrame:
    """Bounds, counts, overall status and executed path per case.

    The path is one text per case by definition. For a case of more than ``hot_rows`` events the
    sorting is spread over slices of the ordered events, and only their finished texts meet.
    """
    needed = events.select(
        "case_id", "event_id", "activity", "event_timestamp", "end_timestamp", "records_processed", "status"
    )
    ordinary, hot = split_hot(needed, "case_id", hot_rows)
    cases = _case_parts(ordinary, "case_id")
    if hot is not None:
        slices = slices or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        sliced = slice_rows(hot, "case_id", ["event_timestamp", "event_id"], slices)
        cases = cases.unionByName(_join_parts(_case_parts(sliced, "case_id", SLICE)))
    status = F.when(F.col("failed"), "FAILED").when(F.col("quarantined"), "QUARANTINED").otherwise("SUCCESS")
    return cases.select(
        "case_id",
        "process_start",
        "process_end",
        half_up(seconds(_micros(F.col("process_start"), F.col("process_end"))), 2).alias("lead_time_seconds"),
        "total_records_processed",
        "total_stages_executed",
        "executed_path",
        status.alias("overall_status"),
    ).orderBy(F.desc("process_start"), "case_id")


def stage_benchmark(events: DataFrame) -> DataFrame:
    """Executions and duration figures per activity, without running events."""
    measured = F.coalesce(
        exact(F.col("duration_seconds")).cast("decimal(20,6)"),
        seconds_between(F.col("event_timestamp"), F.col("end_timestamp")),
    )
    done = events.where("status <> 'RUNNING'").select("activity", "records_processed", measured.alias("seconds"))
    return done.groupBy("activity").agg(
        F.count(F.lit(1)).alias("execution_count"),
        ratio(F.sum("seconds"), F.count("seconds"), 2).alias("avg_duration_seconds"),
        half_up(F.min("seconds"), 2).alias("min_duration_seconds"),
        half_up(F.max("seconds"), 2).alias("max_duration_seconds"),
        F.sum("records_processed").alias("total_records_processed"),
    ).orderBy(F.desc("avg_duration_seconds"), "activity")


def bottleneck_rank(events: DataFrame) -> DataFrame:
    """Activities by their share of all time spent. The windows see one row per activity."""
    spent = F.coalesce(exact(F.col("duration_seconds")), F.lit(0).cast("decimal(18,3)"))
    totals = events.groupBy("activity").agg(F.sum(spent).alias("spent"), F.count(F.lit(1)).alias("total_runs"))
    everything = F.sum("spent").over(Window.partitionBy())
    return totals.select(
        F.col("activity").alias("bottleneck_stage"),
        "total_runs",
        ratio(F.col("spent"), F.col("total_runs"), 2).alias("avg_duration_seconds"),
        ratio(F.col("spent"), everything, 1, 100).alias("latency_share_percentage"),
        F.dense_rank().over(Window.orderBy(F.desc("spent"))).alias("bottleneck_rank"),
    ).orderBy("bottleneck_rank", "bottleneck_stage")


def sla_report(events: DataFrame, limits: dict[str, float] | None = None) -> DataFrame:
    """Executions over and within their limit, for the listed activities only.

    An event without a duration counts as an execution that did not keep its limit. The limits are
    configuration, so they are looked up in a map literal instead of joined.
    """
    limits = SLA_REPORT_SECONDS if limits is None else limits
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable((k.lower(), v) for k, v in limits.items())])
    limited = events.select(
        "activity", exact(F.col("duration_seconds")).alias("seconds"),
        F.element_at(lookup, F.lower("activity")).alias("sla_limit"),
    ).where(F.col("sla_limit").isNotNull())
    spent, limit, runs = F.col("seconds"), F.col("sla_limit"), F.count(F.lit(1))
    return limited.groupBy("activity", "sla_limit").agg(
        runs.alias("total_executions"),
        _count_if(spent > limit).alias("breach_count"),
        ratio(_count_if(spent <= limit), runs, 1, 100).alias("sla_compliance_pct"),
        ratio(F.sum("seconds"), F.count("seconds"), 2).alias("avg_duration_seconds"),
    ).orderBy(F.desc("breach_count"), "activity")


def failure_rate(events: DataFrame) -> DataFrame:
    runs, status = F.count(F.lit(1)), F.col("status")
    return events.groupBy("activity").agg(
        runs.alias("total_executions"),
        _count_if(status == "SUCCESS").alias("successful_executions"),
        _count_if(status == "FAILED").alias("failed_executions"),
        _count_if(status == "QUARANTINED").alias("quarantined_executions"),
        ratio(_count_if(status == "FAILED"), runs, 2, 100).alias("failure_rate_pct"),
    ).orderBy(F.desc("total_executions"), "activity")


def case_throughput(events: DataFrame) -> DataFrame:
    """Records, elapsed time and rate of every case that processed records."""
    cases = events.groupBy("case_id").agg(
        F.sum("records_processed").alias("total_records"),
        F.min("event_timestamp").alias("first"),
        F.max(_last_seen()).alias("last"),
    ).where("total_records > 0")
    took = seconds(_micros(F.col("first"), F.col("last")))
    return cases.select(
        "case_id",
        "total_records",
        half_up(took, 2).alias("total_time_seconds"),
        ratio(F.col("total_records"), took, 2).alias("throughput_records_per_sec"),
    ).orderBy(F.desc("total_time_seconds"), "case_id")


def exception_audit(events: DataFrame, n: int = AUDIT_ROWS) -> DataFrame:
    """The newest n failed, quarantined or extremely slow events."""
    status, slow = F.col("status"), F.col("duration_seconds") > EXTREME_LATENCY_SECONDS
    kind = (
        F.when(status == "FAILED", "STAGE_FAILURE")
        .when(status == "QUARANTINED", "QUALITY_QUARANTINE_EXCEPTION")
        .when(slow, "EXTREME_LATENCY_ANOMALY")
        .otherwise("NORMAL")
    )
    found = events.where(status.isin("FAILED", "QUARANTINED") | slow)
    return found.select(
        "event_id", "case_id", "activity", "status", "duration_seconds", "error_message", "event_timestamp",
        kind.alias("anomaly_classification"),
    ).orderBy(F.desc("event_timestamp"), F.desc("event_id")).limit(n)


def season_trend(events: DataFrame) -> DataFrame:
    """Cases, average duration and records per season named in the metadata."""
    tagged = events.select("*", event_season(F.col("metadata")).alias("stated"))
    spent = exact(F.col("duration_seconds"))
    return tagged.groupBy("stated").agg(
        F.count_distinct("case_id").alias("total_runs"),
        ratio(F.sum(spent), F.count(spent), 2).alias("avg_stage_duration"),
        F.sum("records_processed").alias("total_records_loaded"),
    ).select(
        F.coalesce("stated", F.lit("All")).alias("season"), "total_runs", "avg_stage_duration", "total_records_loaded"
    ).orderBy(F.desc("season"))
