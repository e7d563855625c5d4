"""Durations, cycle time, throughput, bottlenecks and SLA compliance of process events."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.constants import SLA_DEFAULT_SECONDS, SLA_FALLBACK_ACTIVITY, SLA_SECONDS
from matchlake.functions.numbers import exact, half_up, ratio, seconds_between

DEFAULT_CASE = "default"


def case_key() -> Column:
    """Events without a case belong to one default case."""
    return F.coalesce(F.nullif(F.col("case_id"), F.lit("")), F.lit(DEFAULT_CASE))


def elapsed(clamp: bool) -> Column:
    """The stated duration, else end minus start to the millisecond, as a decimal."""
    measured = F.round(seconds_between(F.col("event_timestamp"), F.col("end_timestamp")), 3).cast("decimal(18,3)")
    if clamp:
        measured = F.greatest(measured, F.lit(0).cast("decimal(18,3)"))
    return F.coalesce(exact(F.col("duration_seconds")), measured)


def sla_limit(activity: Column, limits: dict[str, float] | None = None) -> Column:
    """The limit of an activity; unknown ones get the fallback activity's limit. A map literal: the
    table is a handful of configured entries, so no join is needed."""
    limits = SLA_SECONDS if limits is None else limits
    fallback = limits.get(SLA_FALLBACK_ACTIVITY, SLA_DEFAULT_SECONDS)
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(limits.items())])
    return F.coalesce(F.element_at(lookup, activity), F.lit(fallback))


def stage_durations(events: DataFrame) -> DataFrame:
    """Average seconds per activity; negative durations are left out."""
    timed = events.select("activity", elapsed(clamp=True).alias("seconds")).where("seconds >= 0")
    return timed.groupBy("activity").agg(
        ratio(F.sum("seconds"), F.count("seconds"), 3).alias("duration_seconds")
    )


def case_cycle_times(events: DataFrame) -> DataFrame:
    """Seconds from first start to last end per case.

    An event without an end but with a non-zero duration counts with its start; a case without any
    end uses its last start.
    """
    start, end = F.col("event_timestamp"), F.col("end_timestamp")
    known_end = F.coalesce(end, F.when(F.col("duration_seconds") != 0, start))
    bounds = events.groupBy(case_key().alias("case_id")).agg(
        F.min(start).alias("first"), F.max(start).alias("last"), F.max(known_end).alias("done")
    )
    span = F.round(seconds_between(F.col("first"), F.coalesce("done", "last")), 3).cast("decimal(18,3)")
    zero = F.lit(0).cast("decimal(18,3)")
    return bounds.select("case_id", F.coalesce(F.greatest(span, zero), zero).alias("cycle_seconds"))


def cycle_time(events: DataFrame) -> DataFrame:
    """The average over cases with a positive cycle time; lead time is the same figure."""
    positive = case_cycle_times(events).where("cycle_seconds > 0")
    average = F.coalesce(ratio(F.sum("cycle_seconds"), F.count("cycle_seconds"), 3), F.lit(0.0))
    return positive.agg(average.alias("cycle_time_seconds")).withColumn("lead_time_seconds", F.col("cycle_time_seconds"))


def throughput(records: Column, seconds: Column) -> Column:
    """Records per second to two decimals, 0 where no time passed. ``seconds`` to the millisecond."""
    rate = ratio(records, exact(seconds), 2)
    return F.when(seconds > 0, F.coalesce(rate, F.lit(0.0))).otherwise(0.0)


def event_throughput(events: DataFrame) -> DataFrame:
    rate = throughput(F.col("records_processed"), F.col("duration_seconds"))
    return events.select("event_id", "activity", rate.alias("throughput_rps"))


def bottlenecks(events: DataFrame) -> DataFrame:
    """Activities by average duration, with the share of the sum of averages.

    The window sees one row per activity.
    """
    seconds = exact(F.col("duration_seconds"))
    total = F.sum(seconds).over(Window.partitionBy())
    share = F.when(total > 0, ratio(seconds, total, 1, 100)).otherwise(0.0)
    ranked = stage_durations(events).select("activity", "duration_seconds", share.alias("pct_of_total"))
    return ranked.orderBy(F.desc("duration_seconds"), "activity")


def stage_compliance(events: DataFrame, limits: dict[str, float] | None = None) -> DataFrame:
    """Average duration against limit per activity."""
    actual, limit = F.col("actual_seconds"), F.col("sla_limit")
    measured = stage_durations(events).select(
        "activity",
        F.col("duration_seconds").alias("actual_seconds"),
        sla_limit(F.col("activity"), limits).alias("sla_limit"),
    )
    over = half_up(exact(actual) - exact(limit), 3)
    return measured.select("*", (actual > limit).alias("breached"), over.alias("breach_seconds"))


def sla_compliance(events: DataFrame, limits: dict[str, float] | None = None) -> DataFrame:
    """Share of activities whose average keeps its limit: one row."""
    kept = F.count(F.when(~F.col("breached"), 1))
    total = F.count(F.lit(1))
    return stage_compliance(events, limits).agg(
        F.coalesce(ratio(kept, total, 1, 100), F.lit(100.0)).alias("compliance_pct"), total.alias("total_stages")
    )


def breached_stages(events: DataFrame, limits: dict[str, float] | None = None) -> DataFrame:
    return stage_compliance(events, limits).where("breached").drop("breached")


def process_summary(events: DataFrame, case_id: str | None = None, limits: dict[str, float] | None = None) -> DataFrame:
    """All headline figures in one row, over one case or over everything.

    Events are reduced to one row per (case, activity) once; the case figures and the activity
    figures both start from that, and meet as tagged rows of one small aggregation.
    """
    if case_id is not None:
        events = events.where(F.col("case_id") == str(case_id))
    start, end = F.col("event_timestamp"), F.col("end_timestamp")
    seconds = elapsed(clamp=True)
    reduced = events.groupBy(case_key().alias("case_id"), "activity").agg(
        F.min(start).alias("first"),
        F.max(start).alias("last"),
        F.max(F.coalesce(end, F.when(F.col("duration_seconds") != 0, start))).alias("done"),
        F.sum(F.when(seconds >= 0, seconds)).alias("seconds"),
        F.count(F.when(seconds >= 0, 1)).alias("timed"),
        F.sum(F.when(F.col("status") == "SUCCESS", F.coalesce("records_processed", F.lit(0)))).alias("records"),
        F.count(F.lit(1)).alias("events"),
    )
    bounds = reduced.groupBy("case_id").agg(
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.max("done").alias("done"),
        F.sum("records").alias("records"),
        F.sum("events").alias("events"),
    )
    span = F.round(seconds_between(F.col("first"), F.coalesce("done", "last")), 3).cast("decimal(18,3)")
    cases = bounds.select("records", "events", F.when(span > 0, span).alias("cycle"))
    stages = reduced.groupBy("activity").agg(F.sum("seconds").alias("seconds"), F.sum("timed").alias("timed"))
    stages = stages.where("timed > 0").select(
        "activity",
        ratio(F.col("seconds"), F.col("timed"), 3).alias("average"),
    ).withColumn("kept", (F.col("average") <= sla_limit(F.col("activity"), limits)).cast("int"))
    rows = cases.unionByName(stages, allowMissingColumns=True)
    totals = rows.agg(
        F.coalesce(ratio(F.sum("cycle"), F.count("cycle"), 3), F.lit(0.0)).alias("cycle_time_seconds"),
        F.coalesce(
            F.min_by("activity", F.when(F.col("activity").isNotNull(), F.struct(-F.col("average"), "activity"))),
            F.lit("none"),
        ).alias("primary_bottleneck"),
        F.coalesce(ratio(F.sum("kept"), F.count("kept"), 1, 100), F.lit(100.0)).alias("compliance_pct"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("events"), F.lit(0)).alias("event_count"),
    )
    return totals.select(
        F.lit(case_id or "all").alias("case_id"),
        "cycle_time_seconds",
        F.col("cycle_time_seconds").alias("lead_time_seconds"),
        "primary_bottleneck",
        "compliance_pct",
        throughput(F.col("total_records"), F.col("cycle_time_seconds")).alias("throughput_rps"),
        "total_records",
        "event_count",
    )
