"""Anomalies in process events: slow, out of sequence, repeated, and illegal transitions.

The two order-dependent detectors run on windows per case. Cases too large for one task are cut
into slices, see ``matchlake.functions.scans``.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.constants import (
    ALLOWED_TRANSITIONS,
    ALWAYS_LEGAL_TRANSITIONS,
    RETRY_ACTIVITIES,
    STAGE_SEQUENCE,
    TERMINAL_STATUSES,
)
from matchlake.functions.numbers import ratio
from matchlake.functions.scans import HOT_KEY_ROWS, Running, next_in_key, running_before, slice_rows, split_hot
from matchlake.functions.text import event_season
from matchlake.operators.process_metrics import case_key, elapsed, sla_limit

UNKNOWN_STAGE = 999
ORDER = ["event_timestamp", "stage_index", "event_id"]
RESTARTING = ["bronze", "staging"]


def _stage_index(activity: Column, sequence: list[str]) -> Column:
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable((s, i) for i, s in enumerate(sequence))])
    return F.element_at(lookup, activity)


def _ordered(events: DataFrame, sequence: list[str]) -> DataFrame:
    """The columns that order the events of a case; nothing else takes part in the scans."""
    return events.select(
        case_key().alias("case_id"),
        "activity",
        "event_timestamp",
        F.coalesce(_stage_index(F.col("activity"), sequence), F.lit(UNKNOWN_STAGE)).alias("stage_index"),
        F.coalesce("event_id", F.lit(0)).alias("event_id"),
        event_season(F.col("metadata")).alias("season"),
    )


def _scan_cases(
    events: DataFrame, scan: Callable[[DataFrame], DataFrame], hot_rows: int, slices: int | None
) -> DataFrame:
    """Run a per-case scan: ordinary cases by window, cases above ``hot_rows`` in slices."""
    ordinary, hot = split_hot(events, "case_id", hot_rows)
    result = scan(ordinary)
    if hot is None:
        return result
    slices = slices or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return result.unionByName(scan(slice_rows(hot, "case_id", ORDER, slices)))


def sla_breaches(events: DataFrame, limits: dict[str, float] | None = None) -> DataFrame:
    """Every event above the limit of its activity."""
    timed = events.select(
        "event_id", "case_id", "activity", elapsed(clamp=False).cast("double").alias("actual_seconds"),
        sla_limit(F.col("activity"), limits).alias("sla_limit"),
    )
    return timed.where("actual_seconds > sla_limit").select(
        F.lit("SLA_BREACH").alias("type"),
        F.lit("HIGH").alias("severity"),
        "event_id",
        "case_id",
        "activity",
        "actual_seconds",
        "sla_limit",
        F.format_string("%s took %s s, its limit is %s s", "activity", "actual_seconds", "sla_limit").alias("message"),
    )


def _sequence_scan(sequence: list[str]) -> Callable[[DataFrame], DataFrame]:
    """The scan that finds steps back in the sequence.

    A cycle of a case starts anew when the season changes, or at a restarting activity once one of
    the last two stages has been reached. The latter holds exactly if, among the restarting and
    late events since the last season change, the previous one was late. Within a cycle an event is
    out of sequence when a later stage was seen before it.
    """
    last_two = len(sequence) - 2
    early = F.col("activity").isin(RESTARTING)
    late = F.col("stage_index") >= last_two

    def scan(df: DataFrame) -> DataFrame:
        df = running_before(df, ["case_id"], ORDER, [Running("season_before", "last", F.col("season"))])
        changed = F.coalesce(F.col("season") != F.col("season_before"), F.lit(False))
        df = df.select("*", changed.alias("season_changed")).drop("season_before")
        mark = F.when(late, True).when(early | F.col("season_changed"), False)
        df = running_before(df, ["case_id"], ORDER, [Running("late_before", "last", mark)])
        restart = F.col("season_changed") | (early & F.coalesce("late_before", F.lit(False)))
        df = df.select("*", restart.cast("bigint").alias("restart")).drop("season_changed", "late_before")
        df = running_before(df, ["case_id"], ORDER, [Running("restarts", "sum", F.col("restart"))])
        df = df.select("*", (F.col("restarts") + F.col("restart")).alias("cycle")).drop("restarts", "restart")
        keys = ["case_id", "cycle"]
        df = running_before(df, keys, ORDER, [Running("furthest", "max", F.col("stage_index"))])
        step_back = F.coalesce(F.col("stage_index") < F.col("furthest"), F.lit(False))
        df = df.select("*", step_back.alias("step_back"))
        # events in sequence never step back, so how often each stage occurred describes their order in full
        seen = [
            Running(f"seen_{i}", "sum", (~F.col("step_back") & (F.col("stage_index") == i)).cast("bigint"))
            for i in range(len(sequence))
        ]
        df = running_before(df, keys, ORDER, seen).where("step_back")
        return df.select(
            "case_id", "event_id", "activity", "furthest", *[s.name for s in seen]
        )

    return scan


def out_of_sequence(
    events: DataFrame,
    sequence: list[str] | None = None,
    hot_rows: int = HOT_KEY_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Events whose stage comes before one already reached in the same cycle of their case.

    ``observed_runs`` holds what came before in order, as (activity, times) pairs: a list with one
    entry per earlier event would grow with the square of a cycle. ``expand_order`` spells it out.
    """
    sequence = STAGE_SEQUENCE if sequence is None else sequence
    known = _ordered(events, sequence).where(F.col("stage_index") < UNKNOWN_STAGE)
    found = _scan_cases(known, _sequence_scan(sequence), hot_rows, slices)
    runs = F.filter(
        F.array(
            *[
                F.struct(F.lit(stage).alias("activity"), F.col(f"seen_{i}").alias("times"))
                for i, stage in enumerate(sequence)
            ]
        ),
        lambda r: r["times"] > 0,
    )
    own = F.array(F.struct(F.col("activity").alias("activity"), F.lit(1).cast("bigint").alias("times")))
    after = F.element_at(F.array(*[F.lit(s) for s in sequence]), F.col("furthest") + 1)
    return found.select(
        F.lit("OUT_OF_SEQUENCE").alias("type"),
        F.lit("CRITICAL").alias("severity"),
        "event_id",
        "case_id",
        "activity",
        F.concat(runs, own).alias("observed_runs"),
        F.format_string("%s ran after %s", F.col("activity"), after).alias("message"),
    )


def expand_order(anomalies: DataFrame) -> DataFrame:
    """Replace the (activity, times) pairs by the full list of activities."""
    spelled = "flatten(transform(observed_runs, r -> array_repeat(r.activity, CAST(r.times AS INT))))"
    return anomalies.withColumn("observed_order", F.expr(spelled)).drop("observed_runs")


def duplicates(events: DataFrame, allow_retries: bool = True, retry_activities: list[str] | None = None) -> DataFrame:
    """Activities executed more than once in the same case and season.

    A RUNNING event is left out if its case has other events, among them a finished one of the same
    activity in whatever season. Events are counted per (case, season, activity) first, so what is
    regrouped afterwards is small even for a case that owns most of the events.
    """
    status = F.upper(F.coalesce("status", F.lit("")))
    retries = RETRY_ACTIVITIES if retry_activities is None else retry_activities
    counted = events.groupBy(
        case_key().alias("case_id"), "activity", F.coalesce(F.nullif(event_season(F.col("metadata")), F.lit("")), F.lit("global")).alias("season")
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(status == "RUNNING", 1)).alias("running"),
        F.count(F.when(status.isin(TERMINAL_STATUSES), 1)).alias("finished"),
    )
    # a finished event of the activity is itself another event of the case
    done = counted.groupBy("case_id", "activity").agg(F.sum("finished").alias("any_finished"))
    joined = counted.join(
        done.select(F.col("case_id").alias("c"), F.col("activity").alias("a"), "any_finished"),
        F.col("case_id").eqNullSafe(F.col("c")) & F.col("activity").eqNullSafe(F.col("a")),
    )
    executions = F.when(F.col("any_finished") > 0, F.col("n") - F.col("running")).otherwise(F.col("n"))
    repeated = joined.select("case_id", "activity", "season", executions.alias("execution_count")).where(
        "execution_count > 1"
    )
    if allow_retries:
        repeated = repeated.where(~F.coalesce(F.col("activity").isin(retries), F.lit(False)))
    return repeated.select(
        F.lit("DUPLICATE_ACTIVITY").alias("type"),
        F.lit("MEDIUM").alias("severity"),
        "case_id",
        "activity",
        "season",
        "execution_count",
        F.format_string("%s ran %d times in one cycle (%s)", "activity", "execution_count", "season").alias("message"),
    )


def _is_legal(transitions: dict[str, list[str]]) -> Column:
    """NULL where nothing is known about the source."""
    allowed = F.create_map(
        *chain.from_iterable(
            (F.lit(k), F.array(*[F.lit(t) for t in sorted({*v, *ALWAYS_LEGAL_TRANSITIONS.get(k, [])})]))
            for k, v in transitions.items()
        )
    )
    return F.array_contains(F.element_at(allowed, F.col("from_activity")), F.col("to_activity"))


def transitions(events: DataFrame, hot_rows: int = HOT_KEY_ROWS, slices: int | None = None) -> DataFrame:
    """Every pair of consecutive events of a case."""

    def scan(df: DataFrame) -> DataFrame:
        pairs = next_in_key(df, "case_id", ORDER, {"to_activity": "activity", "to_event_id": "event_id"})
        return pairs.where(F.col("to_event_id").isNotNull()).select(
            "case_id", "event_id", F.col("activity").alias("from_activity"), "to_activity"
        )

    return _scan_cases(_ordered(events, STAGE_SEQUENCE), scan, hot_rows, slices)


def deviations(
    events: DataFrame,
    valid: dict[str, list[str]] | None = None,
    hot_rows: int = HOT_KEY_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Consecutive events of a case whose transition is not allowed.

    Repeating an activity is fine, and so is whatever follows an activity without listed targets.
    """
    legal = _is_legal(ALLOWED_TRANSITIONS if valid is None else valid)
    pairs = transitions(events, hot_rows, slices)
    illegal = pairs.where("from_activity <> to_activity").where(legal == F.lit(False))
    return illegal.select(
        F.lit("PROCESS_DEVIATION").alias("type"),
        F.lit("HIGH").alias("severity"),
        "event_id",
        "case_id",
        "from_activity",
        "to_activity",
        F.format_string("%s may not be followed by %s", "from_activity", "to_activity").alias("message"),
    )


def directly_follows(events: DataFrame) -> DataFrame:
    """How often each activity was directly followed by which."""
    return transitions(events).groupBy("from_activity", "to_activity").agg(F.count(F.lit(1)).alias("times"))


def transition_fitness(events: DataFrame, valid: dict[str, list[str]] | None = None) -> DataFrame:
    """Share of transitions that are allowed, in percent: one row."""
    legal = _is_legal(ALLOWED_TRANSITIONS if valid is None else valid)
    fine = F.coalesce((F.col("from_activity") == F.col("to_activity")) | legal, F.lit(True))
    counted = directly_follows(events)
    total = F.sum("times")
    valid_times = F.coalesce(F.sum(F.when(fine, F.col("times"))), F.lit(0))
    share = ratio(valid_times, total, 2, 100)
    return counted.agg(total.alias("transitions"), valid_times.alias("valid_transitions"), share.alias("fitness_pct"))


def all_anomalies(
    events: DataFrame,
    limits: dict[str, float] | None = None,
    hot_rows: int = HOT_KEY_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """The four kinds in one table; columns a kind does not have are NULL."""
    parts = [
        sla_breaches(events, limits),
        out_of_sequence(events, hot_rows=hot_rows, slices=slices),
        duplicates(events),
        deviations(events, hot_rows=hot_rows, slices=slices),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result
