"""Ordered data-quality rules on parsed documents. The first rule that fails names the error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.constants import (
    DEFAULT_OVERS,
    MAX_MATCH_RUNS,
    MAX_RUNS_PER_BALL,
    MIN_COMPLETED_RUNS,
    OVERS_RANGE,
    SQUAD_SIZE,
)
from matchlake.functions.once import once

NUMBER_TYPES = "^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL.*|DOUBLE|FLOAT)$"

OVERS = "flatten(transform(coalesce(innings, array()), i -> coalesce(i.overs, array())))"
BALLS = "flatten(transform(over_list, o -> coalesce(o.deliveries, array())))"

# NULL where the over and its balls are in range, else what is wrong with the first of them.
RANGE_FAULT = f"""get(filter(transform(over_list, o -> CASE
    WHEN o.over IS NULL OR o.over < 0 OR o.over >= over_limit
      THEN concat('over ', coalesce(CAST(o.over AS STRING), 'without a number'), ' is outside 0 to ', CAST(over_limit AS STRING))
    ELSE get(filter(transform(coalesce(o.deliveries, array()), d -> CASE
      WHEN coalesce(d.runs.batter, 0) NOT BETWEEN 0 AND {MAX_RUNS_PER_BALL}
        THEN concat('batter runs ', d.runs.batter, ' are outside 0 to {MAX_RUNS_PER_BALL}')
      WHEN coalesce(d.runs.extras, 0) NOT BETWEEN 0 AND {MAX_RUNS_PER_BALL}
        THEN concat('extras ', d.runs.extras, ' are outside 0 to {MAX_RUNS_PER_BALL}')
      END), m -> m IS NOT NULL), 0)
    END), m -> m IS NOT NULL), 0)"""

# NULL where every ball adds up, else the first that does not.
SUM_FAULT = """get(filter(transform(balls, d -> CASE
    WHEN coalesce(d.runs.total, 0) <> coalesce(d.runs.batter, 0) + coalesce(d.runs.extras, 0)
      THEN concat('total ', coalesce(d.runs.total, 0), ' is not ', coalesce(d.runs.batter, 0), ' + ', coalesce(d.runs.extras, 0))
    END), m -> m IS NOT NULL), 0)"""

MATCH_RUNS = "aggregate(balls, CAST(0 AS BIGINT), (sum, d) -> sum + coalesce(d.runs.total, 0))"


def _rules() -> list[tuple[str, str, str]]:
    """(error type, SQL condition of a failure, SQL message), in order of precedence."""
    blank = "coalesce({}, '') = ''"
    low, high = SQUAD_SIZE
    fewest, most = OVERS_RANGE
    return [
        ("SCHEMA_VALIDATION", "info IS NULL OR innings IS NULL", "'not a document with info and innings'"),
        *[
            ("REQUIRED_FIELDS", f"NOT shape.has_{key}", f"'info.{key} is missing'")
            for key in ("teams", "dates", "match_type", "venue")
        ],
        (
            "NULL_CHECK",
            "coalesce(size(info.teams), 0) < 2 OR " + blank.format("get(info.teams, 0)") + " OR " + blank.format("get(info.teams, 1)"),
            "'fewer than two named teams'",
        ),
        ("NULL_CHECK", blank.format("get(info.dates, 0)"), "'no first date'"),
        (
            "DATATYPE_CHECK",
            f"shape.overs_type IS NOT NULL AND NOT shape.overs_type RLIKE '{NUMBER_TYPES}'",
            "'overs is not a number'",
        ),
        ("RANGE_CHECK", "range_fault IS NOT NULL", "range_fault"),
        ("INVALID_RUNS", "sum_fault IS NOT NULL", "sum_fault"),
        ("TEAM_VALIDATION", "size(info.teams) <> 2", "concat(size(info.teams), ' teams instead of 2')"),
        (
            "PLAYER_VALIDATION",
            "coalesce(cardinality(info.players), 0) < 1 OR "
            "exists(map_values(info.players), s -> coalesce(cardinality(s), 0) < 1)",
            "'a squad is missing or empty'",
        ),
        (
            "REFERENTIAL_INTEGRITY",
            "exists(innings, i -> NOT coalesce(array_contains(info.teams, i.team), false))",
            "'a batting team is not one of the two teams'",
        ),
        ("OUTLIER_DETECTION", f"match_runs > {MAX_MATCH_RUNS}", f"concat(match_runs, ' runs exceed {MAX_MATCH_RUNS}')"),
        (
            "OUTLIER_DETECTION",
            f"match_runs < {MIN_COMPLETED_RUNS} AND NOT (info.outcome.result <=> 'no result') "
            "AND info.outcome.winner IS NOT NULL",
            "concat('only ', match_runs, ' runs in a completed match')",
        ),
        (
            "OUTLIER_DETECTION",
            f"exists(map_values(info.players), s -> cardinality(s) < {low} OR cardinality(s) > {high})",
            f"'a squad is not of {low} to {high} players'",
        ),
        (
            "OUTLIER_DETECTION",
            f"over_limit > {most} OR over_limit < {fewest}",
            f"concat(CAST(over_limit AS STRING), ' overs are outside {fewest} to {most}')",
        ),
    ]


def first_failure() -> Column:
    """struct(error_type, error_message) of the first failing rule, NULL for a valid document."""
    cases = " ".join(
        f"WHEN {condition} THEN named_struct('error_type', '{kind}', 'error_message', {message})"
        for kind, condition, message in _rules()
    )
    return F.expr(f"CASE {cases} END")


def classify(parsed: DataFrame) -> DataFrame:
    """Add ``error_type`` and ``error_message``, both NULL for a valid document.

    Everything is computed inside the row: no shuffle.
    """
    stages = [
        (f"{OVERS} AS over_list", f"coalesce(info.overs, {DEFAULT_OVERS}D) AS over_limit"),
        (f"{BALLS} AS balls",),
        (f"{RANGE_FAULT} AS range_fault", f"{SUM_FAULT} AS sum_fault", f"{MATCH_RUNS} AS match_runs"),
    ]
    work = parsed
    for columns in stages:
        work = work.selectExpr("*", *columns)
    work = work.select("*", first_failure().alias("failure"))
    error = {name: F.col(f"failure.{name}") for name in ("error_type", "error_message")}
    return once(work, **error).select(*parsed.columns, *error)


def valid(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("error_type").isNull()).drop("error_type", "error_message")


def quarantine(checked: DataFrame) -> DataFrame:
    """The failing documents with their reason and full text."""
    return checked.where(F.col("error_type").isNotNull()).select(
        "season",
        F.concat("match_id", F.lit(".json")).alias("source"),
        F.lit("STAGING").alias("stage"),
        "error_type",
        "error_message",
        F.col("raw_data").alias("raw_record"),
        F.lit("QUARANTINED").alias("status"),
    )


def summary(checked: DataFrame) -> DataFrame:
    """Processed, valid and quarantined documents per season."""
    return checked.groupBy("season").agg(
        F.count(F.lit(1)).alias("processed"),
        F.count(F.when(F.col("error_type").isNull(), 1)).alias("valid"),
        F.count("error_type").alias("quarantined"),
    )
