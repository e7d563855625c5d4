"""Serving queries on the season-partitioned lakehouse table."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.functions.text import filled

TOP = 10
READ_ONLY = ("SELECT", "SHOW", "DESCRIBE", "EXPLAIN")


def in_season(df: DataFrame, season: str | None) -> DataFrame:
    """One season, or everything for None and "all"."""
    if season is None or str(season) == "" or str(season).lower() == "all":
        return df
    return df.where(F.col("season") == str(season))


def _total(name: str):
    return F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name)


def overview(lake: DataFrame, season: str | None = None) -> DataFrame:
    return in_season(lake, season).agg(
        F.count(F.lit(1)).alias("total_matches"),
        _total("total_runs"),
        _total("total_wickets"),
        _total("total_overs"),
        F.count_distinct("season").alias("season_count"),
    )


def available_seasons(lake: DataFrame) -> DataFrame:
    return lake.select("season").distinct().orderBy(F.desc("season"))


def season_trends(lake: DataFrame) -> DataFrame:
    return (
        lake.groupBy("season")
        .agg(F.count(F.lit(1)).alias("match_count"), _total("total_runs"), _total("total_wickets"))
        .orderBy("season")
    )


def wins_by_team(lake: DataFrame, season: str | None = None, n: int | None = TOP) -> DataFrame:
    won = in_season(lake, season).where(filled(F.col("winner")))
    ranked = won.groupBy(F.col("winner").alias("team")).agg(F.count(F.lit(1)).alias("wins"))
    ranked = ranked.orderBy(F.desc("wins"), "team")
    return ranked.limit(n) if n else ranked


def venue_stats(lake: DataFrame, season: str | None = None, n: int = TOP) -> DataFrame:
    """Matches hosted and average match runs to one decimal."""
    hosted = in_season(lake, season).where(filled(F.col("venue")))
    average = F.sum("total_runs").cast("decimal(24,6)") / F.count("total_runs").cast("decimal(13,0)")
    return (
        hosted.groupBy("venue")
        .agg(
            F.count(F.lit(1)).alias("matches_hosted"),
            F.coalesce(F.round(average, 1).cast("double"), F.lit(0.0)).alias("avg_match_runs"),
        )
        .orderBy(F.desc("matches_hosted"), "venue")
        .limit(n)
    )


def row_count(lake: DataFrame) -> DataFrame:
    return lake.agg(F.count(F.lit(1)).alias("total_records"))


def season_matches(lake: DataFrame, season: str) -> DataFrame:
    """The partition-pruned listing of one season."""
    return lake.where(F.col("season") == str(season)).select("match_id", "match_date", "team1", "team2", "total_runs")


def partitions(lake: DataFrame) -> DataFrame:
    """Records and files per season, from the files Spark would read."""
    return lake.groupBy("season").agg(
        F.count(F.lit(1)).alias("record_count"), F.count_distinct("_metadata.file_path").alias("file_count")
    )


def run_readonly(spark: SparkSession, statement: str, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run one SELECT, SHOW, DESCRIBE or EXPLAIN statement over named DataFrames."""
    words = re.match(r"\s*([A-Za-z]+)", statement or "")
    if not words:
        raise ValueError("the statement is empty")
    if words.group(1).upper() not in READ_ONLY:
        raise PermissionError("only SELECT, SHOW, DESCRIBE and EXPLAIN statements are permitted")
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(statement)
