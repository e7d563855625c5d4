"""Exploratory figures on raw documents, before anything is loaded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.constants import UNCREDITED_DISMISSALS
from matchlake.functions.text import canonical_name
from matchlake.operators import silver

TOP = 10
UNKNOWN_VENUE = "Unknown Venue"
BALLS = (
    "flatten(transform(coalesce(innings, array()), i -> "
    "flatten(transform(coalesce(i.overs, array()), o -> coalesce(o.deliveries, array())))))"
)


def _count(condition: str) -> str:
    return f"size(filter(balls, b -> {condition}))"


def document_totals(docs: DataFrame, *kept: str) -> DataFrame:
    """One row per document with its counts, folded inside the row, and the columns ``kept``.

    A dot ball scores nothing and carries neither a wide nor a no-ball entry.
    """
    return docs.selectExpr("match_id", *kept, f"{BALLS} AS balls").selectExpr(
        "match_id",
        *kept,
        "size(balls) AS deliveries",
        "aggregate(balls, 0L, (sum, b) -> sum + coalesce(b.runs.total, 0)) AS runs",
        "aggregate(balls, 0L, (sum, b) -> sum + coalesce(cardinality(b.wickets), 0)) AS wickets",
        f"{_count('b.runs.batter = 4')} AS fours",
        f"{_count('b.runs.batter = 6')} AS sixes",
        f"{_count('coalesce(b.runs.total, 0) = 0 AND b.extras.wides IS NULL AND b.extras.noballs IS NULL')} AS dots",
    )


def _sums(docs: DataFrame) -> DataFrame:
    names = ["deliveries", "runs", "wickets", "fours", "sixes", "dots"]
    return document_totals(docs).agg(
        F.count(F.lit(1)).alias("matches"),
        *[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in names],
    )


TOTALS = ["deliveries", "runs", "wickets", "fours", "sixes"]


def _entries(totals: Column) -> Column:
    """What a document adds to the key figures: its totals once, and each name in it once."""
    none = F.lit(None)
    entry = lambda kind, name, figures=none: F.struct(
        F.lit(kind).alias("kind"), name.cast("string").alias("name"), figures.cast(FIGURES).alias("figures")
    )
    listed = lambda names: F.coalesce(F.array_distinct(names), F.array().cast("array<string>"))
    players = listed(F.flatten(F.map_values("info.players")))
    teams = listed(F.transform("info.teams", lambda name: canonical_name(name)))
    return F.concat(
        F.array(entry("match", none, totals)),
        F.transform(players, lambda name: entry("player", name)),
        F.transform(teams, lambda name: entry("team", name)),
    )


FIGURES = f"struct<{', '.join(f'{name}:bigint' for name in TOTALS)}>"


def kpi(docs: DataFrame) -> DataFrame:
    """Eight figures in one row, from one pass over the documents.

    A document turns into its totals and its distinct names, tagged by kind. One grouping counts every
    name once and adds up the totals; its rows are combined before they are shuffled.
    """
    folded = document_totals(docs, "info").select("info", F.struct(*TOTALS).alias("totals"))
    rows = folded.select(F.inline(_entries(F.col("totals"))))
    once_each = rows.groupBy("kind", "name").agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(f"figures.{name}").alias(name) for name in TOTALS]
    )
    of = lambda kind: F.col("kind") == kind
    whole = {"matches": F.sum(F.when(of("match"), F.col("rows"))), **{name: F.sum(name) for name in TOTALS}}
    figures = {name.replace("fours", "boundaries"): total for name, total in whole.items()}
    return once_each.agg(
        *[F.coalesce(total, F.lit(0)).cast("bigint").alias(name) for name, total in figures.items()],
        F.count(F.when(of("player"), F.col("name"))).alias("players"),
        F.count(F.when(of("team"), F.col("name"))).alias("teams"),
    )


def _top(df: DataFrame, label: str, measure: str, n: int | None) -> DataFrame:
    ranked = df.orderBy(F.desc(measure), F.asc(label))
    return ranked.limit(n) if n else ranked


def _ball_runs(docs: DataFrame, who: Column, label: str, runs: str) -> DataFrame:
    value = F.coalesce(F.col(runs), F.lit(0))
    return silver.balls(docs).groupBy(who.alias(label)).agg(F.sum(value).alias("runs"))


def runs_by_team(docs: DataFrame) -> DataFrame:
    return _top(_ball_runs(docs, F.col("batting_team"), "team", "b.runs.total"), "team", "runs", None)


def top_batters(docs: DataFrame, n: int = TOP) -> DataFrame:
    return _top(_ball_runs(docs, F.col("b.batter"), "player", "b.runs.batter"), "player", "runs", n)


def top_bowlers(docs: DataFrame, n: int = TOP) -> DataFrame:
    """Wickets credited to the bowler; a dismissal of unstated kind counts."""
    fallen = silver.balls(docs).select(F.col("b.bowler").alias("player"), F.explode("b.wickets.kind").alias("kind"))
    credited = fallen.where(~F.coalesce(F.col("kind").isin(UNCREDITED_DISMISSALS), F.lit(False)))
    return _top(credited.groupBy("player").agg(F.count(F.lit(1)).alias("wickets")), "player", "wickets", n)


def venues(docs: DataFrame, n: int = TOP) -> DataFrame:
    named = docs.select(F.coalesce("info.venue", F.lit(UNKNOWN_VENUE)).alias("venue"))
    return _top(named.groupBy("venue").agg(F.count(F.lit(1)).alias("matches")), "venue", "matches", n)


def run_distribution(docs: DataFrame) -> DataFrame:
    """(chart, label, value) of the boundary, six and dot-ball splits."""
    return _sums(docs).selectExpr(
        """stack(7,
            'boundary_dist', 'Fours', fours * 4,
            'boundary_dist', 'Sixes', sixes * 6,
            'boundary_dist', 'Other Runs', greatest(0L, runs - fours * 4 - sixes * 6),
            'six_dist', 'Sixes', sixes * 6,
            'six_dist', 'Other runs', greatest(0L, runs - sixes * 6),
            'dot_ball_pct', 'Dot Balls', dots,
            'dot_ball_pct', 'Scoring Balls', greatest(0L, deliveries - dots)) AS (chart, label, value)"""
    )


def team_performance(docs: DataFrame) -> DataFrame:
    """Matches and wins of every team that played, from one pass over the documents."""
    entry = lambda name, matches, wins: F.struct(
        canonical_name(name).alias("team"), F.lit(matches).alias("matches"), F.lit(wins).alias("wins")
    )
    winner, nobody = F.col("info.outcome.winner"), F.array().cast("array<struct<team:string,matches:int,wins:int>>")
    played = F.coalesce(F.transform("info.teams", lambda name: entry(name, 1, 0)), nobody)
    won = F.when(winner != "", F.array(entry(winner, 0, 1))).otherwise(nobody)
    totals = docs.select(F.inline(F.concat(played, won))).groupBy("team").agg(
        F.sum("matches").alias("matches"), F.sum("wins").alias("wins")
    )
    return totals.where("matches > 0")
