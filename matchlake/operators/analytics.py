"""Filtered KPIs, charts and season reports on the star schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOP = 10
SAMPLE_ROWS = 10

# Tables that may be inspected, and how a season filter applies to them.
SEASON_TABLES = ["match", "fact_match_summary"]
MATCH_CHILD_TABLES = [
    "innings", "delivery", "wicket", "team_squad", "powerplay", "toss", "player_of_match", "match_official",
]
INSPECTABLE_TABLES = [
    "match", "team", "player", "official", "innings", "delivery", "wicket", "team_squad", "powerplay", "toss",
    "player_of_match", "match_official", "fact_match_summary", "dim_team", "dim_player", "source_registry",
    "pipeline_control", "quarantine_records", "cdc_states", "cdc_log", "pipeline_runs",
]


@dataclass(frozen=True)
class Filters:
    """Optional conditions, all of which must hold. Seasons compare as text.

    ``batting_team`` and ``bowling_team`` narrow deliveries, not matches.
    """

    season: str | None = None
    from_season: str | None = None
    to_season: str | None = None
    team: str | None = None
    venue: str | None = None
    batting_team: str | None = None
    bowling_team: str | None = None

    def on_matches(self) -> list[Column]:
        found = []
        if self.season:
            found.append(F.col("season") == str(self.season))
        elif self.from_season and self.to_season:
            found.append(F.col("season").between(str(self.from_season), str(self.to_season)))
        if self.team:
            found.append((F.col("team1") == self.team) | (F.col("team2") == self.team))
        if self.venue:
            found.append(F.col("venue") == self.venue)
        return found

    def on_deliveries(self) -> list[Column]:
        found = []
        if self.batting_team:
            found.append(F.col("batting_team") == self.batting_team)
        if self.bowling_team:
            found.append(F.col("bowling_team") == self.bowling_team)
        return found


def select_matches(df: DataFrame, filters: Filters) -> DataFrame:
    for condition in filters.on_matches():
        df = df.where(condition)
    return df


def select_deliveries(df: DataFrame, filters: Filters) -> DataFrame:
    for condition in filters.on_deliveries():
        df = df.where(condition)
    return df


def _total(name: str, alias: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(alias)


def kpi(fact: DataFrame, filters: Filters) -> DataFrame:
    """Matches, runs, wickets, fours and sixes of the chosen matches: one row."""
    return select_matches(fact, filters).agg(
        F.count("match_id").alias("matches"),
        _total("total_runs", "runs"),
        _total("total_wickets", "wickets"),
        _total("total_boundaries", "boundaries"),
        _total("total_sixes", "sixes"),
    )


def active_players(fact: DataFrame, squads: DataFrame, players: DataFrame, filters: Filters) -> DataFrame:
    """How many players were in a squad of the chosen matches; without a filter, all known players."""
    if not filters.on_matches():
        return players.agg(F.count(F.lit(1)).alias("players"))
    chosen = select_matches(fact, filters).select("match_id")
    return squads.join(chosen, "match_id", "left_semi").agg(F.count_distinct("player_name").alias("players"))


def player_kpi(dim_player: DataFrame, player: str) -> DataFrame:
    """The KPI row of one player; matches batted, or else matches bowled."""
    matches = F.coalesce(F.nullif("batting_matches", F.lit(0)), F.nullif("bowling_matches", F.lit(0)), F.lit(0))
    return dim_player.where(F.col("player_name") == player).select(
        matches.alias("matches"),
        F.coalesce("total_runs", F.lit(0)).alias("runs"),
        F.coalesce("wickets_taken", F.lit(0)).alias("wickets"),
        F.coalesce("total_fours", F.lit(0)).alias("boundaries"),
        F.coalesce("total_sixes", F.lit(0)).alias("sixes"),
        F.lit(1).alias("players"),
    )


def runs_by_season(fact: DataFrame, filters: Filters = Filters()) -> DataFrame:
    chosen = select_matches(fact, filters)
    return chosen.groupBy("season").agg(_total("total_runs", "runs")).orderBy("season")


def _top(df: DataFrame, label: str, measure: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(measure), F.asc(label)).limit(n)


def top_players(
    dim_player: DataFrame, measure: str, squads: DataFrame | None = None, team: str | None = None, n: int = TOP
) -> DataFrame:
    """The n players with the highest positive measure, on request only those ever in a team's squad."""
    ranked = dim_player.where(F.col(measure) > 0).select("player_name", measure)
    if team:
        members = squads.where(F.col("team_name") == team).select("player_name")
        ranked = ranked.join(members, "player_name", "left_semi")
    return _top(ranked, "player_name", measure, n)


def venue_matches(fact: DataFrame, filters: Filters = Filters(), n: int = TOP) -> DataFrame:
    counted = select_matches(fact, filters).groupBy("venue").agg(F.count("match_id").alias("matches"))
    return _top(counted, "venue", "matches", n)


def _strike_rate(runs: str, balls: str) -> Column:
    top = (F.col(runs) * 100).cast("decimal(24,6)")
    bottom = F.nullif(F.col(balls).cast("decimal(13,0)"), F.lit(0).cast("decimal(13,0)"))
    return F.coalesce(F.round(top / bottom, 1), F.lit(0)).cast("double")


def player_season_report(deliveries: DataFrame, wickets: DataFrame, player: str, filters: Filters = Filters()) -> DataFrame:
    """Batting and bowling of one player by season, from rows that carry their season.

    The player's deliveries and wickets become one list of narrow rows, reduced to a row per match
    and then to one per season, without a join; wickets are counted on their own, so a ball with two
    wickets does not count its runs twice.
    """
    bats, bowls = F.col("batter") == player, F.col("bowler") == player
    of = lambda condition, value: F.when(condition, value).otherwise(0).cast("bigint")
    balls = select_deliveries(deliveries, filters).where(bats | bowls).select(
        "season", "match_id", of(bats, F.col("batter_runs")).alias("runs"), of(bats, F.lit(1)).alias("balls"),
        of(bowls, F.lit(1)).alias("bowled"), of(bowls, F.col("total_runs")).alias("conceded"), F.lit(0).cast("bigint").alias("taken"),
    )
    zero = [F.lit(0).cast("bigint").alias(c) for c in ("runs", "balls", "bowled", "conceded")]
    fallen = wickets.where(bowls).select("season", "match_id", *zero, F.lit(1).cast("bigint").alias("taken"))
    sums = ("runs", "balls", "bowled", "conceded", "taken")
    per_match = balls.unionByName(fallen).groupBy("season", "match_id").agg(*[F.sum(c).alias(c) for c in sums])
    # a filter on deliveries leaves out the wickets of matches in which none of them is left
    here = F.col("bowled") > 0
    report = per_match.where("balls > 0 OR bowled > 0").groupBy("season").agg(
        F.count(F.when(F.col("balls") > 0, 1)).alias("bat_matches"), F.sum("runs").alias("runs"), F.sum("balls").alias("balls"),
        F.count(F.when(here, 1)).alias("bowl_matches"), F.sum(of(here, F.col("taken"))).alias("wickets"), F.sum("conceded").alias("conceded"),
    )
    return report.withColumn("strike_rate", _strike_rate("runs", "balls")).orderBy(F.desc("season"))


def team_season_report(
    matches: DataFrame, deliveries: DataFrame, team: str, filters: Filters = Filters()
) -> DataFrame:
    """Matches, wins and the team's own scoring by season. Both sides are reduced to a row per season
    before they meet; seasons without its deliveries stay."""
    played = matches.where((F.col("team1") == team) | (F.col("team2") == team)).groupBy("season").agg(
        F.count(F.lit(1)).alias("matches"), F.count(F.when(F.col("winner") == team, 1)).alias("wins")
    )
    scoring = select_deliveries(deliveries, filters).where(F.col("batting_team") == team).groupBy("season").agg(
        F.sum("total_runs").alias("runs"),
        F.count(F.when(F.col("batter_runs") == 4, 1)).alias("fours"),
        F.count(F.when(F.col("batter_runs") == 6, 1)).alias("sixes"),
    )
    figures = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("runs", "fours", "sixes")]
    return played.join(scoring, "season", "left").select("season", "matches", "wins", *figures).orderBy(F.desc("season"))


def overall_season_report(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("season")
        .agg(F.count("match_id").alias("matches"), _total("total_runs", "runs"), _total("total_wickets", "wickets"))
        .orderBy(F.desc("season"))
    )


def distinct_lists(fact: DataFrame, teams: DataFrame, players: DataFrame) -> dict[str, DataFrame]:
    """The choices offered by each filter, in display order."""
    return {
        "season": fact.select("season").distinct().orderBy(F.desc("season")),
        "team": teams.select("team_name").distinct().orderBy("team_name"),
        "player": players.select("player_name").distinct().orderBy("player_name"),
        "venue": fact.where(F.col("venue").isNotNull()).select("venue").distinct().orderBy("venue"),
    }


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) of every given table in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def table_sample(
    tables: dict[str, DataFrame], name: str, season: str | None = None, n: int = SAMPLE_ROWS,
    order: list[str] | None = None,
) -> DataFrame:
    """The first rows of an allowed table, on request only those of one season's matches."""
    if name not in INSPECTABLE_TABLES:
        raise PermissionError(f"table {name} may not be inspected")
    df = tables[name]
    if season and name in SEASON_TABLES:
        df = df.where(F.col("season") == str(season))
    elif season and name in MATCH_CHILD_TABLES:
        chosen = tables["match"].where(F.col("season") == str(season)).select("match_id")
        df = df.join(chosen, "match_id", "left_semi")
    return df.orderBy(*order).limit(n) if order else df.limit(n)


def missing_references(child: DataFrame, parent: DataFrame, on: list[str]) -> DataFrame:
    """Child rows whose key has no parent row."""
    return child.join(parent.select(*on).distinct(), on, "left_anti")
