"""Gold star schema: match fact, team and player dimensions, rebuilt or upserted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.constants import DEFAULT_BALLS_PER_OVER
from matchlake.schemas import FACT_MEASURES, MATCH_COLUMNS, PLAYER_MEASURES


def _count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)


def match_summary(matches: DataFrame, deliveries: DataFrame, wickets: DataFrame) -> DataFrame:
    """One row per match with its totals: one pass over deliveries, one over wickets, and joins
    of already aggregated rows, all on match_id."""
    scoring = deliveries.groupBy("match_id").agg(
        F.sum("total_runs").alias("total_runs"),
        _count_if(F.col("batter_runs") == 4).alias("total_boundaries"),
        _count_if(F.col("batter_runs") == 6).alias("total_sixes"),
    )
    fallen = wickets.groupBy("match_id").agg(F.count(F.lit(1)).alias("total_wickets"))
    joined = matches.select(*MATCH_COLUMNS).join(scoring, "match_id", "left").join(fallen, "match_id", "left")
    return joined.select(*MATCH_COLUMNS, *[_zero(m) for m in FACT_MEASURES])


def match_summary_for(
    keys: DataFrame, matches: DataFrame, deliveries: DataFrame, wickets: DataFrame
) -> DataFrame:
    """The fact rows of some matches only (``keys``: match_id): inputs are semi-joined first."""
    return match_summary(*[df.join(keys, "match_id", "left_semi") for df in (matches, deliveries, wickets)])


def refresh_fact(fact: DataFrame, changed: DataFrame, recomputed: DataFrame) -> DataFrame:
    """Replace the fact rows of changed or removed matches (``changed``: match_id) in one step."""
    return fact.join(changed, "match_id", "left_anti").unionByName(recomputed)


TEAM_MEASURES = ["matches_played", "wins", "total_runs", "total_boundaries", "total_sixes"]


def team_totals(matches: DataFrame, deliveries: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Matches played, wins and scoring per team (and per ``by``, e.g. season).

    "team1 = t OR team2 = t" becomes two rows per match and an equi-join; a match has one row and its
    sides differ, so plain counts do. They are combined before the shuffle and done before the join.
    """
    by = by or []
    keys = [*by, "team_name"]
    sides = matches.select(
        *by, "match_id", "winner", F.explode(F.array_distinct(F.array("team1", "team2"))).alias("team_name")
    )
    played = sides.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("matches_played"), _count_if(F.col("winner") == F.col("team_name")).alias("wins"),
    )
    scored = deliveries.groupBy(*by, F.col("batting_team").alias("team_name")).agg(
        F.sum("total_runs").alias("total_runs"),
        _count_if(F.col("batter_runs") == 4).alias("total_boundaries"),
        _count_if(F.col("batter_runs") == 6).alias("total_sixes"),
    )
    return played.join(scored, keys, "full_outer")


def _team_rows(teams: DataFrame, totals: DataFrame) -> DataFrame:
    joined = teams.select("team_name").distinct().join(totals, "team_name", "left")
    return joined.select("team_name", *[_zero(m) for m in TEAM_MEASURES])


def team_dimension(teams: DataFrame, matches: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Career figures of every known team."""
    return _team_rows(teams, team_totals(matches, deliveries))


def team_dimension_from(teams: DataFrame, season_totals: DataFrame) -> DataFrame:
    """The same from stored totals per season. A match belongs to one season, so all figures add up,
    and a load recomputes the totals of its own seasons only."""
    summed = season_totals.groupBy("team_name").agg(*[F.sum(m).alias(m) for m in TEAM_MEASURES])
    return _team_rows(teams, summed)


PLAYER_MAXIMA = ["highest_score", "best_wickets"]
PLAYER_SUMS = [m for m in PLAYER_MEASURES if m not in (*PLAYER_MAXIMA, "overs_bowled")]


def player_innings(deliveries: DataFrame, wickets: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Batting and bowling of each player in each innings, in one row and out of one shuffle.

    A delivery is a row of its batter and a row of its bowler, a wicket one more of the bowler; all are
    combined before they are shuffled. ``faced`` and ``bowled`` are 0 where the player did not bat or
    bowl. Wickets in an innings that has no ball of the bowler do not count.
    """
    by, kept = by or [], ["match_id", "innings_number"]
    zero = F.lit(0).cast("long")
    one = lambda condition: F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("long")
    names = ("player_name", "faced", "runs", "fours", "sixes", "bowled", "conceded", "taken")
    row = lambda *values: F.struct(*[v.alias(n) for n, v in zip(names, values)])
    total = lambda c: F.coalesce(F.col(c).cast("long"), zero)
    batter = row(F.col("batter"), F.lit(1).cast("long"), total("batter_runs"), one(F.col("batter_runs") == 4), one(F.col("batter_runs") == 6), zero, zero, zero)
    bowler = row(F.col("bowler"), zero, zero, zero, zero, F.lit(1).cast("long"), total("total_runs"), zero)
    balls = deliveries.select(*by, *kept, F.inline(F.array(batter, bowler)))
    # an innings without a number equals no other
    outs = wickets.where(F.col("innings_number").isNotNull()).select(
        *by, *kept, F.inline(F.array(row(F.col("bowler"), *[zero] * 6, F.lit(1).cast("long")))))
    summed = balls.unionByName(outs).groupBy(*by, *kept, "player_name").agg(*[F.sum(c).alias(c) for c in names[1:]])
    return summed.where("faced > 0 or bowled > 0").withColumn("taken", F.when(F.col("bowled") > 0, F.col("taken")).otherwise(zero))


def player_totals(deliveries: DataFrame, wickets: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Batting and bowling figures per player (and per ``by``, e.g. season).

    Three levels of sums: innings, match, player. A match in which a player batted is a flag of the
    match level, so matches add up and nothing distinct is counted. Each level combines its rows before
    its shuffle; the second and third move rows of innings and matches, not deliveries.
    """
    by = by or []
    runs, faced, bowled = F.col("runs"), F.col("faced") > 0, F.col("bowled") > 0
    match = player_innings(deliveries, wickets, by).groupBy(*by, "match_id", "player_name").agg(
        _count_if(faced).alias("batting_innings"), F.sum("runs").alias("total_runs"), F.sum("faced").alias("total_balls"),
        F.sum("fours").alias("total_fours"), F.sum("sixes").alias("total_sixes"), F.max(F.when(faced, runs)).alias("highest_score"),
        _count_if(faced & (runs >= 50) & (runs < 100)).alias("fifties"), _count_if(faced & (runs >= 100)).alias("hundreds"),
        _count_if(bowled).alias("bowling_innings"), F.sum("bowled").alias("balls_bowled"), F.sum("conceded").alias("runs_conceded"),
        F.sum("taken").alias("wickets_taken"), F.max(F.when(bowled, F.col("taken"))).alias("best_wickets"),
    )
    added = [c for c in match.columns if c not in (*by, "match_id", "player_name", *PLAYER_MAXIMA)]
    named = F.col("match_id").isNotNull()
    return match.groupBy(*by, "player_name").agg(
        _count_if(named & (F.col("batting_innings") > 0)).alias("batting_matches"), _count_if(named & (F.col("bowling_innings") > 0)).alias("bowling_matches"),
        *[F.sum(c).alias(c) for c in added], *[F.max(c).alias(c) for c in PLAYER_MAXIMA],
    )


def _player_rows(players: DataFrame, totals: DataFrame) -> DataFrame:
    known = totals.join(players.select("player_name"), "player_name", "left_semi")
    balls = F.coalesce("balls_bowled", F.lit(0)).cast("decimal(18,0)")
    overs = F.round(balls / F.lit(DEFAULT_BALLS_PER_OVER).cast("decimal(2,0)"), 1).cast("decimal(18,1)")
    measures = [overs.alias(m) if m == "overs_bowled" else _zero(m) for m in PLAYER_MEASURES]
    return known.select("player_name", *measures)


def player_dimension(players: DataFrame, deliveries: DataFrame, wickets: DataFrame) -> DataFrame:
    """Career figures of every known player who batted or bowled."""
    return _player_rows(players, player_totals(deliveries, wickets))


def player_dimension_from(players: DataFrame, season_totals: DataFrame) -> DataFrame:
    """The same from stored totals per season."""
    career = season_totals.groupBy("player_name").agg(
        *[F.sum(m).alias(m) for m in PLAYER_SUMS], *[F.max(m).alias(m) for m in PLAYER_MAXIMA]
    )
    return _player_rows(players, career)


def upsert(current: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """Fresh rows win; rows whose key is missing from ``fresh`` stay as they are."""
    return fresh.unionByName(current.join(fresh.select(key), key, "left_anti"))
