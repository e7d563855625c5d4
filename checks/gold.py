"""Star schema."""

from pyspark.sql import functions as F

from checks.registry import check
from checks.views import sql
from matchlake.operators import gold
from matchlake.sources import adapters

FACT = (
    "match_id, season, strftime(match_date, '%Y-%m-%d') AS match_date, city, venue, match_type, scheduled_overs, "
    "balls_per_over, team1, team2, toss_winner, toss_decision, winner, win_by_runs, win_by_wickets, result, "
    "player_of_match, total_runs, total_wickets, total_boundaries, total_sixes"
)
FACT_COLUMNS = [
    "match_id", "season", "city", "venue", "match_type", "scheduled_overs", "balls_per_over", "team1", "team2",
    "toss_winner", "toss_decision", "winner", "win_by_runs", "win_by_wickets", "result", "player_of_match",
    "total_runs", "total_wickets", "total_boundaries", "total_sixes",
]


def show_fact(fact):
    return fact.select(*FACT_COLUMNS, F.col("match_date").cast("string").alias("match_date"))


def show_players(dimension):
    return dimension.withColumn("overs_bowled", F.col("overs_bowled").cast("double"))


def fact(spark, sf):
    return gold.match_summary(
        adapters.matches(spark, sf), adapters.ball_scores(spark, sf), adapters.wicket_matches(spark, sf)
    )


def dim_player(spark, sf):
    return gold.player_dimension(
        adapters.players(spark, sf), adapters.deliveries(spark, sf), adapters.wickets(spark, sf)
    )


@check("gold_match_summary", sql("fact", f"SELECT {FACT} FROM fact"))
def gold_match_summary(spark, sf):
    return show_fact(fact(spark, sf))


@check("gold_dim_team", sql("dim_team", "SELECT * FROM dim_team"))
def gold_dim_team(spark, sf):
    return gold.team_dimension(
        adapters.teams(spark, sf), adapters.matches(spark, sf), adapters.deliveries(spark, sf)
    )


@check("gold_dim_player", sql("dim_player", "SELECT * FROM dim_player"))
def gold_dim_player(spark, sf):
    return show_players(dim_player(spark, sf))


# Changed matches: key % 10 = 1 gets one more run per ball (as an extra), key % 10 = 2 disappears.
CHANGED = """
  SELECT f.* REPLACE (CAST(f.total_runs + coalesce(d.n, 0) AS BIGINT) AS total_runs)
  FROM fact f LEFT JOIN (SELECT match_id, count(*) AS n FROM delivery WHERE match_key % 10 = 1 GROUP BY 1) d USING (match_id)
  WHERE match_key % 10 <> 2
"""


def changed_inputs(spark, sf):
    """(keys of changed or removed matches, matches, deliveries, wickets after the change)."""
    digit = F.col("match_id").cast("bigint") % 10
    matches = adapters.matches(spark, sf)
    keys = matches.where((F.col("match_key") % 10).isin(1, 2)).select("match_id")
    after = adapters.ball_scores(spark, sf).where(digit != 2)
    after = after.withColumn("total_runs", F.col("total_runs") + F.when(digit == 1, 1).otherwise(0))
    return keys, matches.where(digit != 2), after, adapters.wicket_matches(spark, sf).where(digit != 2)


@check("gold_fact_incremental", sql("fact delivery", f"SELECT {FACT} FROM ({CHANGED})"))
def gold_fact_incremental(spark, sf):
    keys, matches, deliveries, wickets = changed_inputs(spark, sf)
    recomputed = gold.match_summary_for(keys, matches, deliveries, wickets)
    return show_fact(gold.refresh_fact(fact(spark, sf), keys, recomputed))


# The stored dimension covers the seasons before 1998; the fresh one those from 1998 on.
OLD_NEW_TEAM = """
  old_m AS (SELECT * FROM match WHERE season < '1998'), new_m AS (SELECT * FROM match WHERE season >= '1998' AND venue <> '5-LOW'),
  side AS (SELECT 'old' AS era, match_id, winner, unnest([team1, team2]) AS team_name FROM old_m
           UNION ALL SELECT 'new', match_id, winner, unnest([team1, team2]) FROM new_m),
  agg AS (SELECT era, team_name, CAST(count(*) AS BIGINT) AS matches_played,
                 CAST(count(*) FILTER (winner = team_name) AS BIGINT) AS wins FROM side GROUP BY 1, 2),
  run AS (SELECT CASE WHEN season < '1998' THEN 'old' ELSE 'new' END AS era, batting_team AS team_name,
                 CAST(sum(total_runs) AS BIGINT) AS total_runs, CAST(count(*) FILTER (batter_runs = 4) AS BIGINT) AS total_boundaries,
                 CAST(count(*) FILTER (batter_runs = 6) AS BIGINT) AS total_sixes
          FROM delivery WHERE match_id IN (SELECT match_id FROM old_m UNION ALL SELECT match_id FROM new_m) GROUP BY 1, 2),
  dims AS (SELECT era, team_name, matches_played, wins, coalesce(total_runs, 0) AS total_runs,
                  coalesce(total_boundaries, 0) AS total_boundaries, coalesce(total_sixes, 0) AS total_sixes
           FROM agg LEFT JOIN run USING (era, team_name) WHERE era = 'old' OR team_name LIKE '%1%')
"""


@check(
    "dim_team_upsert",
    sql(
        "match delivery",
        "SELECT * EXCLUDE (era) FROM dims d WHERE era = 'new' OR NOT EXISTS "
        "(SELECT 1 FROM dims n WHERE n.era = 'new' AND n.team_name = d.team_name)",
        OLD_NEW_TEAM,
    ),
)
def dim_team_upsert(spark, sf):
    matches = adapters.matches(spark, sf)
    deliveries = adapters.deliveries(spark, sf)

    def dimension(chosen):
        both = F.explode(F.array("team1", "team2"))
        return gold.team_dimension(
            chosen.select(both.alias("team_name")),
            chosen,
            deliveries.join(chosen.select("match_id"), "match_id", "left_semi"),
        )

    stored = dimension(matches.where("season < '1998'"))
    fresh = dimension(matches.where("season >= '1998' and venue <> '5-LOW'")).where("team_name like '%1%'")
    return gold.upsert(stored, fresh, "team_name")


PLAYER_SPLIT = """
  d_old AS (SELECT * FROM delivery WHERE season < '1998'), d_new AS (SELECT * FROM delivery WHERE season >= '2001'),
  per AS (SELECT 'old' AS era, match_id, batter AS player_name, sum(batter_runs) AS runs FROM d_old GROUP BY 1, 2, 3, innings_number
          UNION ALL SELECT 'new', match_id, batter, sum(batter_runs) FROM d_new GROUP BY 1, 2, 3, innings_number),
  dims AS (SELECT era, player_name, CAST(sum(runs) AS BIGINT) AS total_runs, CAST(max(runs) AS BIGINT) AS highest_score,
                  CAST(count(DISTINCT match_id) AS BIGINT) AS batting_matches FROM per GROUP BY 1, 2)
"""


@check(
    "dim_player_upsert",
    sql(
        "delivery",
        "SELECT * EXCLUDE (era) FROM dims d WHERE era = 'new' OR NOT EXISTS "
        "(SELECT 1 FROM dims n WHERE n.era = 'new' AND n.player_name = d.player_name)",
        PLAYER_SPLIT,
    ),
)
def dim_player_upsert(spark, sf):
    players = adapters.players(spark, sf)
    deliveries = adapters.deliveries(spark, sf)
    wickets = adapters.wickets(spark, sf)

    def batters(condition):
        dimension = gold.player_dimension(players, deliveries.where(condition), wickets.where(condition))
        return dimension.where("batting_innings > 0").select(
            "player_name", "total_runs", "highest_score", "batting_matches"
        )

    return gold.upsert(batters("season < '1998'"), batters("season >= '2001'"), "player_name")


@check("gold_dim_team_from_seasons", sql("dim_team", "SELECT * FROM dim_team"))
def gold_dim_team_from_seasons(spark, sf):
    """Totals per season first, then the career figures from them."""
    totals = gold.team_totals(adapters.matches(spark, sf), adapters.deliveries(spark, sf), ["season"])
    return gold.team_dimension_from(adapters.teams(spark, sf), totals)


@check("gold_dim_player_from_seasons", sql("dim_player", "SELECT * FROM dim_player"))
def gold_dim_player_from_seasons(spark, sf):
    """Totals per season first, then the career figures from them."""
    totals = gold.player_totals(adapters.deliveries(spark, sf), adapters.wickets(spark, sf), ["season"])
    return show_players(gold.player_dimension_from(adapters.players(spark, sf), totals))
