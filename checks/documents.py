"""Nested documents: parsing, routing, quality rules, flattening, exploration."""

from pyspark.sql import functions as F

from checks.registry import check
from checks.views import sql
from matchlake.operators import eda, quality, silver
from matchlake.session import scratch
from matchlake.sources import adapters
from matchlake.sources import documents as docs_source

TEAM = "NATION_3"
PLAYER = "NATION_7#15"


def parsed(spark, sf, defects=False, stored=False):
    """``stored``: for who goes through the documents several times."""
    read = adapters.stored_documents if stored else adapters.documents
    return docs_source.parse(read(spark, sf, defects).select("match_id", "raw_data"))


@check(
    "doc_parse",
    sql(
        "match over_row",
        "SELECT m.match_id, m.season, m.team1, CASE WHEN match_key % 97 = 3 THEN '' ELSE m.team2 END AS team2, "
        "CASE WHEN match_key % 97 <> 1 THEN 2 END AS innings, "
        "CAST(CASE match_key % 97 WHEN 1 THEN NULL WHEN 12 THEN 10 * coalesce(o.n, 0) ELSE coalesce(o.n, 0) END AS INT) AS overs "
        "FROM match m LEFT JOIN (SELECT match_id, count(*) AS n FROM over_row GROUP BY 1) o USING (match_id) "
        # cut off in the middle: no document
        "WHERE match_key % 97 <> 13",
    ),
)
def doc_parse(spark, sf):
    over_list = F.expr("flatten(transform(innings, i -> i.overs))")
    return docs_source.readable(parsed(spark, sf, defects=True)).select(
        "match_id", "season", F.get("info.teams", F.lit(0)).alias("team1"), F.get("info.teams", F.lit(1)).alias("team2"),
        F.size("innings").alias("innings"), F.size(over_list).alias("overs"),
    )


@check(
    "season_resolve",
    sql(
        "match",
        "SELECT match_id, CASE match_key % 5 WHEN 0 THEN season || '/' || lpad(CAST(CAST(season AS INT) % 100 + 1 AS VARCHAR), 2, '0') "
        "WHEN 1 THEN NULL ELSE season END AS season_raw, season FROM match",
    ),
)
def season_resolve(spark, sf):
    return parsed(spark, sf).select("match_id", F.col("info.season").alias("season_raw"), "season")


@check("route_by_team", sql("match", f"SELECT match_id, season FROM match WHERE '{TEAM}' IN (team1, team2)"))
def route_by_team(spark, sf):
    return docs_source.route(parsed(spark, sf), team=f"  {TEAM} ").select("match_id", "season")


@check(
    "route_by_player",
    sql("match squad", f"SELECT DISTINCT match_id, season FROM squad WHERE player_name = '{PLAYER}' AND season IN ('1996', '1997')"),
)
def route_by_player(spark, sf):
    routed = docs_source.route(parsed(spark, sf), seasons=["1996", "1997"], player=PLAYER)
    return routed.select("match_id", "season")


@check(
    "stage_counts",
    sql("match", "SELECT season, count(*) AS staged FROM match WHERE season IN ('1996', '1997', '1998') GROUP BY 1"),
)
def stage_counts(spark, sf):
    path = scratch(spark, "staged")
    docs = parsed(spark, sf, stored=True)
    docs_source.stage(docs_source.route(docs, seasons=["1996", "1997"]), path)
    # staging one of the seasons again, with a further one, leaves every season complete and single
    docs_source.stage(docs_source.route(docs, seasons=["1997", "1998"]), path)
    return docs_source.season_counts(docs_source.read_staged(spark, path))


@check(
    "match_flat_record",
    sql("lake", "SELECT * FROM lake"),
)
def match_flat_record(spark, sf):
    return silver.flat_record(parsed(spark, sf)).drop("raw_payload", "ingested_at")


RULES = """
  CASE WHEN d IN (1, 13) THEN 'SCHEMA_VALIDATION' WHEN d = 2 THEN 'REQUIRED_FIELDS' WHEN d = 3 THEN 'NULL_CHECK'
       WHEN d IN (4, 14) THEN 'DATATYPE_CHECK' WHEN d = 5 AND balls > 0 THEN 'RANGE_CHECK'
       WHEN d = 6 AND balls > 0 THEN 'INVALID_RUNS' WHEN d = 7 THEN 'TEAM_VALIDATION'
       WHEN d = 8 THEN 'PLAYER_VALIDATION' WHEN d = 9 THEN 'REFERENTIAL_INTEGRITY'
       WHEN d = 12 AND 10 * runs > 560 THEN 'OUTLIER_DETECTION'
       WHEN CASE WHEN d = 12 THEN 10 ELSE 1 END * runs < 30 AND winner IS NOT NULL THEN 'OUTLIER_DETECTION'
       WHEN d IN (10, 11) THEN 'OUTLIER_DETECTION' END
"""
CLASSED = (
    f"classed AS (SELECT match_id, CASE WHEN d NOT IN (13) THEN season END AS season, {RULES} AS error_type FROM "
    "(SELECT m.match_id, m.season, m.winner, m.match_key % 97 AS d, coalesce(r.runs, 0) AS runs, coalesce(r.balls, 0) AS balls "
    "FROM match m LEFT JOIN (SELECT match_id, sum(total_runs) AS runs, count(*) AS balls FROM delivery GROUP BY 1) r USING (match_id)))"
)


def checked(spark, sf):
    return quality.classify(parsed(spark, sf, defects=True))


@check("dq_classify", sql("match delivery", "SELECT match_id, error_type FROM classed", CLASSED))
def dq_classify(spark, sf):
    return checked(spark, sf).select("match_id", "error_type")


@check(
    "dq_summary",
    sql(
        "match delivery",
        "SELECT season, count(*) AS processed, count(*) FILTER (error_type IS NULL) AS valid, "
        "count(error_type) AS quarantined FROM classed GROUP BY 1",
        CLASSED,
    ),
)
def dq_summary(spark, sf):
    return quality.summary(checked(spark, sf))


@check(
    "dq_quarantine",
    sql(
        "match delivery",
        "SELECT season, match_id || '.json' AS source, 'STAGING' AS stage, error_type, 'QUARANTINED' AS status "
        "FROM classed WHERE error_type IS NOT NULL",
        CLASSED,
    ),
)
def dq_quarantine(spark, sf):
    return quality.quarantine(checked(spark, sf)).drop("error_message", "raw_record")


def flat(name, oracle, columns=None, key=None):
    """Register the round trip of one silver table."""

    def query(spark, sf):
        rows = silver.TABLES[name](parsed(spark, sf))
        return rows.selectExpr(*columns) if columns else rows

    query.__name__ = key or f"silver_{name}"
    check(query.__name__, oracle)(query)


flat("team", sql("team", "SELECT * FROM team"))
flat(
    "player",
    sql(
        "player match",
        "SELECT player_name, CASE WHEN player_name LIKE '%#1' THEN 'id-' || replace(player_name, '#1', '') END AS registry_id FROM player",
    ),
)
OFFICIALS = (
    "off AS (SELECT match_id, season, 'U' || o_custkey % 40 AS official_name, 'umpires' AS official_role FROM match "
    "UNION ALL SELECT match_id, season, 'U' || (o_custkey + 1) % 40, 'umpires' FROM match "
    "UNION ALL SELECT match_id, season, 'R' || o_custkey % 9, 'referee' FROM match)"
)
flat("official", sql("match", "SELECT DISTINCT official_name, official_role FROM off", OFFICIALS))
flat("match_official", sql("match", "SELECT * FROM off", OFFICIALS))
flat(
    "match",
    sql(
        "match",
        "SELECT match_id, season, strftime(match_date, '%Y-%m-%d') AS match_date, city, venue, match_type, scheduled_overs, "
        "balls_per_over, team1, team2, toss_winner, toss_decision, winner, win_by_runs, win_by_wickets, result, player_of_match FROM match",
    ),
    ["match_id", "season", "CAST(match_date AS STRING) AS match_date", "city", "venue", "match_type", "scheduled_overs",
     "balls_per_over", "team1", "team2", "toss_winner", "toss_decision", "winner", "win_by_runs", "win_by_wickets",
     "result", "player_of_match"],
)
flat("toss", sql("match", "SELECT match_id, season, toss_winner, toss_decision FROM match"))
flat(
    "player_of_match",
    sql("match", "SELECT match_id, season, player_of_match AS player_name FROM match WHERE player_of_match IS NOT NULL"),
    key="silver_pom",
)
flat("team_squad", sql("squad", "SELECT match_id, season, team_name, player_name FROM squad"))
INNINGS = "inn AS (SELECT match_id, season, 1 AS innings_number, team1 AS batting_team FROM match UNION ALL SELECT match_id, season, 2, team2 FROM match)"
flat(
    "innings",
    sql("match", "SELECT *, CAST(NULL AS INT) AS target_runs FROM inn", INNINGS),
    ["match_id", "season", "innings_number", "batting_team", "target_runs"],
)
flat(
    "powerplay",
    sql("match", "SELECT *, 0.1::DOUBLE AS from_delivery, 5.6::DOUBLE AS to_delivery, 'mandatory' AS powerplay_type FROM inn", INNINGS),
    ["match_id", "season", "innings_number", "batting_team", "CAST(from_delivery AS DOUBLE) AS from_delivery",
     "CAST(to_delivery AS DOUBLE) AS to_delivery", "powerplay_type"],
)
DELIVERY = [
    "match_id", "season", "innings_number", "batting_team", "over_number", "actual_delivery", "batter", "bowler",
    "non_striker", "batter_runs", "extras", "total_runs", "wides", "noballs", "byes", "legbyes",
]
flat(
    "delivery",
    sql("delivery", f"SELECT {', '.join(DELIVERY)} FROM (SELECT *, 0 AS noballs, 0 AS byes FROM delivery)"),
    DELIVERY,
)
WICKET = [
    "match_id", "season", "innings_number", "over_number", "actual_delivery", "batter", "bowler", "player_out",
    "dismissal_kind",
]
flat("wicket", sql("wicket", f"SELECT {', '.join(WICKET)} FROM wicket"), WICKET)
flat(
    "wicket_fielder",
    sql("wicket", "SELECT match_id, season, fielder AS player_name FROM wicket WHERE fielder IS NOT NULL"),
    ["match_id", "season", "player_name"],
)


@check(
    "eda_kpi",
    sql(
        "match delivery wicket squad team",
        "SELECT (SELECT count(*) FROM match) AS matches, (SELECT count(*) FROM delivery) AS deliveries, "
        "(SELECT CAST(sum(total_runs) AS BIGINT) FROM delivery) AS runs, (SELECT count(*) FROM wicket) AS wickets, "
        "(SELECT count(*) FROM delivery WHERE batter_runs = 4) AS boundaries, "
        "(SELECT count(*) FROM delivery WHERE batter_runs = 6) AS sixes, "
        "(SELECT count(DISTINCT player_name) FROM squad) AS players, (SELECT count(*) FROM team) AS teams",
    ),
)
def eda_kpi(spark, sf):
    return eda.kpi(parsed(spark, sf))


@check(
    "eda_team_runs",
    sql("delivery", "SELECT batting_team AS team, CAST(sum(total_runs) AS BIGINT) AS runs FROM delivery GROUP BY 1"),
)
def eda_team_runs(spark, sf):
    return eda.runs_by_team(parsed(spark, sf))


@check(
    "eda_top_batters",
    sql(
        "delivery",
        "SELECT batter AS player, CAST(sum(batter_runs) AS BIGINT) AS runs FROM delivery GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    ),
)
def eda_top_batters(spark, sf):
    return eda.top_batters(parsed(spark, sf))


@check(
    "eda_top_bowlers",
    sql(
        "wicket",
        "SELECT bowler AS player, count(*) AS wickets FROM wicket WHERE dismissal_kind NOT IN ('run out', 'retired hurt') "
        "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    ),
)
def eda_top_bowlers(spark, sf):
    return eda.top_bowlers(parsed(spark, sf))


@check(
    "eda_venues",
    sql("match", "SELECT venue, count(*) AS matches FROM match GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
)
def eda_venues(spark, sf):
    return eda.venues(parsed(spark, sf))


@check(
    "eda_run_distribution",
    sql(
        "delivery",
        "SELECT 'boundary_dist' AS chart, 'Fours' AS label, 4 * fours AS value FROM t UNION ALL SELECT 'boundary_dist', 'Sixes', 6 * sixes FROM t "
        "UNION ALL SELECT 'boundary_dist', 'Other Runs', greatest(0, runs - 4 * fours - 6 * sixes) FROM t "
        "UNION ALL SELECT 'six_dist', 'Sixes', 6 * sixes FROM t UNION ALL SELECT 'six_dist', 'Other runs', greatest(0, runs - 6 * sixes) FROM t "
        "UNION ALL SELECT 'dot_ball_pct', 'Dot Balls', dots FROM t UNION ALL SELECT 'dot_ball_pct', 'Scoring Balls', greatest(0, n - dots) FROM t",
        "t AS (SELECT count(*) AS n, CAST(sum(total_runs) AS BIGINT) AS runs, count(*) FILTER (batter_runs = 4) AS fours, "
        "count(*) FILTER (batter_runs = 6) AS sixes, count(*) FILTER (total_runs = 0 AND wides = 0) AS dots FROM delivery)",
    ),
)
def eda_run_distribution(spark, sf):
    return eda.run_distribution(parsed(spark, sf))


@check(
    "eda_team_performance",
    sql(
        "match team",
        "SELECT team_name AS team, count(*) AS matches, count(*) FILTER (winner = team_name) AS wins "
        "FROM team JOIN match ON team_name IN (team1, team2) GROUP BY 1",
    ),
)
def eda_team_performance(spark, sf):
    return eda.team_performance(parsed(spark, sf))
