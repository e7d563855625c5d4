"""Analytics on the star schema and serving queries on the lakehouse table."""

from pyspark.sql import functions as F

from checks.gold import dim_player, fact
from checks.registry import check
from checks.views import half_up, sql
from matchlake.operators import analytics, lakehouse, references
from matchlake.operators.analytics import Filters
from matchlake.sources import adapters
from matchlake.sources import lakehouse as lake_table
from matchlake.session import scratch

SEASON = "1998"
TEAM = "NATION_3"
PLAYER = "NATION_3#2"
ALL_ROUNDER = "NATION_3#5"
FILTERS = Filters(from_season="1996", to_season="1999", team=TEAM)
WHERE = f"season BETWEEN '1996' AND '1999' AND (team1 = '{TEAM}' OR team2 = '{TEAM}')"


@check(
    "analytics_filtered",
    sql("fact", f"SELECT match_id, season, team1, team2, venue, total_runs FROM fact WHERE {WHERE} AND venue = '2-HIGH'"),
)
def analytics_filtered(spark, sf):
    chosen = Filters(from_season="1996", to_season="1999", team=TEAM, venue="2-HIGH")
    return analytics.select_matches(fact(spark, sf), chosen).select(
        "match_id", "season", "team1", "team2", "venue", "total_runs"
    )


@check(
    "analytics_kpi",
    sql(
        "fact",
        "SELECT count(*) AS matches, CAST(coalesce(sum(total_runs), 0) AS BIGINT) AS runs, "
        "CAST(coalesce(sum(total_wickets), 0) AS BIGINT) AS wickets, "
        "CAST(coalesce(sum(total_boundaries), 0) AS BIGINT) AS boundaries, "
        f"CAST(coalesce(sum(total_sixes), 0) AS BIGINT) AS sixes FROM fact WHERE {WHERE}",
    ),
)
def analytics_kpi(spark, sf):
    return analytics.kpi(fact(spark, sf), FILTERS)


@check(
    "active_players",
    sql(
        "match squad",
        "SELECT count(DISTINCT player_name) AS players FROM squad "
        f"WHERE match_id IN (SELECT match_id FROM match WHERE {WHERE})",
    ),
)
def active_players(spark, sf):
    # the filter columns of the fact are those of the match table
    return analytics.active_players(
        adapters.matches(spark, sf), adapters.squads(spark, sf), adapters.players(spark, sf), FILTERS
    )


@check(
    "player_kpi",
    sql(
        "dim_player",
        "SELECT CASE WHEN batting_matches <> 0 THEN batting_matches ELSE bowling_matches END AS matches, "
        "total_runs AS runs, wickets_taken AS wickets, total_fours AS boundaries, total_sixes AS sixes, 1 AS players "
        f"FROM dim_player WHERE player_name = '{ALL_ROUNDER}'",
    ),
)
def player_kpi(spark, sf):
    return analytics.player_kpi(dim_player(spark, sf), ALL_ROUNDER)


@check("runs_by_season", sql("fact", f"SELECT season, CAST(sum(total_runs) AS BIGINT) AS runs FROM fact WHERE {WHERE} GROUP BY 1"))
def runs_by_season(spark, sf):
    return analytics.runs_by_season(fact(spark, sf), FILTERS)


def _top_sql(measure, members=""):
    return sql(
        "dim_player squad",
        f"SELECT player_name, {measure} FROM dim_player WHERE {measure} > 0 {members} "
        f"ORDER BY {measure} DESC, player_name LIMIT 10",
    )


MEMBERS = f"AND player_name IN (SELECT player_name FROM squad WHERE team_name = '{TEAM}')"


@check("top_batters", _top_sql("total_runs"))
def top_batters(spark, sf):
    return analytics.top_players(dim_player(spark, sf), "total_runs")


@check("top_bowlers", _top_sql("wickets_taken"))
def top_bowlers(spark, sf):
    return analytics.top_players(dim_player(spark, sf), "wickets_taken")


@check("top_batters_by_team", _top_sql("total_runs", MEMBERS))
def top_batters_by_team(spark, sf):
    return analytics.top_players(dim_player(spark, sf), "total_runs", adapters.squads(spark, sf), TEAM)


@check("top_bowlers_by_team", _top_sql("wickets_taken", MEMBERS))
def top_bowlers_by_team(spark, sf):
    return analytics.top_players(dim_player(spark, sf), "wickets_taken", adapters.squads(spark, sf), TEAM)


@check(
    "venue_top10",
    sql("match", f"SELECT venue, count(*) AS matches FROM match WHERE {WHERE} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
)
def venue_top10(spark, sf):
    return analytics.venue_matches(adapters.matches(spark, sf), FILTERS)


@check(
    "player_season_report",
    sql(
        "match delivery wicket",
        "SELECT coalesce(bat.season, bowl.season) AS season, coalesce(bat_matches, 0) AS bat_matches, "
        "CAST(coalesce(runs, 0) AS BIGINT) AS runs, coalesce(balls, 0) AS balls, coalesce(bowl_matches, 0) AS bowl_matches, "
        "CAST(coalesce(wickets, 0) AS BIGINT) AS wickets, CAST(coalesce(conceded, 0) AS BIGINT) AS conceded, "
        f"CASE WHEN balls > 0 THEN {half_up('100 * runs', 'balls', 1)} ELSE 0.0 END AS strike_rate "
        "FROM (SELECT season, count(DISTINCT match_id) AS bat_matches, sum(batter_runs) AS runs, count(*) AS balls "
        f"FROM delivery WHERE batter = '{PLAYER}' GROUP BY 1) bat "
        "FULL JOIN (SELECT season, count(DISTINCT match_id) AS bowl_matches, sum(total_runs) AS conceded, sum(coalesce(w.n, 0)) AS wickets "
        "FROM delivery LEFT JOIN (SELECT delivery_id, count(*) AS n FROM wicket GROUP BY 1) w USING (delivery_id) "
        f"WHERE bowler = '{PLAYER}' GROUP BY 1) bowl ON bat.season = bowl.season",
    ),
)
def player_season_report(spark, sf):
    return analytics.player_season_report(adapters.deliveries(spark, sf), adapters.wickets(spark, sf), PLAYER)


@check(
    "bowler_season_report",
    sql(
        "delivery wicket",
        "SELECT season, CAST(0 AS BIGINT) AS bat_matches, CAST(0 AS BIGINT) AS runs, CAST(0 AS BIGINT) AS balls, "
        "count(DISTINCT match_id) AS bowl_matches, CAST(sum(coalesce(w.n, 0)) AS BIGINT) AS wickets, "
        "CAST(sum(total_runs) AS BIGINT) AS conceded, CAST(0 AS DOUBLE) AS strike_rate "
        "FROM delivery LEFT JOIN (SELECT delivery_id, count(*) AS n FROM wicket GROUP BY 1) w USING (delivery_id) "
        f"WHERE bowler = '{ALL_ROUNDER}' GROUP BY 1",
    ),
)
def bowler_season_report(spark, sf):
    return analytics.player_season_report(adapters.deliveries(spark, sf), adapters.wickets(spark, sf), ALL_ROUNDER)


@check(
    "team_season_report",
    sql(
        "match delivery",
        "SELECT season, matches, wins, coalesce(runs, 0) AS runs, coalesce(fours, 0) AS fours, coalesce(sixes, 0) AS sixes "
        "FROM games LEFT JOIN bat USING (season)",
        f"""games AS (SELECT season, count(*) AS matches, count(*) FILTER (winner = '{TEAM}') AS wins
                      FROM match WHERE '{TEAM}' IN (team1, team2) GROUP BY season),
            bat AS (SELECT season, CAST(sum(total_runs) AS BIGINT) AS runs, count(*) FILTER (batter_runs = 4) AS fours,
                           count(*) FILTER (batter_runs = 6) AS sixes
                    FROM delivery WHERE batting_team = '{TEAM}' GROUP BY season)""",
    ),
)
def team_season_report(spark, sf):
    return analytics.team_season_report(adapters.matches(spark, sf), adapters.deliveries(spark, sf), TEAM)


@check(
    "overall_season_report",
    sql(
        "fact",
        "SELECT season, count(*) AS matches, CAST(sum(total_runs) AS BIGINT) AS runs, "
        "CAST(sum(total_wickets) AS BIGINT) AS wickets FROM fact GROUP BY 1",
    ),
)
def overall_season_report(spark, sf):
    return analytics.overall_season_report(fact(spark, sf))


@check(
    "distinct_lists",
    sql(
        "match team player",
        "SELECT 'season' AS list, season AS value FROM match UNION SELECT 'team', team_name FROM team "
        "UNION SELECT 'player', player_name FROM player UNION SELECT 'venue', venue FROM match WHERE venue IS NOT NULL",
    ),
)
def distinct_lists(spark, sf):
    lists = analytics.distinct_lists(
        adapters.matches(spark, sf), adapters.teams(spark, sf), adapters.players(spark, sf)
    )
    parts = [df.toDF("value").select(F.lit(name).alias("list"), "value") for name, df in lists.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def star_tables(spark, sf):
    return {
        "match": adapters.matches(spark, sf),
        "team": adapters.teams(spark, sf),
        "player": adapters.players(spark, sf),
        "team_squad": adapters.squads(spark, sf),
        "delivery": adapters.deliveries(spark, sf),
        "wicket": adapters.wickets(spark, sf),
        "fact_match_summary": adapters.matches(spark, sf),
    }


@check(
    "table_stats",
    sql(
        "match team player squad delivery wicket",
        " UNION ALL ".join(
            f"SELECT '{label}' AS \"table\", count(*) AS rows FROM {view}"
            for label, view in [
                ("match", "match"), ("team", "team"), ("player", "player"), ("team_squad", "squad"),
                ("delivery", "delivery"), ("wicket", "wicket"), ("fact_match_summary", "match"),
            ]
        ),
    ),
)
def table_stats(spark, sf):
    return analytics.table_counts(star_tables(spark, sf))


@check(
    "table_sample_semi",
    sql(
        "match squad",
        f"SELECT match_id, team_name, player_name FROM squad WHERE match_id IN (SELECT match_id FROM match WHERE season = '{SEASON}') "
        "ORDER BY match_id, team_name, player_name LIMIT 10",
    ),
)
def table_sample_semi(spark, sf):
    order = ["match_id", "team_name", "player_name"]
    return analytics.table_sample(star_tables(spark, sf), "team_squad", SEASON, order=order).select(*order)


@check(
    "ref_integrity",
    sql(
        "match delivery",
        "SELECT DISTINCT match_id, team_name FROM (SELECT match_id, CASE WHEN match_key % 13 = 0 AND innings_number = 2 THEN 'Nobody' "
        "ELSE batting_team END AS team_name FROM delivery) d WHERE NOT EXISTS "
        "(SELECT 1 FROM match m WHERE m.match_id = d.match_id AND d.team_name IN (m.team1, m.team2))",
    ),
)
def ref_integrity(spark, sf):
    odd = (F.col("match_id").cast("bigint") % 13 == 0) & (F.col("innings_number") == 2)
    batting = adapters.deliveries(spark, sf).select(
        "match_id", F.when(odd, "Nobody").otherwise(F.col("batting_team")).alias("team_name")
    )
    sides = adapters.matches(spark, sf).select("match_id", F.explode(F.array("team1", "team2")).alias("team_name"))
    return analytics.missing_references(batting.distinct(), sides, ["match_id", "team_name"])


AUDITED = [
    ("match", "team1", "team", "team_name"), ("match", "team2", "team", "team_name"), ("match", "winner", "team", "team_name"),
    ("match", "player_of_match", "player", "player_name"), ("team_squad", "match_id", "match", "match_id"), ("team_squad", "team_name", "team", "team_name"),
    ("team_squad", "player_name", "player", "player_name"), ("delivery", "match_id", "match", "match_id"), ("delivery", "batting_team", "team", "team_name"),
    ("delivery", "batter", "player", "player_name"), ("delivery", "non_striker", "player", "player_name"), ("delivery", "bowler", "player", "player_name"),
    ("wicket", "delivery_id", "delivery", "delivery_id"), ("wicket", "player_out", "player", "player_name"), ("wicket", "fielder", "player", "player_name"),
]
#: Parents that are gone: a team, some players, some matches, the deliveries of others.
LEFT = {
    "team": "team_name <> 'NATION_3'", "player": "player_name NOT LIKE '%2'", "match": "CAST(match_id AS BIGINT) % 50 <> 0",
    "delivery": "CAST(match_id AS BIGINT) % 7 <> 0", "team_squad": "true", "wicket": "true",
}
KEPT = ", ".join(f"kept_{t} AS (SELECT * FROM {'squad' if t == 'team_squad' else t} WHERE {w})" for t, w in LEFT.items())
PAIRS = (
    "SELECT 'delivery' AS child, 'match_id+batter' AS columns, 'team_squad' AS parent, length(match_id) || ':' || match_id || length(batter) || ':' || batter AS key, "
    "count(*) AS rows FROM kept_delivery d WHERE NOT EXISTS (SELECT 1 FROM squad s WHERE s.match_id = d.match_id AND s.player_name = d.batter) GROUP BY 4"
)


@check(
    "ref_audit",
    sql(
        "match delivery wicket team squad player",
        " UNION ALL ".join(
            f"SELECT '{child}' AS child, '{own}' AS columns, '{parent}' AS parent, c.{own} AS key, count(*) AS rows FROM kept_{child} c "
            f"WHERE c.{own} IS NOT NULL AND c.{own} NOT IN (SELECT {key} FROM kept_{parent}) GROUP BY 4"
            for child, own, parent, key in AUDITED
        ) + " UNION ALL " + PAIRS,
        KEPT,
    ),
)
def ref_audit(spark, sf):
    """All references of the schema at once, after some parents were taken away."""
    sources = {
        "match": adapters.matches, "delivery": adapters.deliveries, "wicket": adapters.wickets, "team": adapters.teams,
        "player": adapters.players, "team_squad": adapters.squads,
    }
    return references.audit({name: source(spark, sf).where(LEFT[name]) for name, source in sources.items()})


def lake_rows(spark, sf):
    """The lakehouse rows, without the raw document."""
    overs = adapters.overs(spark, sf).groupBy("match_id").agg(F.count(F.lit(1)).alias("total_overs"))
    rows = fact(spark, sf).join(overs, "match_id", "left")
    return rows.withColumn("match_date", F.col("match_date").cast("string")).withColumn(
        "total_overs", F.coalesce("total_overs", F.lit(0)).cast("int")
    )


WRITTEN = {}


def lake(spark, sf):
    """The lakehouse table, partitioned by season, as it is read back; written once per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in WRITTEN:
        WRITTEN[key] = written_lake(spark, sf)
    return lake_table.read_table(spark, WRITTEN[key])


def written_lake(spark, sf):
    path = scratch(spark, "lake")
    rows = lake_rows(spark, sf).select(
        "*", F.lit(None).cast("string").alias("raw_payload"), F.current_timestamp().alias("ingested_at")
    )
    lake_table.write_seasons(rows, path)
    return path


LAKE_COLUMNS = [
    "match_id", "season", "match_date", "match_type", "venue", "city", "team1", "team2", "toss_winner",
    "toss_decision", "winner", "win_by_runs", "win_by_wickets", "player_of_match", "total_overs", "total_runs",
    "total_wickets",
]


@check("lh_sink_roundtrip", sql("lake", f"SELECT {', '.join(LAKE_COLUMNS)} FROM lake"))
def lh_sink_roundtrip(spark, sf):
    path = written_lake(spark, sf)
    # writing one season again must replace it, not add to it
    again = lake_table.read_table(spark, path).where(F.col("season") == SEASON)
    copy = scratch(spark, "lake-season")
    lake_table.write_seasons(again, copy)
    lake_table.write_seasons(lake_table.read_table(spark, copy), path)
    return lake_table.read_table(spark, path).select(*LAKE_COLUMNS)


@check("lh_partitions", sql("match", "SELECT season, count(*) AS record_count FROM match GROUP BY 1"))
def lh_partitions(spark, sf):
    table = lake_table.read_table(spark, written_lake(spark, sf))
    return lakehouse.partitions(table).where(F.col("file_count") > 0).select("season", "record_count")


@check(
    "lh_scan_pruned",
    sql("lake", f"SELECT match_id, match_date, team1, team2, total_runs FROM lake WHERE season = '{SEASON}'"),
)
def lh_scan_pruned(spark, sf):
    return lakehouse.season_matches(lake_table.read_table(spark, written_lake(spark, sf)), SEASON)


def _overview_sql(where=""):
    return sql(
        "lake",
        "SELECT count(*) AS total_matches, CAST(coalesce(sum(total_runs), 0) AS BIGINT) AS total_runs, "
        "CAST(coalesce(sum(total_wickets), 0) AS BIGINT) AS total_wickets, "
        f"CAST(coalesce(sum(total_overs), 0) AS BIGINT) AS total_overs, count(DISTINCT season) AS season_count FROM lake {where}",
    )


@check("lh_overview", _overview_sql())
def lh_overview(spark, sf):
    return lakehouse.overview(lake(spark, sf), "all")


@check("lh_overview_season", _overview_sql(f"WHERE season = '{SEASON}'"))
def lh_overview_season(spark, sf):
    return lakehouse.overview(lake(spark, sf), SEASON)


TRENDS = (
    "SELECT season, count(*) AS match_count, CAST(sum(total_runs) AS BIGINT) AS total_runs, "
    "CAST(sum(total_wickets) AS BIGINT) AS total_wickets FROM lake GROUP BY 1"
)


@check("lh_season_trends", sql("lake", TRENDS))
def lh_season_trends(spark, sf):
    return lakehouse.season_trends(lake(spark, sf))


@check(
    "lh_team_wins",
    sql(
        "match",
        "SELECT winner AS team, count(*) AS wins FROM match WHERE winner IS NOT NULL AND winner <> '' "
        "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    ),
)
def lh_team_wins(spark, sf):
    return lakehouse.wins_by_team(adapters.matches(spark, sf))


@check(
    "lh_venue_stats",
    sql(
        "fact",
        f"SELECT venue, count(*) AS matches_hosted, {half_up('sum(total_runs)', 'count(*)', 1)} AS avg_match_runs "
        "FROM fact WHERE venue IS NOT NULL AND venue <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    ),
)
def lh_venue_stats(spark, sf):
    return lakehouse.venue_stats(lake(spark, sf))


@check("bench_q1", sql("match", "SELECT count(*) AS total_records FROM match"))
def bench_q1(spark, sf):
    return lakehouse.row_count(adapters.matches(spark, sf))


@check("bench_q2", sql("lake", TRENDS))
def bench_q2(spark, sf):
    return lakehouse.season_trends(lake(spark, sf))


@check(
    "bench_q3",
    sql("match", "SELECT winner AS team, count(*) AS wins FROM match WHERE winner IS NOT NULL AND winner <> '' GROUP BY 1"),
)
def bench_q3(spark, sf):
    return lakehouse.wins_by_team(adapters.matches(spark, sf), n=None)


@check(
    "bench_q4",
    sql("lake", f"SELECT match_id, match_date, team1, team2, total_runs FROM lake WHERE season = '{SEASON}'"),
)
def bench_q4(spark, sf):
    return lakehouse.season_matches(lake(spark, sf), SEASON)


CONSOLE = (
    "SELECT team1, count(*) AS matches, sum(CASE WHEN winner = team1 THEN 1 ELSE 0 END) AS home_wins "
    "FROM {} GROUP BY team1"
)


@check(
    "sql_console",
    sql("match", CONSOLE.format("match").replace("sum(", "CAST(sum(").replace("END)", "END) AS BIGINT)")),
)
def sql_console(spark, sf):
    return lakehouse.run_readonly(spark, CONSOLE.format("lake_matches"), {"lake_matches": adapters.matches(spark, sf)})
