"""Views that give the generic test tables the shape of match data and process events.

orders + customer + nation -> matches, lineitem -> deliveries (one over per line, six balls) and
wickets, all three nested -> JSON documents, events -> process events. All arithmetic is on
integers, so the same rules can be stated in any SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.session import scratch, shuffles_dropped

LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]

# Declared, so that planning a query opens no file footers.
TABLE_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, in the column order of the silver match table, plus two helper keys."""
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer").selectExpr("c_custkey AS o_custkey", "c_nationkey")
    home = nation.selectExpr("n_nationkey AS c_nationkey", "n_name AS team1")
    away = nation.selectExpr("CAST(n_nationkey AS BIGINT) AS away_key", "n_name AS team2")
    orders = table(spark, sf_dir, "orders")
    joined = orders.join(customer, "o_custkey").join(home, "c_nationkey")
    joined = joined.selectExpr("*", "(c_nationkey + 1 + o_orderkey % 24) % 25 AS away_key").join(away, "away_key")
    winner = "CASE o_orderstatus WHEN 'F' THEN team1 WHEN 'O' THEN team2 END"
    return joined.selectExpr(
        "CAST(o_orderkey AS STRING) AS match_id",
        "CAST(NULL AS STRING) AS tournament",
        "CAST(NULL AS STRING) AS match_number",
        "CAST(year(o_orderdate) AS STRING) AS season",
        "CAST(o_orderdate AS DATE) AS match_date",
        "team1 AS city",
        "o_orderpriority AS venue",
        "'T20' AS match_type",
        "CAST(NULL AS STRING) AS gender",
        "20 AS scheduled_overs",
        "6 AS balls_per_over",
        "CAST(NULL AS STRING) AS team_type",
        "team1",
        "team2",
        "IF(o_orderkey % 2 = 0, team1, team2) AS toss_winner",
        "IF(o_orderkey % 3 = 0, 'bat', 'field') AS toss_decision",
        f"{winner} AS winner",
        "CAST(IF(o_orderstatus = 'F', 1 + o_orderkey % 90, NULL) AS INT) AS win_by_runs",
        "CAST(IF(o_orderstatus = 'O', 1 + o_orderkey % 10, NULL) AS INT) AS win_by_wickets",
        "IF(o_orderstatus = 'P', 'no result', NULL) AS result",
        "CAST(NULL AS STRING) AS result_method",
        "CAST(NULL AS STRING) AS eliminator",
        f"{winner} || '#1' AS player_of_match",
        "o_orderkey AS match_key",
        "o_custkey",
    )


def overs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem with its match's teams. Joined on the text key that every later
    aggregation groups by, so the join's partitioning is reused."""
    lines = table(spark, sf_dir, "lineitem").selectExpr("CAST(l_orderkey AS STRING) AS match_id", "*")
    teams = matches(spark, sf_dir).select("match_id", "season", "team1", "team2")
    return lines.join(teams, "match_id").selectExpr(
        "match_id",
        "season",
        "1 + l_linenumber % 2 AS innings_number",
        "IF(l_linenumber % 2 = 0, team1, team2) AS batting_team",
        "IF(l_linenumber % 2 = 0, team2, team1) AS bowling_team",
        "l_linenumber - 1 AS over_number",
        *LINE_COLUMNS,
    )


# What happens on ball {b} of a line.
BALL = {
    "batter": "batting_team || '#' || (1 + l_suppkey % 3)",
    "bowler": "bowling_team || '#' || (5 + l_partkey % 5)",
    "non_striker": "batting_team || '#4'",
    "batter_runs": "(CAST(l_quantity AS INT) + {b}) % 7",
    "extras": "IF((l_partkey + {b}) % 11 = 0, 1, 0)",
    "total_runs": "(CAST(l_quantity AS INT) + {b}) % 7 + IF((l_partkey + {b}) % 11 = 0, 1, 0)",
    "wides": "IF((l_partkey + {b}) % 11 = 0 AND l_suppkey % 2 = 0, 1, 0)",
    "noballs": "0",
    "byes": "0",
    "legbyes": "IF((l_partkey + {b}) % 11 = 0 AND l_suppkey % 2 <> 0, 1, 0)",
}
WICKET_BALL = "CAST(1 + l_partkey % 6 AS INT)"
DISMISSAL = (
    "CASE l_linenumber % 4 WHEN 0 THEN 'run out' WHEN 1 THEN 'bowled' WHEN 2 THEN 'caught' ELSE 'retired hurt' END"
)
FIELDER = "bowling_team || '#' || (1 + l_partkey % 4)"
DELIVERY_ID = "concat_ws('|', " + ", ".join(f"CAST({c} AS STRING)" for c in LINE_COLUMNS) + ", CAST(ball AS STRING))"


def _ball(name: str, b: str = "ball") -> str:
    return BALL[name].format(b=b)


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    balls = overs(spark, sf_dir).withColumn("ball", F.explode(F.expr("sequence(1, 6)")))
    return balls.selectExpr(
        f"{DELIVERY_ID} AS delivery_id",
        "match_id",
        "innings_number",
        "batting_team",
        "bowling_team",
        "over_number",
        "ball AS actual_delivery",
        *[f"{_ball(n)} AS {n}" for n in BALL],
        "season",
    )


def wickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wicket ball of a line is known before the balls are spelled out: no explode needed."""
    fallen = overs(spark, sf_dir).where("l_returnflag = 'R'").selectExpr("*", f"{WICKET_BALL} AS ball")
    return fallen.selectExpr(
        f"{DELIVERY_ID} || '|w1' AS wicket_id",
        f"{DELIVERY_ID} AS delivery_id",
        "match_id",
        "innings_number",
        "over_number",
        "ball AS actual_delivery",
        f"{_ball('batter')} AS batter",
        f"{_ball('bowler')} AS bowler",
        f"{_ball('batter')} AS player_out",
        f"{DISMISSAL} AS dismissal_kind",
        f"IF(l_linenumber % 2 = 0, {FIELDER}, NULL) AS fielder",
        "season",
    )


def ball_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every ball, for what needs neither team nor player: no join, and the aggregation
    above combines before its shuffle."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS match_id", "l_partkey", "l_quantity", "explode(sequence(1, 6)) AS ball"
    )
    return lines.selectExpr("match_id", f"{_ball('batter_runs')} AS batter_runs", f"{_ball('total_runs')} AS total_runs")


def wicket_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The match of every wicket, likewise without a join."""
    return table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").selectExpr(
        "CAST(l_orderkey AS STRING) AS match_id"
    )


def squads(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = matches(spark, sf_dir).selectExpr(
        "match_id", "season", "match_key", "explode(array(team1, team2)) AS team_name"
    )
    numbered = sides.selectExpr(
        "match_id", "season", "team_name", "explode(sequence(1, CAST(11 + match_key % 6 AS INT))) AS n"
    )
    return numbered.selectExpr("match_id", "season", "team_name", "team_name || '#' || n AS player_name")


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return squads(spark, sf_dir).select("player_name").distinct()


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(spark, sf_dir).selectExpr("explode(array(team1, team2)) AS team_name").distinct()


def _over_struct(defects: bool) -> str:
    """One over with its six deliveries, from the columns of a line.

    The fault code is read from the line's own match, so the faulty balls are built here and the
    collected overs need no rewriting.
    """
    b = "b"
    batter, total = _ball("batter_runs", b), _ball("total_runs", b)
    if defects:
        fault = "l_orderkey % 97"
        total = (
            f"CASE WHEN b = 1 AND {fault} = 5 THEN 8 + {_ball('extras', b)} "
            f"WHEN b = 1 AND {fault} = 6 THEN {total} + 1 ELSE {total} END"
        )
        batter = f"IF(b = 1 AND {fault} = 5, 8, {batter})"
    return f"""named_struct('over', over_number, 'deliveries', transform(sequence(1, 6), b -> named_struct(
        'batter', {_ball('batter', b)}, 'bowler', {_ball('bowler', b)}, 'non_striker', {_ball('non_striker', b)},
        'runs', named_struct('batter', {batter}, 'extras', {_ball('extras', b)}, 'total', {total}),
        'extras', IF({_ball('extras', b)} > 0, named_struct('wides', nullif({_ball('wides', b)}, 0),
                     'legbyes', nullif({_ball('legbyes', b)}, 0)), NULL),
        'wickets', IF(l_returnflag = 'R' AND b = {WICKET_BALL}, array(named_struct(
                      'player_out', {_ball('batter', b)}, 'kind', {DISMISSAL},
                      'fielders', IF(l_linenumber % 2 = 0, array(named_struct('name', {FIELDER})), NULL))), NULL))))"""


def documents(spark: SparkSession, sf_dir: str, defects: bool = False) -> DataFrame:
    """(match_id, season_hint, raw_data): every match as one nested JSON document.

    A document is one value by definition, so the overs of a match meet in one row here; nothing
    downstream groups them again. With ``defects``, keys modulo 97 get the faults listed in
    FIXTURES.md B4 plus two: 13 cuts the text short, 14 sets the overs to a JSON null.
    """
    line_order = ", ".join(LINE_COLUMNS)
    lines = overs(spark, sf_dir).selectExpr(
        "match_id",
        f"struct(innings_number, over_number, {line_order}, {_over_struct(defects)} AS body) AS line",
    )
    nested = lines.groupBy("match_id").agg(F.expr("sort_array(collect_list(line)) AS lines"))
    fault = "match_key % 97" if defects else "-1"
    base = matches(spark, sf_dir).join(nested, "match_id", "left").selectExpr(
        "*", f"{fault} AS fault", f"CAST(IF({fault} = 10, 10, 11 + match_key % 6) AS INT) AS squad_size"
    )

    def innings(number: int) -> str:
        bodies = f"transform(filter(coalesce(lines, array()), x -> x.innings_number = {number}), x -> x.body)"
        team = "IF(fault = 9, 'Nobody', team1)" if number == 1 else "team2"
        return (
            f"named_struct('team', {team}, 'powerplays', array(named_struct('from', 0.1D, 'to', 5.6D, 'type', 'mandatory')), "
            f"'overs', IF(fault = 12, flatten(array_repeat({bodies}, 10)), {bodies}))"
        )

    def squad(team: str) -> str:
        return f"transform(sequence(1, squad_size), n -> {team} || '#' || n)"

    overs_value = "CASE fault WHEN 4 THEN '\"twenty\"' WHEN 11 THEN '25' WHEN 14 THEN 'null' ELSE '20' END"
    info = f"""named_struct(
        'season', CASE match_key % 5 WHEN 0 THEN season || '/' || lpad(CAST(CAST(season AS INT) % 100 + 1 AS STRING), 2, '0')
                                     WHEN 1 THEN NULL ELSE season END,
        'dates', array(CAST(match_date AS STRING)),
        'teams', CASE fault WHEN 3 THEN array(team1, '') WHEN 7 THEN array(team1, team2, 'Third') ELSE array(team1, team2) END,
        'match_type', match_type,
        'venue', IF(fault = 2, NULL, venue),
        'city', city,
        'overs', '@overs@',
        'balls_per_over', balls_per_over,
        'toss', named_struct('winner', toss_winner, 'decision', toss_decision),
        'outcome', named_struct('winner', winner,
            'by', IF(winner IS NULL, NULL, named_struct('runs', win_by_runs, 'wickets', win_by_wickets)), 'result', result),
        'player_of_match', IF(player_of_match IS NULL, NULL, array(player_of_match)),
        'players', IF(fault = 8, NULL, map(team1, {squad('team1')}, team2, {squad('team2')})),
        'registry', named_struct('people', map(team1 || '#1', 'id-' || team1, team2 || '#1', 'id-' || team2)),
        'officials', map('umpires', array('U' || o_custkey % 40, 'U' || (o_custkey + 1) % 40),
                         'referee', array('R' || o_custkey % 9)))"""
    text = base.selectExpr(
        "match_id", "season AS season_hint", "fault",
        f"to_json(named_struct('info', {info}, 'innings', IF(fault = 1, NULL, array({innings(1)}, {innings(2)})))) AS raw_data",
    )
    # the overs value is put in as raw JSON, so that a number, a string and a null can all occur
    text = text.selectExpr(
        "match_id", "season_hint", f"replace(raw_data, '\"@overs@\"', {overs_value}) AS raw_data", "fault"
    )
    return text.selectExpr("match_id", "season_hint", "IF(fault = 13, left(raw_data, 40), raw_data) AS raw_data")


def stored_documents(spark: SparkSession, sf_dir: str, defects: bool = False) -> DataFrame:
    """``documents`` as a table: for who reads them more than once, since each reading builds them anew."""
    built, path = documents(spark, sf_dir, defects), scratch(spark, "documents")
    with shuffles_dropped(spark):
        built.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(built.schema).parquet(path)


def process_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").selectExpr("*", "CAST(get_json_object(props, '$.k') AS INT) AS k")
    staged = raw.selectExpr(
        "*",
        """CASE event_type WHEN 'click' THEN IF(k % 2 = 0, 'bronze', 'staging')
                           WHEN 'view' THEN IF(k % 2 = 0, 'validation', 'cdc')
                           WHEN 'signup' THEN IF(k % 2 = 0, 'silver', 'gold')
                           WHEN 'purchase' THEN IF(k % 2 = 0, 'lakehouse', 'serving')
                           WHEN 'error' THEN 'quarantine' END AS activity""",
        """CASE WHEN k % 10 = 0 THEN 'RUNNING' WHEN event_type <> 'error' THEN 'SUCCESS'
                WHEN k % 2 = 0 THEN 'QUARANTINED' ELSE 'FAILED' END AS status""",
    )
    return staged.selectExpr(
        "event_id",
        "'u' || user_id || '-w' || weekofyear(ts) AS case_id",
        "activity",
        "ts AS event_timestamp",
        "IF(status = 'RUNNING', NULL, ts + make_dt_interval(0, 0, 0, CAST(value AS DECIMAL(18,6)))) AS end_timestamp",
        "IF(k % 7 = 0, NULL, value) AS duration_seconds",
        "status",
        "IF(k % 11 = 0, NULL, k) AS records_processed",
        "IF(status = 'FAILED', 'E' || k, NULL) AS error_message",
        "'{\"season\":\"' || (2020 + k % 3) || '\"}' AS metadata",
    )
