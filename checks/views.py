"""The adapter views restated as SQL, as common table expressions."""

from __future__ import annotations

VIEWS = {
    "match": """
      SELECT CAST(o_orderkey AS VARCHAR) AS match_id, o_orderkey AS match_key, o_custkey,
             CAST(year(o_orderdate) AS VARCHAR) AS season, CAST(o_orderdate AS DATE) AS match_date,
             o_orderpriority AS venue, h.n_name AS city, 'T20' AS match_type, 20 AS scheduled_overs,
             6 AS balls_per_over, h.n_name AS team1, a.n_name AS team2,
             CASE WHEN o_orderkey % 2 = 0 THEN h.n_name ELSE a.n_name END AS toss_winner,
             CASE WHEN o_orderkey % 3 = 0 THEN 'bat' ELSE 'field' END AS toss_decision,
             CASE o_orderstatus WHEN 'F' THEN h.n_name WHEN 'O' THEN a.n_name END AS winner,
             CASE WHEN o_orderstatus = 'F' THEN 1 + o_orderkey % 90 END AS win_by_runs,
             CASE WHEN o_orderstatus = 'O' THEN 1 + o_orderkey % 10 END AS win_by_wickets,
             CASE WHEN o_orderstatus = 'P' THEN 'no result' END AS result,
             CASE o_orderstatus WHEN 'F' THEN h.n_name WHEN 'O' THEN a.n_name END || '#1' AS player_of_match
      FROM orders JOIN customer ON o_custkey = c_custkey
      JOIN nation h ON h.n_nationkey = c_nationkey
      JOIN nation a ON a.n_nationkey = (c_nationkey + 1 + o_orderkey % 24) % 25""",
    "over_row": """
      SELECT m.match_id, m.season, m.match_key, 1 + l_linenumber % 2 AS innings_number,
             CASE WHEN l_linenumber % 2 = 0 THEN team1 ELSE team2 END AS batting_team,
             CASE WHEN l_linenumber % 2 = 0 THEN team2 ELSE team1 END AS bowling_team,
             l_linenumber - 1 AS over_number, lineitem.*,
             concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
                       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS line_id
      FROM lineitem JOIN match m ON m.match_key = l_orderkey""",
    "delivery": """
      SELECT line_id || '|' || ball AS delivery_id, match_id, season, match_key, innings_number, batting_team,
             bowling_team, over_number, ball AS actual_delivery, l_partkey, l_suppkey,
             batting_team || '#' || (1 + l_suppkey % 3) AS batter,
             bowling_team || '#' || (5 + l_partkey % 5) AS bowler,
             batting_team || '#4' AS non_striker,
             (CAST(l_quantity AS INT) + ball) % 7 AS batter_runs,
             CASE WHEN (l_partkey + ball) % 11 = 0 THEN 1 ELSE 0 END AS extras,
             (CAST(l_quantity AS INT) + ball) % 7 + CASE WHEN (l_partkey + ball) % 11 = 0 THEN 1 ELSE 0 END AS total_runs,
             CASE WHEN (l_partkey + ball) % 11 = 0 AND l_suppkey % 2 = 0 THEN 1 ELSE 0 END AS wides,
             CASE WHEN (l_partkey + ball) % 11 = 0 AND l_suppkey % 2 <> 0 THEN 1 ELSE 0 END AS legbyes,
             l_returnflag, l_linenumber
      FROM over_row CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5, 6]) AS ball)""",
    "wicket": """
      SELECT delivery_id || '|w1' AS wicket_id, delivery_id, match_id, season, match_key, innings_number,
             over_number, actual_delivery, batter, bowler, batter AS player_out,
             CASE l_linenumber % 4 WHEN 0 THEN 'run out' WHEN 1 THEN 'bowled' WHEN 2 THEN 'caught'
                  ELSE 'retired hurt' END AS dismissal_kind,
             CASE WHEN l_linenumber % 2 = 0 THEN bowling_team || '#' || (1 + l_partkey % 4) END AS fielder
      FROM delivery WHERE l_returnflag = 'R' AND actual_delivery = 1 + l_partkey % 6""",
    "team": """
      SELECT team1 AS team_name FROM match UNION SELECT team2 FROM match""",
    "squad": """
      SELECT match_id, season, match_key, team_name, team_name || '#' || unnest(range(1, 12 + match_key % 6)) AS player_name
      FROM (SELECT *, team1 AS team_name FROM match UNION ALL SELECT *, team2 FROM match)""",
    "player": """
      SELECT DISTINCT player_name FROM squad""",
    "fact": """
      SELECT m.*, CAST(coalesce(r.runs, 0) AS BIGINT) AS total_runs, CAST(coalesce(w.n, 0) AS BIGINT) AS total_wickets,
             CAST(coalesce(r.fours, 0) AS BIGINT) AS total_boundaries, CAST(coalesce(r.sixes, 0) AS BIGINT) AS total_sixes
      FROM match m
      LEFT JOIN (SELECT match_id, sum(total_runs) AS runs, count(*) FILTER (batter_runs = 4) AS fours,
                        count(*) FILTER (batter_runs = 6) AS sixes FROM delivery GROUP BY 1) r USING (match_id)
      LEFT JOIN (SELECT match_id, count(*) AS n FROM wicket GROUP BY 1) w USING (match_id)""",
    "dim_team": """
      SELECT t.team_name, CAST(count(DISTINCT m.match_id) AS BIGINT) AS matches_played,
             CAST(count(DISTINCT CASE WHEN m.winner = t.team_name THEN m.match_id END) AS BIGINT) AS wins,
             CAST(any_value(coalesce(r.runs, 0)) AS BIGINT) AS total_runs,
             CAST(any_value(coalesce(r.fours, 0)) AS BIGINT) AS total_boundaries,
             CAST(any_value(coalesce(r.sixes, 0)) AS BIGINT) AS total_sixes
      FROM team t LEFT JOIN match m ON m.team1 = t.team_name OR m.team2 = t.team_name
      LEFT JOIN (SELECT batting_team, sum(total_runs) AS runs, count(*) FILTER (batter_runs = 4) AS fours,
                        count(*) FILTER (batter_runs = 6) AS sixes FROM delivery GROUP BY 1) r
        ON r.batting_team = t.team_name
      GROUP BY t.team_name""",
    "dim_player": """
      SELECT p.player_name,
             CAST(coalesce(bat.matches, 0) AS BIGINT) AS batting_matches, CAST(coalesce(bat.innings, 0) AS BIGINT) AS batting_innings,
             CAST(coalesce(bat.runs, 0) AS BIGINT) AS total_runs, CAST(coalesce(bat.balls, 0) AS BIGINT) AS total_balls,
             CAST(coalesce(bat.fours, 0) AS BIGINT) AS total_fours, CAST(coalesce(bat.sixes, 0) AS BIGINT) AS total_sixes,
             CAST(coalesce(bat.best, 0) AS BIGINT) AS highest_score, CAST(coalesce(bat.fifties, 0) AS BIGINT) AS fifties,
             CAST(coalesce(bat.hundreds, 0) AS BIGINT) AS hundreds,
             CAST(coalesce(bowl.matches, 0) AS BIGINT) AS bowling_matches, CAST(coalesce(bowl.innings, 0) AS BIGINT) AS bowling_innings,
             CAST(coalesce(bowl.balls, 0) AS BIGINT) AS balls_bowled,
             coalesce(((20 * bowl.balls + 6) // 12) / 10.0, 0.0) AS overs_bowled,
             CAST(coalesce(bowl.conceded, 0) AS BIGINT) AS runs_conceded, CAST(coalesce(bowl.taken, 0) AS BIGINT) AS wickets_taken,
             CAST(coalesce(bowl.best, 0) AS BIGINT) AS best_wickets
      FROM player p
      LEFT JOIN (SELECT player_name, count(DISTINCT match_id) AS matches, count(DISTINCT (match_id, innings_number)) AS innings,
                        sum(runs) AS runs, sum(balls) AS balls, sum(fours) AS fours, sum(sixes) AS sixes, max(runs) AS best,
                        count(*) FILTER (runs >= 50 AND runs < 100) AS fifties, count(*) FILTER (runs >= 100) AS hundreds
                 FROM (SELECT match_id, innings_number, batter AS player_name, sum(batter_runs) AS runs, count(*) AS balls,
                              count(*) FILTER (batter_runs = 4) AS fours, count(*) FILTER (batter_runs = 6) AS sixes
                       FROM delivery GROUP BY 1, 2, 3) GROUP BY 1) bat USING (player_name)
      LEFT JOIN (SELECT bowler AS player_name, count(DISTINCT match_id) AS matches,
                        count(DISTINCT (match_id, innings_number)) AS innings, sum(balls) AS balls,
                        sum(conceded) AS conceded, sum(taken) AS taken, max(taken) AS best
                 FROM (SELECT d.match_id, d.innings_number, d.bowler, count(*) AS balls, sum(total_runs) AS conceded,
                              any_value(coalesce(w.n, 0)) AS taken
                       FROM delivery d LEFT JOIN (SELECT match_id, innings_number, bowler, count(*) AS n FROM wicket
                                                  GROUP BY 1, 2, 3) w
                         ON w.match_id = d.match_id AND w.innings_number = d.innings_number AND w.bowler = d.bowler
                       GROUP BY 1, 2, 3) GROUP BY 1) bowl USING (player_name)
      WHERE bat.player_name IS NOT NULL OR bowl.player_name IS NOT NULL""",
    "lake": """
      SELECT m.match_id, m.season, strftime(m.match_date, '%Y-%m-%d') AS match_date, m.match_type, m.venue, m.city,
             m.team1, m.team2, m.toss_winner, m.toss_decision, m.winner, m.win_by_runs, m.win_by_wickets,
             m.player_of_match, CAST(coalesce(o.n, 0) AS INT) AS total_overs, CAST(f.total_runs AS INT) AS total_runs, CAST(f.total_wickets AS INT) AS total_wickets
      FROM match m JOIN fact f USING (match_id)
      LEFT JOIN (SELECT match_id, count(*) AS n FROM over_row GROUP BY 1) o USING (match_id)""",
    "ev": """
      SELECT event_id, 'u' || user_id || '-w' || weekofyear(ts) AS case_id,
             CASE event_type WHEN 'click' THEN CASE WHEN k % 2 = 0 THEN 'bronze' ELSE 'staging' END
                  WHEN 'view' THEN CASE WHEN k % 2 = 0 THEN 'validation' ELSE 'cdc' END
                  WHEN 'signup' THEN CASE WHEN k % 2 = 0 THEN 'silver' ELSE 'gold' END
                  WHEN 'purchase' THEN CASE WHEN k % 2 = 0 THEN 'lakehouse' ELSE 'serving' END
                  WHEN 'error' THEN 'quarantine' END AS activity,
             ts AS event_timestamp,
             CASE WHEN k % 10 <> 0 THEN ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) END AS end_timestamp,
             CASE WHEN k % 7 <> 0 THEN value END AS duration_seconds,
             CASE WHEN k % 10 = 0 THEN 'RUNNING'
                  WHEN event_type = 'error' THEN CASE WHEN k % 2 = 0 THEN 'QUARANTINED' ELSE 'FAILED' END
                  ELSE 'SUCCESS' END AS status,
             CASE WHEN k % 11 <> 0 THEN k END AS records_processed,
             CASE WHEN k % 10 <> 0 AND event_type = 'error' AND k % 2 <> 0 THEN 'E' || k END AS error_message,
             CAST(2020 + k % 3 AS VARCHAR) AS event_season,
             CASE WHEN k % 7 <> 0 THEN CAST(round(value * 1000) AS BIGINT) END AS dur_ms,
             CASE WHEN k % 10 <> 0 THEN CAST(round(value * 1000) AS BIGINT) END AS elapsed_ms,
             CAST(epoch_us(ts) AS BIGINT) AS start_us,
             CASE WHEN k % 10 <> 0 THEN epoch_us(ts) + CAST(round(value * 1000000) AS BIGINT) END AS end_us
      FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)""",
}

NEEDS = {
    "over_row": ["match"],
    "delivery": ["over_row"],
    "wicket": ["delivery"],
    "team": ["match"],
    "squad": ["match"],
    "player": ["squad"],
    "fact": ["match", "delivery", "wicket"],
    "dim_team": ["team", "match", "delivery"],
    "dim_player": ["player", "delivery", "wicket"],
    "lake": ["match", "fact", "over_row"],
}


def sql(views: str, body: str, extra: str = "") -> str:
    """``WITH <the views and what they need>, <extra> body``."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in wanted:
            wanted.append(name)

    for name in views.split():
        add(name)
    ctes = [f"{n} AS ({VIEWS[n]})" for n in wanted]
    if extra:
        ctes.append(extra)
    return (f"WITH {', '.join(ctes)} " if ctes else "") + body


def half_up(numerator: str, denominator: str, places: int) -> str:
    """Exact half-up rounding of a quotient of whole, non-negative numbers."""
    unit = 10**places
    return (
        f"(((2 * CAST({numerator} AS HUGEINT) * {unit} + ({denominator})) // (2 * ({denominator}))) / {float(unit)})"
    )
