"""Declared schemas of documents, events and tables (no inference anywhere)."""

INFO = """struct<
  season:string, dates:array<string>, teams:array<string>, match_type:string, venue:string, city:string,
  gender:string, team_type:string, overs:double, balls_per_over:int,
  event:struct<name:string, match_number:string>,
  toss:struct<winner:string, decision:string>,
  outcome:struct<winner:string, `by`:struct<runs:int, wickets:int>, result:string, method:string, eliminator:string>,
  player_of_match:array<string>,
  players:map<string, array<string>>,
  registry:struct<people:map<string, string>>,
  officials:map<string, array<string>>>"""

INNINGS = """array<struct<
  team:string,
  target:struct<runs:int, overs:double>,
  powerplays:array<struct<`from`:double, `to`:double, type:string>>,
  overs:array<struct<
    over:int,
    deliveries:array<struct<
      batter:string, bowler:string, non_striker:string,
      runs:struct<batter:int, extras:int, total:int>,
      extras:struct<wides:int, noballs:int, byes:int, legbyes:int>,
      wickets:array<struct<player_out:string, kind:string, fielders:array<struct<name:string>>>>>>>>>>"""

MATCH_DOC = " ".join(f"info {INFO}, innings {INNINGS}".split())

STAGED = "match_id string, season string, raw_data string"

ENVELOPE = "match_id string, season string, raw_data string"

PROCESS_EVENT = """
event_id bigint, case_id string, activity string, event_timestamp timestamp, end_timestamp timestamp,
duration_seconds double, status string, records_processed int, error_message string, metadata string
"""

MATCH_COLUMNS = [
    "match_id", "tournament", "match_number", "season", "match_date", "city", "venue", "match_type",
    "gender", "scheduled_overs", "balls_per_over", "team_type", "team1", "team2", "toss_winner",
    "toss_decision", "winner", "win_by_runs", "win_by_wickets", "result", "result_method",
    "eliminator", "player_of_match",
]

FACT_MEASURES = ["total_runs", "total_wickets", "total_boundaries", "total_sixes"]

PLAYER_MEASURES = [
    "batting_matches", "batting_innings", "total_runs", "total_balls", "total_fours", "total_sixes",
    "highest_score", "fifties", "hundreds", "bowling_matches", "bowling_innings", "balls_bowled",
    "overs_bowled", "runs_conceded", "wickets_taken", "best_wickets",
]

# Columns of the season-partitioned lakehouse table, in order.
LAKEHOUSE = """
match_id string, season string, match_date string, match_type string, venue string, city string,
team1 string, team2 string, toss_winner string, toss_decision string, winner string,
win_by_runs int, win_by_wickets int, player_of_match string, total_overs int, total_runs int,
total_wickets int, raw_payload string, ingested_at timestamp
"""
LAKEHOUSE_COLUMNS = [c.split()[0] for c in LAKEHOUSE.replace("\n", " ").strip().split(", ")]
