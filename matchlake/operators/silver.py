"""Parsed documents to thirteen relational tables. Every table is a projection or an explode of the
document it comes from: only the three entity lists (team, player, official) need a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.constants import DEFAULT_BALLS_PER_OVER, DEFAULT_OVERS
from matchlake.functions.text import canonical_name
from matchlake.schemas import MATCH_COLUMNS

ENTITY_TABLES = ["team", "player", "official"]
MATCH_TABLES = [
    "match", "toss", "player_of_match", "match_official", "team_squad", "innings", "powerplay", "delivery",
    "wicket", "wicket_fielder",
]

KEYS = ["match_id", "season"]


def match(docs: DataFrame) -> DataFrame:
    side = lambda n: canonical_name(F.get("info.teams", F.lit(n)))
    return docs.select(
        "match_id",
        F.col("info.event.name").alias("tournament"),
        F.col("info.event.match_number").alias("match_number"),
        "season",
        F.col("info.season").alias("season_raw"),
        F.get("info.dates", F.lit(0)).try_cast("date").alias("match_date"),
        F.col("info.city").alias("city"),
        F.col("info.venue").alias("venue"),
        F.col("info.match_type").alias("match_type"),
        F.col("info.gender").alias("gender"),
        F.coalesce("info.overs", F.lit(DEFAULT_OVERS)).cast("int").alias("scheduled_overs"),
        F.coalesce("info.balls_per_over", F.lit(DEFAULT_BALLS_PER_OVER)).alias("balls_per_over"),
        F.col("info.team_type").alias("team_type"),
        side(0).alias("team1"),
        side(1).alias("team2"),
        canonical_name(F.col("info.toss.winner")).alias("toss_winner"),
        F.col("info.toss.decision").alias("toss_decision"),
        canonical_name(F.col("info.outcome.winner")).alias("winner"),
        F.col("info.outcome.by.runs").alias("win_by_runs"),
        F.col("info.outcome.by.wickets").alias("win_by_wickets"),
        F.col("info.outcome.result").alias("result"),
        F.col("info.outcome.method").alias("result_method"),
        F.col("info.outcome.eliminator").alias("eliminator"),
        F.get("info.player_of_match", F.lit(0)).alias("player_of_match"),
    ).select(*MATCH_COLUMNS, "season_raw")


def team(docs: DataFrame) -> DataFrame:
    names = docs.select(F.explode("info.teams").alias("name"))
    return names.select(canonical_name(F.col("name")).alias("team_name")).distinct()


def player(docs: DataFrame) -> DataFrame:
    """Everyone in a registry or a squad, with the identifier of the latest match that states one."""
    order = F.struct(F.get("info.dates", F.lit(0)).alias("d"), F.col("match_id").alias("m"))
    registered = docs.select(order.alias("at"), F.explode("info.registry.people").alias("player_name", "registry_id"))
    in_squads = docs.select(F.explode(F.flatten(F.map_values("info.players"))).alias("player_name"))
    listed = registered.unionByName(in_squads, allowMissingColumns=True)
    latest = F.max(F.when(F.col("registry_id").isNotNull(), F.struct("at", "registry_id"))).alias("latest")
    return listed.groupBy("player_name").agg(latest).select("player_name", "latest.registry_id")


def match_official(docs: DataFrame) -> DataFrame:
    roles = docs.select(*KEYS, F.explode("info.officials").alias("official_role", "names"))
    return roles.select(*KEYS, F.explode("names").alias("official_name"), "official_role")


def official(docs: DataFrame) -> DataFrame:
    return match_official(docs).select("official_name", "official_role").distinct()


def toss(docs: DataFrame) -> DataFrame:
    stated = F.col("info.toss.winner").isNotNull() | F.col("info.toss.decision").isNotNull()
    return docs.where(stated).select(
        *KEYS,
        canonical_name(F.col("info.toss.winner")).alias("toss_winner"),
        F.col("info.toss.decision").alias("toss_decision"),
    )


def player_of_match(docs: DataFrame) -> DataFrame:
    return docs.select(*KEYS, F.explode("info.player_of_match").alias("player_name"))


def team_squad(docs: DataFrame) -> DataFrame:
    squads = docs.select(*KEYS, F.explode("info.players").alias("team", "squad"))
    return squads.select(*KEYS, canonical_name(F.col("team")).alias("team_name"), F.explode("squad").alias("player_name"))


def _innings(docs: DataFrame) -> DataFrame:
    numbered = docs.select(*KEYS, F.posexplode("innings").alias("n", "one"))
    return numbered.select(
        *KEYS,
        (F.col("n") + 1).alias("innings_number"),
        canonical_name(F.col("one.team")).alias("batting_team"),
        "one",
    )


INNINGS_KEYS = [*KEYS, "innings_number", "batting_team"]


def innings(docs: DataFrame) -> DataFrame:
    return _innings(docs).select(
        *INNINGS_KEYS,
        F.col("one.target.runs").alias("target_runs"),
        F.col("one.target.overs").cast("decimal(10,1)").alias("target_overs"),
    )


def powerplay(docs: DataFrame) -> DataFrame:
    spans = _innings(docs).select(*INNINGS_KEYS, F.explode("one.powerplays").alias("p"))
    return spans.select(
        *INNINGS_KEYS,
        F.col("p.from").cast("decimal(10,1)").alias("from_delivery"),
        F.col("p.to").cast("decimal(10,1)").alias("to_delivery"),
        F.col("p.type").alias("powerplay_type"),
    )


def balls(docs: DataFrame) -> DataFrame:
    """One row per ball with its still nested contents ``b``.

    The identifier is the ball's place in its document, so it is the same in every run.
    """
    in_overs = _innings(docs).select(*INNINGS_KEYS, F.posexplode("one.overs").alias("place", "o"))
    in_balls = in_overs.select(
        *INNINGS_KEYS, "place", F.col("o.over").alias("over_number"), F.posexplode("o.deliveries").alias("n", "b")
    )
    ball = F.col("n") + 1
    return in_balls.select(
        F.concat_ws(":", "match_id", "innings_number", "place", ball.cast("string")).alias("delivery_id"),
        *INNINGS_KEYS,
        "over_number",
        ball.alias("actual_delivery"),
        "b",
    )


def delivery(docs: DataFrame) -> DataFrame:
    count = lambda path, name: F.coalesce(F.col(path), F.lit(0)).alias(name)
    return balls(docs).select(
        "delivery_id",
        *INNINGS_KEYS,
        "over_number",
        "actual_delivery",
        "b.batter",
        "b.bowler",
        "b.non_striker",
        count("b.runs.batter", "batter_runs"),
        count("b.runs.extras", "extras"),
        count("b.runs.total", "total_runs"),
        *[count(f"b.extras.{kind}", kind) for kind in ("wides", "noballs", "byes", "legbyes")],
    )


def _wickets(docs: DataFrame) -> DataFrame:
    fallen = balls(docs).select("*", F.posexplode("b.wickets").alias("n", "w"))
    return fallen.withColumn("wicket_id", F.concat_ws(":w", "delivery_id", (F.col("n") + 1).cast("string")))


def wicket(docs: DataFrame) -> DataFrame:
    return _wickets(docs).select(
        "wicket_id",
        "delivery_id",
        *KEYS,
        "innings_number",
        "over_number",
        "actual_delivery",
        "b.batter",
        "b.bowler",
        "w.player_out",
        F.col("w.kind").alias("dismissal_kind"),
    )


def wicket_fielder(docs: DataFrame) -> DataFrame:
    return _wickets(docs).select(
        "wicket_id", "delivery_id", *KEYS, F.explode("w.fielders.name").alias("player_name")
    )


TABLES = {
    "match": match,
    "team": team,
    "player": player,
    "official": official,
    "toss": toss,
    "player_of_match": player_of_match,
    "match_official": match_official,
    "team_squad": team_squad,
    "innings": innings,
    "powerplay": powerplay,
    "delivery": delivery,
    "wicket": wicket,
    "wicket_fielder": wicket_fielder,
}


def flatten(docs: DataFrame) -> dict[str, DataFrame]:
    """All tables. Read ``docs`` from a table of parsed documents: each output then scans only the
    nested columns it needs, and no document is parsed twice."""
    return {name: build(docs) for name, build in TABLES.items()}


def flat_record(docs: DataFrame) -> DataFrame:
    """One lakehouse row per document; totals are folded inside the row, without explode or shuffle."""
    with_overs = docs.select(
        "*",
        F.expr("flatten(transform(coalesce(innings, array()), i -> coalesce(i.overs, array())))").alias("over_list"),
    )
    rows = with_overs.withColumn(
        "ball_list", F.expr("flatten(transform(over_list, o -> coalesce(o.deliveries, array())))")
    )
    side = lambda n: canonical_name(F.get("info.teams", F.lit(n)))
    return rows.select(
        "match_id",
        "season",
        F.get("info.dates", F.lit(0)).alias("match_date"),
        F.coalesce("info.match_type", F.lit("T20")).alias("match_type"),
        F.coalesce("info.venue", F.lit("")).alias("venue"),
        F.coalesce("info.city", F.lit("")).alias("city"),
        side(0).alias("team1"),
        side(1).alias("team2"),
        canonical_name(F.col("info.toss.winner")).alias("toss_winner"),
        F.col("info.toss.decision").alias("toss_decision"),
        canonical_name(F.col("info.outcome.winner")).alias("winner"),
        F.col("info.outcome.by.runs").alias("win_by_runs"),
        F.col("info.outcome.by.wickets").alias("win_by_wickets"),
        F.get("info.player_of_match", F.lit(0)).alias("player_of_match"),
        F.size("over_list").alias("total_overs"),
        F.expr("aggregate(ball_list, 0, (sum, b) -> sum + coalesce(b.runs.total, 0))").alias("total_runs"),
        F.expr("aggregate(ball_list, 0, (sum, b) -> sum + coalesce(cardinality(b.wickets), 0))").alias("total_wickets"),
        F.col("raw_data").alias("raw_payload"),
        F.current_timestamp().alias("ingested_at"),
    )
