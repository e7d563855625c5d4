"""Reading, parsing, routing and staging of nested match documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.constants import TEAM_ALIASES
from matchlake.functions.once import once
from matchlake.functions.text import canonical_name, season_of
from matchlake.schemas import MATCH_DOC, STAGED
from matchlake.session import written

REQUIRED_KEYS = ["teams", "dates", "match_type", "venue"]

# What the text itself says about the keys of ``info``.
INSPECTED = """get(transform(array(try_parse_json(raw_data)), v -> named_struct({presence},
    'overs_type', schema_of_variant(try_variant_get(v, '$.info.overs', 'variant')))), 0)""".format(
    presence=", ".join(
        f"'has_{key}', try_variant_get(v, '$.info.{key}', 'variant') IS NOT NULL" for key in REQUIRED_KEYS
    )
)
# What is known without looking when every key in question holds a value of its type.
ALL_PRESENT = "named_struct({presence}, 'overs_type', 'DOUBLE')".format(
    presence=", ".join(f"'has_{key}', true" for key in REQUIRED_KEYS)
)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(match_id, raw_data, arrived) of a folder of JSON files, one document per file; ``arrived`` is
    the file's time."""
    files = spark.read.text(path, wholetext=True)
    name = F.regexp_extract("_metadata.file_name", r"^(.*?)(\.[^.]*)?$", 1)
    return files.select(
        F.url_decode(name).alias("match_id"), F.col("value").alias("raw_data"),
        F.col("_metadata.file_modification_time").alias("arrived"),
    )


def parse(df: DataFrame) -> DataFrame:
    """Add info, innings, the normalised season and ``shape``, the facts about key presence.

    A typed column cannot tell an absent key from a null or mistyped value. Only documents where
    one of the keys in question came out empty are looked at again, as a VARIANT; all others cost a
    single pass over their text.
    """
    keep = [c for c in df.columns if c not in ("season", "info", "innings", "shape")]
    doc = once(df.select(*keep), doc=F.from_json("raw_data", MATCH_DOC))
    holds_all = " AND ".join(f"doc.info.{key} IS NOT NULL" for key in [*REQUIRED_KEYS, "overs"])
    return doc.select(
        *keep,
        F.col("doc.info").alias("info"),
        F.col("doc.innings").alias("innings"),
        F.expr(f"IF({holds_all}, {ALL_PRESENT}, {INSPECTED})").alias("shape"),
        season_of(F.col("doc.info.season"), F.get("doc.info.dates", F.lit(0))).alias("season"),
    )


def readable(parsed: DataFrame) -> DataFrame:
    """Documents that parsed and resolve to a season; the others cannot be routed."""
    return parsed.where(F.col("season").isNotNull())


def team_condition(team: str, aliases: dict[str, str] | None = None) -> Column:
    wanted = canonical_name(F.lit(team), TEAM_ALIASES if aliases is None else aliases)
    return F.exists("info.teams", lambda t: canonical_name(t, aliases) == wanted)


def player_condition(player: str) -> Column:
    return F.exists(F.map_values("info.players"), lambda squad: F.array_contains(squad, player))


def route(
    parsed: DataFrame,
    seasons: list[str] | None = None,
    team: str | None = None,
    player: str | None = None,
) -> DataFrame:
    """Documents of the wanted seasons, on request only those of a team or a player."""
    chosen = readable(parsed)
    if seasons:
        chosen = chosen.where(F.col("season").isin([str(s) for s in seasons]))
    if team:
        chosen = chosen.where(team_condition(team))
    if player:
        chosen = chosen.where(player_condition(player))
    return chosen


def one_per_match(df: DataFrame, arrived: str = "arrived") -> DataFrame:
    """Drop further copies of a match; among differing copies the one that arrived last is kept.

    ``arrived`` orders the copies (file time, stream offset); copies that arrived together, or a table
    without that column, are settled by their text. Which ids repeat is found from the id column
    alone. Without any, nothing is moved; otherwise only the repeated documents are, and their copies
    are combined before the shuffle.
    """
    repeated = written(df.groupBy("match_id").count().where("count > 1").select("match_id"), "repeated-ids")
    if repeated.isEmpty():
        return df
    order = [c for c in (arrived, "raw_data") if c in df.columns]
    others = [c for c in df.columns if c not in ("match_id", *order)]
    kept = F.max(F.struct(*order, *others)).alias("kept")
    copies = df.join(repeated, "match_id", "left_semi").groupBy("match_id").agg(kept)
    single = df.join(repeated, "match_id", "left_anti")
    return single.select(*df.columns).unionByName(copies.select("match_id", "kept.*").select(*df.columns))


#: The season or first date that a text names first, in quotes or not: its year.
STATED_YEAR = r'"(?:season"\s*+:\s*+"?(?!null)|dates"\s*:\s*\[\s*")([^"/,}\-]+)'


def gathered(df: DataFrame) -> DataFrame:
    """The same rows, those of a season mostly together, large seasons split.

    Where a row goes is taken from a glance at its text, before it is parsed: its season as parsed may
    be another, which costs a further file and nothing else. Texts move, not what is read out of them.
    """
    year = F.regexp_extract("raw_data", STATED_YEAR, 1).alias("stated_year")
    return df.select(*df.columns, year).hint("rebalance", "stated_year").select(*df.columns)


def envelopes(routed: DataFrame) -> DataFrame:
    """(key, value): the keyed JSON message of each document."""
    message = F.to_json(F.struct("match_id", "season", "raw_data"))
    return routed.select(F.col("match_id").alias("key"), message.alias("value"))


def complete(envelope: DataFrame) -> DataFrame:
    """Messages that carry an id, a season and a document."""
    for name in ("match_id", "season", "raw_data"):
        envelope = envelope.where(F.col(name).isNotNull() & (F.col(name) != ""))
    return envelope


def stage(df: DataFrame, path: str) -> None:
    """Replace the staged seasons present in ``df``; the others stay. Re-running changes nothing."""
    (
        df.select("match_id", "season", "raw_data")
        .hint("rebalance", "season")
        .write.partitionBy("season")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .parquet(path)
    )


def read_staged(spark: SparkSession, path: str, seasons: list[str] | None = None) -> DataFrame:
    staged = spark.read.schema(STAGED).parquet(path)
    return staged.where(F.col("season").isin([str(s) for s in seasons])) if seasons else staged


def season_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("season").agg(F.count(F.lit(1)).alias("staged"))
