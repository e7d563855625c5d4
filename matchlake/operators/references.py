"""Audit of all foreign keys of the silver schema in one shuffle.

Every key that a child table names and every key that a parent table holds is a tagged row. Rows are
combined by (parent, key) before the shuffle, so a key that very many rows name (a team) is one row of
each task, and one aggregation answers all references at once: the key is dangling if no parent row
has it, and a count for each reference tells who names it.

Cases: a key with a NULL column refers to nothing and is no fault; keys that hold the separator of
others are told apart by their lengths; a parent table that is missing or empty leaves all its keys
dangling; extra columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (child, its columns, parent, the parent's columns) of the silver tables.
REFERENCES = [
    ("match", ["team1"], "team", ["team_name"]),
    ("match", ["team2"], "team", ["team_name"]),
    ("match", ["winner"], "team", ["team_name"]),
    ("match", ["player_of_match"], "player", ["player_name"]),
    ("team_squad", ["match_id"], "match", ["match_id"]),
    ("team_squad", ["team_name"], "team", ["team_name"]),
    ("team_squad", ["player_name"], "player", ["player_name"]),
    ("delivery", ["match_id"], "match", ["match_id"]),
    ("delivery", ["batting_team"], "team", ["team_name"]),
    ("delivery", ["batter"], "player", ["player_name"]),
    ("delivery", ["non_striker"], "player", ["player_name"]),
    ("delivery", ["bowler"], "player", ["player_name"]),
    ("delivery", ["match_id", "batter"], "team_squad", ["match_id", "player_name"]),
    ("wicket", ["delivery_id"], "delivery", ["delivery_id"]),
    ("wicket", ["player_out"], "player", ["player_name"]),
    ("wicket", ["fielder"], "player", ["player_name"]),
]


def _key(columns: list[str]) -> Column:
    """The columns as one text; NULL if one of them is."""
    texts = [F.col(c).cast("string") for c in columns]
    if len(texts) == 1:
        return texts[0]
    return F.concat(*[F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in texts])


def _shown(columns: list[str]) -> str:
    return "+".join(columns)


def audit(tables: dict[str, DataFrame], references: list[tuple] = REFERENCES) -> DataFrame:
    """(child, columns, parent, key, rows): each dangling key and how many rows of the child name it.

    References between tables that are not given are left out.
    """
    asked = [r for r in references if r[0] in tables and r[2] in tables]
    target = lambda parent, columns: F.lit(f"{parent}({_shown(columns)})").alias("target")
    row = lambda table, own, parent, columns, tag: tables[table].select(target(parent, columns), _key(own).alias("key"), F.lit(tag).alias("reference"))
    named = [row(child, own, parent, columns, i) for i, (child, own, parent, columns) in enumerate(asked)]
    held = [row(parent, list(columns), parent, list(columns), -1) for parent, columns in sorted({(r[2], tuple(r[3])) for r in asked})]
    rows = reduce(DataFrame.unionAll, named + held).where("key is not null")
    counts = [F.sum(F.when(F.col("reference") == i, 1).otherwise(0)).alias(f"n{i}") for i in range(len(asked))]
    met = rows.groupBy("target", "key").agg(F.max((F.col("reference") == -1).cast("int")).alias("held"), *counts)
    told = [
        F.struct(F.lit(r[0]).alias("child"), F.lit(_shown(r[1])).alias("columns"), F.lit(r[2]).alias("parent"), F.col(f"n{i}").cast("bigint").alias("rows"))
        for i, r in enumerate(asked)
    ]
    found = met.where("held = 0").select("key", F.inline(F.array(*told))).where("rows > 0")
    return found.select("child", "columns", "parent", "key", "rows")
