"""Secret scans: candidates by pattern, told apart by how widely the corpus owns them.

Every candidate's value is hashed and counted over distinct repositories and owners of the whole
corpus. A value that ``COPIED_OWNERS`` owners or more hold is an example that people copy; one that
belongs to fewer looks live, unless it has too few different characters to be random. Base kinds are
assign, access and hex; added kinds are vendor tokens, signed web tokens and private-key headers.

The counts work on distinct (value, repository, owner) rows, combined before each shuffle, and join
back on the value: a value that a third of the documents share is one row on the small side, and the
adaptive skew join divides the other. Texts are searched once; only candidate rows are shuffled.

Cases: null and empty texts have no candidates; a null source is an owner of its own; an empty table
gives an empty result; repeated rows stay separate and count once as owner; very long texts, also such
with hundreds of thousands of matches, are searched whole in time in proportion to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.once import once
from ..session import written
from .common import key_text, whole
from .spans import found, listed, number, of_kinds

BASE = ("assign", "access", "hex")
ADDED = ("vendor", "web_token", "private_key")
ASSIGN = r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = {
    "assign": f"(?i){ASSIGN}",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "vendor": r"(?<![A-Za-z0-9])(?:gh[pousr]_[A-Za-z0-9]{36,}|sk_live_[A-Za-z0-9]{16,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35})",
    "web_token": r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    "private_key": r"-----BEGIN (?:(?!PRIVATE KEY-----)[A-Z]++\x20)*+PRIVATE KEY-----",
}
MIN_ASSIGNED = 6
COPIED_OWNERS = 3
#: Fewer different characters than this in a value, and it is no random credential.
MIN_DIFFERENT = 6


def _value(s: Column) -> Column:
    """The credential inside a match."""
    return F.when(s["kind"] == "assign", F.regexp_extract(s["match"], f"(?i)^{ASSIGN}", 1)).otherwise(s["match"])


def candidates(df: DataFrame, text: str, to: str = "spans_") -> DataFrame:
    """Append ``to``: array of (start, order, kind, end, value), by place and then by kind as listed."""
    keep = df.columns
    t = F.col(text)
    guards = {
        "assign": t.rlike("[:=]") & t.rlike("(?i)(?:password|passwd|secret|token|api_?key)"), "access": t.contains("AKIA"),
        "hex": t.rlike("[0-9a-f]{24}"), "vendor": t.rlike("_|xox|AIza"), "web_token": t.contains("eyJ"), "private_key": t.contains("PRIVATE KEY"),
    }
    df = found(df, text, {k: (guards[k], p) for k, p in PATTERNS.items()}, "proposed_")
    order = F.lit(len(PATTERNS))
    rank = lambda s: sum((F.when(s["kind"] == k, i).otherwise(0) for i, k in enumerate(PATTERNS)), order - order)
    valued = F.transform("proposed_", lambda s: F.struct(s["start"], rank(s).alias("rank"), s["kind"], s["end"], _value(s).alias("value")))
    df = once(df, valued_=valued)
    long_enough = F.filter("valued_", lambda s: (s["kind"] != "assign") | (F.length(s["value"]) >= MIN_ASSIGNED))
    return df.select(*keep, F.array_sort(long_enough).alias(to))


def ownership(values: DataFrame) -> DataFrame:
    """(digest, repo, owner) rows to n_repos and n_owners per digest."""
    once_each = values.groupBy("digest", "owner", "repo").count()
    owners = once_each.groupBy("digest", "owner").agg(F.count("*").alias("repos"))
    return owners.groupBy("digest").agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"))


def report(docs: DataFrame, doc_id="doc_id", text="text", owner="source", repo=("source", "lang")) -> DataFrame:
    """Counts, digest and spans of each document, with its live and its copied candidates.

    ``owner`` names the column of an owner, ``repo`` those that make up a repository.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), whole(text).alias("text_"), key_text(F.col(owner)).alias("owner"),
        F.concat_ws("|", *[key_text(F.col(c)) for c in repo]).alias("repo"),
    )
    found_ = candidates(rows, "text_").select("doc_id", "owner", "repo", "spans_").withColumn("row", F.monotonically_increasing_id())
    found_ = written(found_, "secrets")  # the row numbers hold from here on
    shown = F.col("spans_")
    told = found_.select(
        "row", "doc_id", *[number(shown, k).alias(f"n_{k}") for k in BASE],
        F.sha2(listed(of_kinds(shown, BASE)), 256).alias("base_sha256"), listed(shown).alias("spans"),
        *[number(shown, k).alias(f"n_{k}") for k in ADDED], (F.size(shown) > 0).alias("any"),
    )
    single = found_.select("row", "owner", "repo", F.explode("spans_").alias("s")).select(
        "row", "owner", "repo", F.sha2(F.col("s.value"), 256).alias("digest"),
        (F.size(F.array_distinct(F.split("s.value", ""))) >= MIN_DIFFERENT).alias("varied"),
    )
    owned = single.join(ownership(single), "digest")
    copied = F.col("n_owners") >= COPIED_OWNERS
    per_row = owned.groupBy("row").agg(
        F.sum((~copied & F.col("varied")).cast("long")).alias("n_live"), F.sum(copied.cast("long")).alias("n_copied"),
        F.max("n_owners").alias("most_owners"), F.max("n_repos").alias("most_repos"),
    )
    zero = [F.lit(0).cast("long").alias(c) for c in ("n_live", "n_copied", "most_owners", "most_repos")]
    hit = told.where("any").join(per_row, "row").drop("row", "any")
    return hit.unionByName(told.where("not any").select("*", *zero).drop("row", "any"))
