"""How five filters interact: what each removes in every order, and its fair share of the removals.

A document fails a set of the filters A to E. A coalition of filters removes the documents that fail
at least one of its members; that count is the worth v(S) of the coalition in the removal game. The
Hart-Mas-Colell potential is P(none) = 0 and P(S) = (v(S) + sum of P(S without i) over i in S) / |S|;
a filter's Shapley value is P(all) - P(all without it). P has denominators that divide 60 (the least
common multiple of 1 to 5), so 60 P is kept as an exact whole number, and 120 Shapley values, the
removals summed over all 120 orders, are twice a difference of it. A step of an order is a difference
between two coalitions, so 32 counts of each part answer all 600 steps.

Texts are read once; what is kept of a row is its id, part, failures and digest. Whether an equal
text has a smaller id is decided by the least id of each digest, combined before its shuffle, that
meets the rows on (id, digest): no key of the join is hotter than a repeated row, whatever the size
of a group of copies. Rows that repeat are split by the adaptive skew join. Everything after that are
counts by (part, failures, labels).

Cases: a null text is empty and fails A only (and E, if a smaller id is empty too); a null or empty
source is the part named ""; a null id is smaller than none and none is smaller than it, so it neither fails E nor
makes others fail, and has no labels; repeated rows with one id do not fail E by each other; of labels
that repeat, one that says 1 counts; very long texts are read whole; an empty table has no parts.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.once import once
from ..session import written
from .common import BLANK_RUN, stripped, whole

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 50, 65, 5
SYMBOLS = "[#$%&*|]"
COALITIONS = range(1 << len(FILTERS))
#: What the potential is multiplied by to be whole, and the number of orders of the filters.
WHOLE, ORDERS = 60, 120


def bit(name: str) -> int:
    return 1 << FILTERS.index(name)


def failures(docs: DataFrame, doc_id="doc_id", text="text", source="source") -> DataFrame:
    """(doc_id, part, failed, digest): ``failed`` has a bit for each of the filters A to D."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("part"), whole(text).alias("t"))
    inner = stripped(F.col("t"))
    rows = once(rows, w=F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, BLANK_RUN)))
    n, capitals = F.size("w"), F.length(F.regexp_replace("t", "[^A-Z]+", ""))
    fails = {
        "A": n < MIN_WORDS, "B": F.size(F.array_distinct("w")) * 100 < n * MIN_DISTINCT,
        "C": capitals * 100 > F.length("t") * MAX_CAPITALS, "D": F.col("t").rlike(SYMBOLS),
    }
    failed = sum((F.when(f, F.lit(bit(k))).otherwise(F.lit(0)) for k, f in fails.items()), F.lit(0))
    return rows.select("doc_id", "part", failed.alias("failed"), F.unhex(F.sha2("t", 256)).alias("digest"))


def marked(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, good, toxic) of each row; ``failed`` has the bit of E too."""
    named = rows.where("doc_id is not null")
    firsts = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    said = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = named.join(said, "doc_id", "left").join(firsts, ["doc_id", "digest"], "left")
    copy = F.when(F.col("first").isNull(), F.lit(bit("E"))).otherwise(F.lit(0))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    known = known.select("part", F.col("failed").bitwiseOR(copy).alias("failed"), zero("good"), zero("toxic"))
    unnamed = rows.where("doc_id is null").select("part", "failed", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return known.unionByName(unnamed)


def worths(rows: DataFrame) -> DataFrame:
    """A part's size and, by coalition, what it removes: all documents, good ones and toxic ones."""
    counts = rows.groupBy("part", "failed", "good", "toxic").agg(F.count("*").alias("n"))
    every = F.sequence(F.lit(0), F.lit(max(COALITIONS)))
    hit = F.col("failed").bitwiseAND(F.col("coalition")) != 0
    total = lambda kind, name: F.sum(F.when(kind, F.col("n")).otherwise(F.lit(0).cast("long"))).alias(name)
    by = counts.select("*", F.explode(every).alias("coalition")).groupBy("part", "coalition").agg(
        F.sum("n").alias("size"), total(hit, "removes"), total(hit & (F.col("good") == 1), "good"), total(hit & (F.col("toxic") == 1), "toxic"))
    listed = by.groupBy("part").agg(
        F.max("size").alias("size"), F.array_sort(F.collect_list(F.struct("coalition", "removes", "good", "toxic"))).alias("worth"))
    return listed.select("part", "size", *[F.col(f"worth.{c}").alias(to) for c, to in (("removes", "removes"), ("good", "removes_good"), ("toxic", "removes_toxic"))])


def potentials(v: Column) -> Column:
    """60 P(S) of the 32 coalitions, from the array of their worths; coalitions are bit sets, so all
    parts of a set come before it."""
    size = lambda s: F.bit_count(s)

    def grow(known: Column, s: Column) -> Column:
        inside = sum((F.when(s.bitwiseAND(F.lit(bit(k))) != 0, F.get(known, s.bitwiseXOR(F.lit(bit(k))))).otherwise(F.lit(0)) for k in FILTERS), F.lit(0).cast("long"))
        return F.concat(known, F.array(((F.get(v, s) * WHOLE + inside) / size(s)).cast("long")))  # divides evenly

    return F.aggregate(F.sequence(F.lit(1), F.lit(max(COALITIONS))), F.array(F.lit(0).cast("long")), grow)


def _coalition(prefix: Column) -> Column:
    return sum((F.when(prefix.contains(k), F.lit(bit(k))).otherwise(F.lit(0)) for k in FILTERS), F.lit(0))


def steps(parts: DataFrame) -> DataFrame:
    """The steps of all orders, from a part's worths."""
    orders = ",".join("".join(p) for p in permutations(FILTERS))
    df = once(parts, p=potentials(F.col("removes")))
    df = df.select("*", F.explode(F.split(F.lit(orders), ",")).alias("filter_order"))
    df = df.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    order, at, everything = F.col("filter_order"), F.col("step"), F.lit(max(COALITIONS))
    own = _coalition(F.substring(order, at, F.lit(1)))
    df = df.select("*", own.alias("own"), _coalition(F.substring(order, F.lit(1), at)).alias("after"))
    df = df.withColumn("before", F.col("after") - F.col("own"))
    gain = lambda v: F.get(F.col(v), F.col("after")) - F.get(F.col(v), F.col("before"))
    without = everything - F.col("own")
    return df.select(
        "part", "filter_order", "step", (F.col("size") - F.get("removes", "after")).alias("kept"), gain("removes").alias("removed"),
        (F.get("removes", "own") - gain("removes")).alias("redundant"), (F.get("removes", everything) - F.get("removes", without)).alias("unique_fails"),
        gain("removes_good").alias("good_lost"), gain("removes_toxic").alias("toxic_lost"),
        ((F.get("p", everything) - F.get("p", without)) * (ORDERS // WHOLE)).alias("shapley"),
    )


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """600 rows for each source: every step of every order of the filters."""
    rows = written(failures(docs), "audit")
    return steps(worths(marked(rows, labels)))
