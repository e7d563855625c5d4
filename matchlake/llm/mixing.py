"""Mixing sources to target weights.

Targets come from capped water-filling: every source gets its weight's share of the budget, a source
whose share is more than ``max_epochs`` times its size stops there, and what it leaves is shared
among the others by weight until nobody is above its cap. With the sources in order of cap by weight
this has a closed form: a source is capped when even an equal share of what is left exceeds its cap.

A source that needs 1.4 epochs takes every document once, and 40 % of its words once more. Which
documents come again follows the order of a seeded digest. That order is never sorted whole: sizes
are summed per source and digest prefix, which tells the one prefix in which the border falls, and
only its documents (one in 4096 of the source) are ranked. The document on the border takes a part of
its words, so that a source's total is its target, rounded to a word.

Cases: a null text has size 0; a null source is a source of its own, placed last; repeated rows count
each for itself; sources without words, an empty table and texts without words have target and taken
0. Equal digests are ordered by size; rows that tie in both are alike in all that decides here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .common import key_text, packed, whole, word_count

#: Weights are given to the sources in order, again and again.
WEIGHTS = (3, 1, 2)
BUDGET = (3, 2)  # 150 % of all words, as a quotient of whole numbers
MAX_EPOCHS = 2
SEED = 42
#: Hexadecimal digits of a digest's prefix: 4096 prefixes per source.
PREFIX = 3
WHOLE = "decimal(38,0)"


def targets(sizes: DataFrame, weights=WEIGHTS, budget=BUDGET, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sizes`` (source, source_size), one row per source, with the exact target ``num / den``.

    The ordered sums run over one narrow row per source, not over documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    weighted = sizes.select(
        "source", "source_size",
        F.element_at(F.array(*[F.lit(w) for w in weights]), place + 1).cast(WHOLE).alias("weight"),
        (F.col("source_size") * max_epochs).cast(WHOLE).alias("cap"),
    )
    # cap / weight, compared by a quotient that is equal for equal fractions; the source settles ties
    rising = Window.orderBy(F.col("cap").cast("double") / F.col("weight").cast("double"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    filled = weighted.select(
        "*",
        (F.sum("source_size").over(every) * budget[0]).cast(WHOLE).alias("budget"),  # times budget[1]
        F.coalesce(F.sum("cap").over(before), F.lit(0)).cast(WHOLE).alias("capped_before"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))).cast(WHOLE).alias("weight_left"),
    ).withColumn(
        "is_capped",
        (F.col("cap") * F.col("weight_left") * budget[1] <= F.col("weight") * (F.col("budget") - F.col("capped_before") * budget[1])),
    )
    left = filled.select(
        "source", "source_size", "weight", "cap", "is_capped", "budget",
        F.sum(F.when(F.col("is_capped"), F.col("cap")).otherwise(0)).over(every).alias("capped"),
        F.sum(F.when(F.col("is_capped"), F.lit(0)).otherwise(F.col("weight"))).over(every).alias("free"),
    )
    top = F.when(F.col("is_capped"), F.col("cap")).otherwise(
        F.col("weight") * (F.col("budget") - F.col("capped") * budget[1])
    )
    under = F.when(F.col("is_capped"), F.lit(1)).otherwise(F.col("free") * budget[1])
    target = F.coalesce(top.cast("double") / F.nullif(under.cast("double"), F.lit(0.0)), F.lit(0.0))
    return left.select("source", "source_size", "weight", target.alias("target"), F.round(target).cast("long").alias("words"))


def digest(doc_id: Column, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(f":{seed}")).cast("binary"))


def taken(narrow: DataFrame, weights=WEIGHTS, budget=BUDGET, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``narrow`` (source, size, digest and more) with source_size, target and the words taken."""
    spread = narrow.withColumn("source_key", key_text(F.col("source"))).withColumn("prefix", F.substring("digest", 1, PREFIX))
    by_prefix = written(
        spread.groupBy("source_key", "prefix").agg(F.first("source").alias("source"), F.sum("size").alias("size")), "mix"
    )
    sizes = by_prefix.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    goal = written(targets(sizes, weights, budget, max_epochs), "mix").withColumn("source_key", key_text(F.col("source")))
    goal = goal.withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("words") / F.col("source_size"))).otherwise(0).cast("long")
    ).withColumn("again", F.col("words") - F.col("epochs") * F.col("source_size")).drop("source", "weight", "words")
    so_far = Window.partitionBy("source_key").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    plan = by_prefix.drop("source").withColumn("before", F.coalesce(F.sum("size").over(so_far), F.lit(0))).join(goal, "source_key")
    # what each prefix takes again: all of it, nothing, or on the border a part
    border = plan.where((F.col("before") < F.col("again")) & (F.col("before") + F.col("size") > F.col("again"))).select(
        "source_key", F.col("prefix").alias("border_prefix"), (F.col("again") - F.col("before")).alias("border_words")
    )
    marks = written(
        goal.join(border, "source_key", "left").join(
            # prefixes below the border, or below the first that stays out, are taken again in full
            plan.where(F.col("before") + F.col("size") <= F.col("again")).groupBy("source_key").agg(F.max("prefix").alias("full_prefix")),
            "source_key", "left",
        ),
        "mix",
    )
    rows = spread.join(marks, "source_key")
    here = F.coalesce(F.col("prefix") == F.col("border_prefix"), F.lit(False))
    inside = rows.where(here)
    ahead = Window.partitionBy("source_key").orderBy("digest", "size").rowsBetween(Window.unboundedPreceding, -1)
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("border_words") - F.coalesce(F.sum("size").over(ahead), F.lit(0))))
    outside = rows.where(~here).withColumn(
        "part", F.when(F.coalesce(F.col("prefix") <= F.col("full_prefix"), F.lit(False)), F.col("size")).otherwise(0).cast("long")
    )
    both = inside.withColumn("part", part.cast("long")).unionByName(outside)
    return both.withColumn("taken", (F.col("epochs") * F.col("size") + F.col("part")).cast("long")).drop(
        "source_key", "prefix", "border_prefix", "border_words", "full_prefix", "epochs", "again", "part"
    )


def manifest(docs: DataFrame, doc_id="doc_id", source="source", text="text", seed: int = SEED, **how) -> DataFrame:
    """One narrow row per document: doc_id, size, source_size, target, taken."""
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(whole(text)).alias("size"),
        digest(F.col(doc_id), seed).alias("digest"),
    )
    done = taken(written(narrow, "mix"), **how)
    return done.select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", "taken")


def mix(docs: DataFrame, doc_id="doc_id", source="source", text="text", seed: int = SEED, **how) -> DataFrame:
    """The mix itself: the columns of ``docs``, and a row for each repetition of a document with
    ``mix_copy`` (from 1) and ``mix_words``, the words this repetition takes from the text's start.
    Columns of ``docs`` that have these names are replaced."""
    rows = packed(docs, source=F.col(source).cast("string"), size=word_count(whole(text)), digest=digest(F.col(doc_id), seed))
    plan = taken(rows, **how)
    copies = plan.where("taken > 0").select(
        "doc", "size", "taken",
        F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))).alias("mix_copy"),
    )
    mix_words = F.least(F.col("size"), F.col("taken") - (F.col("mix_copy") - 1) * F.col("size"))
    kept = [F.col(f"doc.`{c}`") for c in docs.columns if c.lower() not in ("mix_copy", "mix_words")]
    return copies.select(*kept, F.col("mix_copy"), mix_words.alias("mix_words"))
