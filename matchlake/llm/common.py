"""What the operators of this folder share: the contract's words, letters and rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that ends a word: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text as a string; a null one is empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other letter left alone."""
    return F.translate(text, UPPER, LOWER)


def stripped(text: Column) -> Column:
    return F.trim(text, F.lit(BLANKS))


def words(text: Column) -> Column:
    """The runs of characters other than white space, as an array; none in an empty text."""
    return F.filter(F.split(text, BLANK_RUN), lambda w: w != "")


def word_count(text: Column) -> Column:
    inner = stripped(text)
    return F.when(inner == "", F.lit(0)).otherwise(F.size(F.split(inner, BLANK_RUN))).cast("long")


def key_text(column: Column) -> Column:
    """A text that is equal for equal values only, nulls among them: ``3:src`` or ``-``."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("-"))


def packed(docs: DataFrame, **needed: Column) -> DataFrame:
    """``needed`` under names of the operator's own, and the whole row as ``doc``; columns of the
    input that happen to have the same names stay inside ``doc`` and cannot clash."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if docs.columns else F.lit(None)
    return docs.select(row.alias("doc"), *[value.alias(name) for name, value in needed.items()])


def unpacked(packed_docs: DataFrame) -> DataFrame:
    return packed_docs.select("doc.*")


def sampled(hashed: Column, size: int, rows: int) -> Column:
    """Whether a row is in a sample of about ``size`` of ``rows``: those with the lowest hashes. No
    rows are gathered to pick it."""
    slots = 1 << 30
    return F.pmod(hashed, F.lit(slots)) < min(slots, -(-slots * size // max(1, rows)))


#: Bits of a sieve for each of its keys, and at most in all (8 MB).
SIEVE_BITS, SIEVE_MOST = 8, 1 << 26


def sieve(keys: DataFrame, name: str) -> Callable[[Column], Column]:
    """A test that holds for each value of ``keys[name]`` and for about one in eight of the others, more
    beyond SIEVE_MOST / SIEVE_BITS keys: a bitmap of hashes. What fails it needs no join with the keys,
    and so no shuffle; what passes has yet to be joined."""
    size = 1 << 15
    while size < min(SIEVE_MOST, SIEVE_BITS * keys.count()):
        size *= 2
    slot = lambda value: F.pmod(F.xxhash64(value), F.lit(size))
    marks = keys.select((slot(F.col(name)) + 1).alias("at")).groupBy(F.bitmap_bucket_number("at").alias("part"))
    bits = np.zeros(size // 8, np.uint8)
    for row in marks.agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect():
        start = (row.part - 1) << 12
        bits[start:start + len(row.bits)] = np.frombuffer(row.bits, np.uint8)
    shared = keys.sparkSession.sparkContext.broadcast(bits)

    @F.arrow_udf("boolean")
    def passes(at: pa.Array) -> pa.Array:
        at = at.to_numpy(zero_copy_only=False)
        return pa.array((shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))

    return lambda value: passes(slot(value))
