"""Benchmark decontamination by the q-gram lemma.

An item of m letters that a text holds with at most e edits shares at least m + 1 - q * (e + 1) of its
q-grams with the text, along diagonals (place in the text less place in the item) that lie within e of
each other. Shared q-grams are counted per item in diagonal bands of twice that width which overlap by
half, so that one band holds them all; bands that reach the bound are verified by banded alignment.

Benchmark items are a stated query set: they are taken in blocks of at most ``BLOCK`` letters, whose
index goes to the tasks, and each block is one pass over the texts. Texts stay in their tasks; nothing
is shuffled, so neither a common passage nor a long text makes a hot key.

Letters are compared in lower case, all white space as blanks. No edits are allowed in an item for
which one could destroy every q-gram; items of fewer than q letters have none, and are looked up
letter for letter wherever they are not part of a longer word.

Cases: null and empty texts hold nothing; null and blank items are in nothing; equal items are each
reported; repeated rows are reported each for itself; empty tables give no rows; a very long text is
searched whole, in its own row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, whole

Q = 10
#: Edits allowed, as a share of an item's letters.
EDITS = 0.08
BLOCK = 4_000_000
#: Bits of a hash that the first filter looks up.
SIEVE = 22
BASE = np.uint64(0x9E3779B97F4A7C15)


def letters(text: str) -> np.ndarray:
    """Code points in lower case, white space and control characters as blanks, one for one."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    codes[codes < 33] = 32
    return codes


def grams(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """A hash of the q-gram at each place."""
    if len(codes) < q:
        return np.zeros(0, np.uint64)
    power, width, left, out, done = np.full(1, BASE), 1, codes, None, 0  # arrays multiply modulo 2^64
    for bit in range(q.bit_length()):  # from widths 1, 2, 4, ... those that add up to q
        if q >> bit & 1:
            piece = left[done:]
            out = piece if out is None else out[: len(piece)] * power + piece[: len(out)]
            done += width
        if done < q:
            left, power, width = left[:-width] * power + left[width:], power * power, width * 2
    out = out[: len(codes) - q + 1] * BASE
    return out ^ (out >> np.uint64(29))


class Index:
    """The q-grams of a block of items."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        self.codes = [letters(t) for _, t in items]
        size = np.array([len(c) for c in self.codes], np.int64)
        self.edits = np.floor(size * EDITS).astype(np.int64)
        # where e edits could destroy every q-gram, fewer are allowed
        self.edits = np.minimum(self.edits, np.maximum(0, (size - Q) // Q - 1))
        self.bound = size + 1 - Q * (self.edits + 1)
        self.width = np.maximum(8, self.edits + 1)
        self.size = size
        hashes = [grams(c) for c in self.codes]
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        item = np.repeat(np.arange(len(items)), [len(h) for h in hashes])
        place = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.zeros(0, np.int64)
        self.item, self.place = item[order].astype(np.int32), place[order].astype(np.int32)
        self.known, self.first, self.times = np.unique(flat[order], return_index=True, return_counts=True)
        self.short: dict[int, dict[int, list[int]]] = {}  # length, hash, numbers of items without q-grams
        for i in np.flatnonzero(size < Q).tolist():
            whole_item = int(grams(self.codes[i], int(size[i]))[0])
            self.short.setdefault(int(size[i]), {}).setdefault(whole_item, []).append(i)
        self.sieve = np.zeros(1 << SIEVE, bool)
        self.sieve[self.known >> np.uint64(64 - SIEVE)] = True

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the text, item, place in the item) of all shared q-grams."""
        h = grams(codes)
        at = np.flatnonzero(self.sieve[h >> np.uint64(64 - SIEVE)])
        where = np.searchsorted(self.known, h[at])
        where[where == len(self.known)] = 0
        true = self.known[where] == h[at] if len(self.known) else np.zeros(len(at), bool)
        at, where = at[true], where[true]
        times = self.times[where]
        entry = np.repeat(self.first[where], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        return np.repeat(at, times), self.item[entry], self.place[entry]


def align(item: np.ndarray, text: np.ndarray, most: int, slack: int) -> tuple[int, int, int] | None:
    """Least edits that turn the whole item into a piece of the text, with the piece's start and end;
    nothing beyond ``most``. Row i of the table holds the ends i .. i + 2 * slack only."""
    far = most + len(item) + 1
    width = 2 * slack + 1
    steps = np.arange(width)
    text = np.concatenate([text, np.full(max(0, len(item) + width - len(text)), 2**40, np.uint64)])
    cost, start = np.zeros(width, np.int64), steps.copy()  # the piece may start anywhere in the band
    for i, letter in enumerate(item):
        swap = cost + (text[i:i + width] != letter)  # to the end one further
        drop = np.append(cost[1:] + 1, far)  # the item's letter is missing in the text
        down = np.where(swap <= drop, swap, drop)
        from_ = np.where(swap <= drop, start, np.append(start[1:], 0))
        # letters that only the text has: the least cost to the left, plus one a step
        run = down - steps
        low = np.minimum.accumulate(run)
        origin = np.maximum.accumulate(np.where(run == low, steps, 0))
        cost, start = low + steps, from_[origin]
        if cost.min() > most:
            return None
    end = int(np.argmin(cost))
    return (int(cost[end]), int(start[end]), end + len(item)) if cost[end] <= most else None


def verbatim(codes: np.ndarray, index: Index) -> list[tuple[int, int, int, int, int]]:
    """Regions that are items of fewer than q letters, between ends of words."""
    out = []
    inside = lambda at: 0 <= at < len(codes) and chr(int(codes[at])).isalnum()
    for size, known in index.short.items():
        found = grams(codes, size)
        for at in np.flatnonzero(np.isin(found, np.array(list(known), np.uint64))).tolist():
            end = at + size
            cut = (inside(at - 1) and inside(at)) or (inside(end - 1) and inside(end))
            out += [(i, at, end, 0, 0) for i in known[int(found[at])] if not cut and np.array_equal(index.codes[i], codes[at:end])]
    return out


def leaks(text: str, index: Index) -> list[tuple[int, int, int, int, int]]:
    """(item's number, start, end, edits, shared q-grams) of each region of the text that holds one."""
    codes = letters(text)
    out = verbatim(codes, index)
    at, item, place = index.hits(codes)
    if not len(at):
        return out
    diagonal = at.astype(np.int64) - place
    band = diagonal // index.width[item]
    # the band that starts at the hit's step, and the one before, which reaches over it
    key = np.concatenate([item.astype(np.int64) << 40 | band + (1 << 39), item.astype(np.int64) << 40 | band - 1 + (1 << 39)])
    found, count = np.unique(key, return_counts=True)
    enough = count >= np.maximum(1, index.bound[found >> 40])
    # an item's fullest bands first; the band beside one that was shown holds the same region
    for k, n in sorted(zip(found[enough].tolist(), count[enough].tolist()), key=lambda x: (x[0] >> 40, -x[1], x[0])):
        i = k >> 40
        width, edits = int(index.width[i]), int(index.edits[i])
        begin = max(0, ((k & (1 << 40) - 1) - (1 << 39)) * width - edits)
        slack = width + edits + 1
        if any(o[0] == i and begin <= o[1] <= begin + 2 * slack for o in out):
            continue
        result = align(index.codes[i], codes[begin: begin + int(index.size[i]) + 2 * slack + 1], edits, slack)
        if result:
            out.append((i, begin + result[1], begin + result[2], result[0], n))
    return out


def blocks(benchmark: DataFrame, item_id="item_id", text="text") -> Iterator[list[tuple[int, str]]]:
    """The items, at most BLOCK letters (or one item) at a time."""
    rows = benchmark.select(F.col(item_id).alias("id"), whole(text).alias("t")).where(F.col("t").rlike(r"[^\x00-\x20]"))
    spread = rows.select("*", F.pmod(F.xxhash64("id", "t"), F.lit(1 << 16)).alias("slot"))
    slots = spread.groupBy("slot").agg(F.sum(F.length("t")).alias("n"))
    total = F.sum("n").over(Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1))
    cuts = slots.select("slot", F.floor(F.coalesce(total, F.lit(0)) / BLOCK).alias("block")).groupBy("block").agg(
        F.min("slot").alias("low"), F.max("slot").alias("high")
    ).orderBy("block")
    for cut in cuts.collect():
        yield [(r.id, r.t) for r in spread.where(F.col("slot").between(cut.low, cut.high)).orderBy("id", "t").collect()]


def report(docs: DataFrame, benchmark: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """doc_id, item_id, start, end, edits, shared per region of a document that holds an item; places
    in code points, end exclusive."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("t"))
    spark, parts = docs.sparkSession, []
    schema = "doc_id bigint, item_id bigint, start bigint, end bigint, edits bigint, shared bigint"
    for items in blocks(benchmark):
        index = spark.sparkContext.broadcast(Index(items))

        def scanned(batches, index=index):
            for batch in batches:
                out = [
                    (d.as_py(), index.value.ids[i], a, b, e, n)
                    for d, t in zip(batch.column(0), batch.column(1)) for i, a, b, e, n in leaks(t.as_py(), index.value)
                ]
                cols = list(zip(*out)) or [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "item_id", "start", "end", "edits", "shared"])

        parts.append(rows.mapInArrow(scanned, schema))
    result = spark.createDataFrame([], schema) if not parts else parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def clean(docs: DataFrame, benchmark: DataFrame, text="text") -> DataFrame:
    """The documents that hold no item, unchanged."""
    left = packed(docs, t=whole(text))
    for items in blocks(benchmark):
        index = docs.sparkSession.sparkContext.broadcast(Index(items))

        def scanned(batches, index=index):
            for batch in batches:
                yield batch.filter(pa.array([not leaks(t.as_py(), index.value) for t in batch.column(1)], pa.bool_()))

        left = left.mapInArrow(scanned, left.schema)
    return left.select("doc.*")
