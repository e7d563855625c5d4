"""SimHash near-duplicates by vantage-point trees.

A fingerprint bit is the majority of the bits of a text's four-word shingle hashes. Equal
fingerprints are one point, so copies never form pairs. A vantage-point tree divides the points by
their Hamming distance from a vantage point, near ones to the left; its upper levels are fitted on a
bounded sample and deal the points to shards. Each point lies in one shard; as a query it goes to
every shard that the triangle inequality cannot rule out, so pairs across a boundary meet. The answer
is exact whatever the sample: it only balances the shards. A pair of shards meets once, in the later
one. Within a shard the tree is carried on in numpy, for all its queries together.

A shard hands on a spanning forest (each point and the smallest one it is connected with), never its
pairs, so thousands of near copies of one text give as many rows as they have fingerprints. A shard
that is larger than ``SHARD`` points, because its points lie too close together to be divided, is cut
into slices that meet pairwise in tasks of their own. Connected components of these links follow by
alternating large and small stars, on narrow rows, with a written table after each round.

Cases: null and empty texts have fingerprint zero and are linked like any other; repeated rows and
equal texts share a point; a component of null ids only has a null id; an empty table gives an empty
result; very long texts are hashed whole, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import key_text, packed, sampled, sieve, whole

SHINGLE = 4
SEED = 42
#: Fingerprints link at this many differing bits or fewer.
RADIUS = 4
#: Points from which the upper levels are fitted, points that a shard should hold, levels at most. Each
#: level sends most queries both ways, so levels cost shuffled rows; a shard's own tree costs none.
SAMPLE, SHARD, LEVELS = 4096, 32_768, 9
#: Points that are compared directly at the bottom of a tree, and comparisons held in memory at once.
LEAF, CELLS = 96, 1 << 20
BLOCK = 1 << 16


def fingerprint(text: bytes, size: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a UTF-8 text, as an unsigned number."""
    words = text.lower().split()  # of bytes: A-Z only, and the six kinds of white space only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    n = max(1, len(words) - size + 1)
    starts = np.concatenate([[0], ends])[:n].tolist()
    stops = (ends[size - 1:] if len(words) >= size else ends[-1:]) - 1
    stops = stops.tolist()
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, BLOCK):
        hashes = np.array([digest(line[a:b], seed) for a, b in zip(starts[at:at + BLOCK], stops[at:at + BLOCK])], np.uint64)
        votes += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big")


def fingerprints(rows: DataFrame, text: str, size: int = SHINGLE) -> DataFrame:
    """``rows`` with ``fp`` (signed) in place of ``text``; nothing else of a text leaves its task."""
    others = [c for c in rows.columns if c != text]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            fps = np.array([fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", size) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps.view(np.int64))], [*others, "fp"])

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in others)
    return rows.select(*others, F.col(text).cast("binary")).mapInArrow(hashed, f"{schema}, fp bigint" if others else "fp bigint")


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _split(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """The vantage point, of a few, that spreads the points most, and their median distance from it;
    nothing if no point divides them."""
    best = None
    for v in points[:: max(1, len(points) // 5)][:5]:
        d = _apart(points, v)
        if best is None or d.std() > best[0]:
            best = d.std(), v, d
    cut = int(np.median(best[2]))
    inside = int((best[2] <= cut).sum())
    if inside == len(points):  # many at the greatest distance: cut below it
        cut -= 1
        inside = int((best[2] <= cut).sum())
    return (best[1], cut) if 0 < inside < len(points) else None


def fit_tree(points: np.ndarray, levels: int) -> list:
    """Nested (vantage, cut, near, far), with a shard's number at each end."""
    count = 0

    def grow(members: np.ndarray, depth: int):
        nonlocal count
        node = _split(members) if depth and len(members) > 1 else None
        if node is None:
            count += 1
            return count - 1
        near = _apart(members, node[0]) <= node[1]
        return [node[0], node[1], grow(members[near], depth - 1), grow(members[~near], depth - 1)]

    return grow(points, levels)


def route(tree, points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each point's own shard; and (point's place, shard) of the later shards it must be compared with."""
    home = np.zeros(len(points), np.int32)
    who, where = [], []

    def down(node, at: np.ndarray, own: np.ndarray):
        if not len(at):
            return
        if not isinstance(node, list):
            home[at[own]] = node
            who.append(at[~own])
            where.append(np.full(len(who[-1]), node, np.int32))
            return
        d = _apart(points[at], node[0]).astype(np.int16)
        near = d <= node[1]
        left, right = d - radius <= node[1], d + radius > node[1]
        down(node[2], at[left], (own & near)[left])
        down(node[3], at[right], (own & ~near)[right])

    down(tree, np.arange(len(points)), np.ones(len(points), bool))
    who, where = np.concatenate(who or [[]]).astype(np.int64), np.concatenate(where or [[]]).astype(np.int32)
    later = where > home[who]
    return home, who[later], where[later]


class Forest:
    """Connected components of a growing set of links between n points."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.label[a], self.label[b]
        while (differ := a != b).any():
            low, high = np.minimum(a, b)[differ], np.maximum(a, b)[differ]
            parent = np.arange(len(self.label))
            np.minimum.at(parent, high, low)
            while (parent[parent] != parent).any():
                parent = parent[parent]
            self.label = parent[self.label]
            a, b = parent[a], parent[b]


def connect(index: np.ndarray, queries: np.ndarray, points: np.ndarray, radius: int, forest: Forest) -> None:
    """Join every query with every indexed point within ``radius``; both are places in ``points``."""
    work = [(index, queries)]
    while work:
        x, q = work.pop()
        if not len(x) or not len(q):
            continue
        node = _split(points[x]) if len(x) > LEAF else None
        if node is None:
            step = max(1, CELLS // len(x))
            for at in range(0, len(q), step):
                some = q[at:at + step]
                i, j = np.nonzero(_apart(points[some][:, None], points[x][None, :]) <= radius)
                forest.join(some[i], x[j])
            continue
        dx, dq = _apart(points[x], node[0]), _apart(points[q], node[0]).astype(np.int16)
        work.append((x[dx <= node[1]], q[dq - radius <= node[1]]))
        work.append((x[dx > node[1]], q[dq + radius > node[1]]))


def links(points_df: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b), a > b: a spanning forest of the links between the distinct ``fp`` of ``points_df``."""
    spark = points_df.sparkSession
    n = points_df.count()
    sample = np.sort(np.array([r.fp for r in points_df.where(sampled(F.xxhash64("fp"), SAMPLE, n)).select("fp").collect()], np.int64)).view(np.uint64)
    levels = min(LEVELS, max(0, int(np.ceil(np.log2(max(n, 1) / SHARD)))))
    tree = fit_tree(sample, levels) if len(sample) else 0

    def dealt(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            home, who, where = route(tree, fps, radius)
            fp = np.concatenate([fps, fps[who]]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([home, where])), pa.array(fp), pa.array(np.arange(len(fp)) < len(fps))], ["shard", "fp", "indexed"]
            )

    rows = written(points_df.select("fp").mapInArrow(dealt, "shard int, fp bigint, indexed boolean"), "vp")
    # at most 2^LEVELS rows: the sizes tell which shards are cut into slices
    sizes = rows.groupBy("shard").agg(
        F.ceil(F.sum(F.col("indexed").cast("long")) / (2 * SHARD)).alias("parts"), F.ceil(F.count("*") / (8 * SHARD)).alias("turns")
    ).collect()
    parts, turns = {r.shard: max(1, r.parts) for r in sizes}, {r.shard: max(1, r.turns) for r in sizes}
    number = lambda d: F.coalesce(F.element_at(F.create_map(*[F.lit(v) for kv in d.items() for v in kv]), F.col("shard")), F.lit(1)) if d else F.lit(1)
    part, turn = F.pmod(F.xxhash64("fp"), number(parts)), F.pmod(F.xxhash64("fp", F.lit(1)), number(turns))
    every = lambda count: F.sequence(F.lit(0).cast("long"), count.cast("long") - 1)
    both = rows.select("shard", "fp", "indexed", part.cast("long").alias("own_part"), turn.cast("long").alias("own_turn"), number(parts).alias("parts"), number(turns).alias("turns"))
    # an indexed point is in one part and meets the queries of every turn; a query has one turn
    as_index = both.where("indexed").select("shard", F.col("own_part").alias("part"), F.explode(every(F.col("turns"))).alias("turn"), "fp", F.lit(True).alias("indexed"))
    as_query = both.select("shard", F.explode(every(F.col("parts"))).alias("part"), F.col("own_turn").alias("turn"), "fp", F.lit(False).alias("indexed"))

    def searched(table: pa.Table) -> pa.Table:
        fps, place = np.unique(table.column("fp").to_numpy().view(np.uint64), return_inverse=True)
        indexed = table.column("indexed").to_numpy(zero_copy_only=False).astype(bool)
        forest = Forest(len(fps))
        connect(place[indexed], place[~indexed], fps, radius, forest)
        moved = np.flatnonzero(forest.label != np.arange(len(fps)))
        a, b = fps[moved].view(np.int64), fps[forest.label[moved]].view(np.int64)
        return pa.table({"a": np.maximum(a, b), "b": np.minimum(a, b)})

    found = as_index.unionByName(as_query).groupBy("shard", "part", "turn").applyInArrow(searched, "a bigint, b bigint")
    return written(found.distinct(), "vp")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each neighbour on the least of the neighbourhood: the larger neighbours, or all the smaller."""
    if large:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        moved = around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.where("a <> b").distinct()
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def roots(edges: DataFrame) -> DataFrame:
    """(a, b): each linked point and the least of its component. ``edges`` have a > b."""
    state = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = state(edges)
    if not before[0]:
        return edges
    while True:
        edges = written(_star(written(_star(edges, True), "vp"), False), "vp")
        after = state(edges)
        if after == before:
            return edges
        before = after


def components(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, component_id) for the points that hold more than one row or are linked; ``marked`` has
    doc_id and fp."""
    points = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "vp")
    tree = roots(links(points, radius))
    rooted = points.join(tree.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = written(rooted, "vp")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("members"))
    return rooted.select("fp", "root").join(named.where("members > 1"), "root").select("fp", "root", "component_id")


def report(docs: DataFrame, doc_id="doc_id", text="text", radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint, component_id per document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text_"))
    marked = written(fingerprints(rows, "text_"), "vp")
    named = written(components(marked, radius), "vp")
    joined = marked.join(named.drop("root"), "fp", "left")
    return joined.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def identity(doc_id: Column, text: Column) -> Column:
    return F.concat(key_text(doc_id), F.lit("|"), F.xxhash64(text).cast("string"))


def one_of_each(docs: DataFrame, doc_id="doc_id", text="text", radius: int = RADIUS) -> DataFrame:
    """One document of each component, the one with the smallest id (nulls last, then by text hash);
    of repeated rows one stays. Columns and texts stay as they are."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), identity(F.col(doc_id), whole(text)).alias("key"), whole(text).alias("text_"))
    marked = written(fingerprints(rows, "text_"), "vp")
    named = written(components(marked, radius).drop("component_id"), "vp")
    return first_of_each(docs, marked, named, doc_id, text)


def first_of_each(docs: DataFrame, marked: DataFrame, named: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` with the first of each component only; ``marked`` has doc_id, key and fp, ``named`` fp and root.
    Rows that a sieve tells to be neither losing nor repeated are not shuffled."""
    grouped = marked.join(named, "fp").select("root", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key").alias("me"))
    first = grouped.groupBy("root").agg(F.min("me").alias("first"), F.count("*").alias("rows"))
    losing = grouped.join(first, "root").where(F.col("me.key") != F.col("first.key")).select(F.col("me.key").alias("key")).distinct()
    losing = written(losing, "vp")
    repeated = written(grouped.groupBy("me.key").agg(F.count("*").alias("times")).where("times > 1").join(losing, "key", "left_anti").select("key"), "vp")
    rows = packed(docs, key=identity(F.col(doc_id), whole(text)))
    asked = sieve(losing.unionByName(repeated), "key")(F.col("key"))
    sure, left = rows.where(~asked).select("doc.*"), rows.where(asked).join(losing, "key", "left_anti")
    if repeated.isEmpty():
        return sure.unionByName(left.select("doc.*"))
    again = left.join(repeated, "key", "left_semi").groupBy("key").agg(F.first("doc").alias("doc"))
    return sure.unionByName(left.join(repeated, "key", "left_anti").select("doc.*")).unionByName(again.select("doc.*"))
