"""One document of each group of near copies: five-word shingles, Jaccard similarity of 0.8 or more.

Texts with the same set of shingles are one point, whose SimHash fingerprint and min-hashes are taken
in one pass. A metric tree over all fingerprints cannot prune at the distance that a similarity of 0.8
asks for, so ``BANDS`` bands of ``ROWS`` min-hashes deal the points to buckets first: two sets of
similarity 0.8 share one of 24 bands of 5 with probability 1 - (1 - 0.8^5)^24, which leaves out one pair
in 14,000, and fewer of the closer ones. In each bucket a vantage-point tree over the fingerprints finds
those that differ in ``FAR`` bits or fewer, and hands on a spanning forest, never its pairs. What hangs
together so is a cell. Every set goes to its cell once, where the sets decide: all pairs within ``FAR``
bits whose sizes allow it are compared exactly, in whole numbers, and link at 0.8 or more. No pair of a cell is left
out but those that are linked already.

Cells end where no fingerprint is near, so the sets move in proportion to the rows. A bucket of more than
``SLICE`` points, or a cell of more than ``TILE`` bytes, is cut into slices by hash that meet pairwise in
tasks of their own: no task holds a group whole, at the price that a group far beyond that is moved once
for each of its slices. Both steps hand on forests; their components follow by alternating stars. Whole
texts are read again for the points of cells only, and a sieve of keys leaves most others where they
are, there and where the losing rows go out. All tables of the search are dropped at its end.

Cases: texts without words are copies of one another and of nothing else; a text of fewer than five
words is one shingle; a null text has no words; null ids come last in the choice; very long texts are
read whole, their shingles hashed in blocks; repeated rows and equal texts share a point; an empty
table stays empty; columns of any name pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Workspace
from . import simhash_vp
from .common import packed, sieve, whole

SHINGLE, SEED = 5, 42
#: Linked at a Jaccard similarity of ALIKE / OF or more.
ALIKE, OF = 4, 5
BANDS, ROWS = 24, 5
#: At 0.8 a bit of the fingerprint differs with probability 0.15; beyond 22 of 64 come 2 in 100,000.
FAR = 22
#: Points of a bucket that a task searches together, bytes of sets of a cell that it compares.
SLICE, TILE = 4096, 8 << 20
#: Shingles of a text handled together.
BLOCK = 512

_RNG = np.random.default_rng(SEED)
#: Odd factors and shifts of the min-hashes, and of the places in a shingle and in a band.
FACTORS, SHIFTS = _RNG.integers(0, 1 << 63, (2, BANDS * ROWS), np.uint64) * np.uint64(2) + np.uint64(1)
PLACES = _RNG.integers(0, 1 << 63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingles(text: bytes) -> np.ndarray:
    """The hashes of a UTF-8 text's shingles, each once, in order."""
    digest = xxhash.xxh64_intdigest
    words = text.lower().split()  # of bytes: A-Z only, and the six kinds of white space only
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter((digest(w, SEED) for w in words), np.uint64, len(words))
    n = max(1, len(words) - SHINGLE + 1)
    found = np.full(n, min(len(words), SHINGLE), np.uint64)
    for k in range(min(len(words), SHINGLE)):
        found = _mixed((found ^ hashed[k:k + n]) * PLACES[k])
    return np.unique(found)


def bands(found: np.ndarray) -> np.ndarray:
    """The buckets of a set: one hash for each band of its min-hashes."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), BLOCK):
        np.minimum(least, (found[at:at + BLOCK, None] * FACTORS + SHIFTS).min(0), out=least)
    least, out = least.reshape(BANDS, ROWS), np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        out = _mixed((out ^ least[:, k]) * PLACES[k])
    return out


def signature(text: bytes) -> tuple[int, int, int, list]:
    """(digest of the set, its SimHash, its size, its buckets); hashes are signed."""
    found = shingles(text)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(found), BLOCK):
        votes += np.unpackbits(found[at:at + BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    signed = lambda raw: int.from_bytes(raw, "big", signed=True)
    where = bands(found).view(np.int64) if len(found) else []
    return signed(xxhash.xxh64_digest(found.tobytes(), SEED)), signed(np.packbits(votes * 2 > len(found)).tobytes()), len(found), where


def _bytes(text) -> bytes:
    return text.as_buffer().to_pybytes() if text.is_valid else b""


def signatures(rows: DataFrame) -> DataFrame:
    """(doc_id, key, fp, sim, n, bands) from (doc_id, key, text_); ``fp`` is the digest of the set."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]

    def signed(batches):
        for batch in batches:
            found = [signature(_bytes(t)) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *[pa.array([x[i] for x in found], kind) for i, kind in enumerate(kinds)]], ["doc_id", "key", "fp", "sim", "n", "bands"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "key", F.col("text_").cast("binary")).mapInArrow(
        signed, f"doc_id {kind}, key string, fp bigint, sim bigint, n bigint, bands array<bigint>")


def members(points: DataFrame, work: Workspace) -> DataFrame:
    """(bucket, fp, sim, parts) of the points that share a bucket with another."""
    dealt = points.select("fp", "sim", F.explode("bands").alias("bucket"))
    shared = dealt.groupBy("bucket").agg(F.count("*").alias("all")).where("`all` > 1")
    shared = work.written(shared.select("bucket", F.ceil(F.col("all") / SLICE).alias("parts")))
    return work.written(dealt.where(sieve(shared, "bucket")(F.col("bucket"))).join(shared, "bucket"))


def meeting(rows: DataFrame, parts: Column) -> DataFrame:
    """``rows`` with part, turn and left: a group's slices meet pairwise, each also itself; ``left`` are
    the points of slice ``part``, which those of slice ``turn`` are compared with."""
    own = F.pmod(F.xxhash64("fp"), parts)
    slots = F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), lambda j: F.struct(F.least("own", j).alias("part"), F.greatest("own", j).alias("turn")))
    dealt = rows.withColumn("own", own).withColumn("slot", F.explode(slots))
    return dealt.withColumns({"part": F.col("slot.part"), "turn": F.col("slot.turn"), "left": F.col("own") == F.col("slot.part")}).drop("own", "slot")


def sides(left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places that are compared with others, and the others."""
    index, queries = np.flatnonzero(left), np.flatnonzero(~left)
    return index, queries if len(queries) else index


def near(inside: DataFrame, work: Workspace) -> DataFrame:
    """(a, b): a spanning forest of the points that share a bucket within FAR bits, for each bucket."""
    def searched(batches):
        for batch in batches:
            lists = batch.column(0)
            flat, ends = lists.flatten(), lists.offsets.to_numpy()
            fp, sim = flat.field("fp").to_numpy(), flat.field("sim").to_numpy().view(np.uint64)
            left = flat.field("left").to_numpy(zero_copy_only=False)
            low, high = [], []
            for i, j in zip(ends[:-1] - ends[0], ends[1:] - ends[0]):
                forest = simhash_vp.Forest(j - i)
                simhash_vp.connect(*sides(left[i:j]), sim[i:j], FAR, forest)
                moved = np.flatnonzero(forest.label != np.arange(j - i))
                low.append(fp[i:j][moved])
                high.append(fp[i:j][forest.label[moved]])
            pair = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (low, high)]
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(*pair)), pa.array(np.minimum(*pair))], ["a", "b"])

    together = meeting(inside, F.col("parts")).groupBy("bucket", "part", "turn").agg(F.collect_list(F.struct("fp", "sim", "left")).alias("points"))
    return work.written(together.select("points").mapInArrow(searched, "a bigint, b bigint").distinct())


def sets(cells: DataFrame, points: DataFrame, rows: DataFrame, work: Workspace) -> DataFrame:
    """(fp, cell, sim, s): the whole shingle sets of the points in ``cells``, from the text of one row each."""
    keys = work.written(points.select("fp", "sim", "key").join(cells, "fp").select("fp", "cell", "sim", "key"))

    def hashed(batches):
        for batch in batches:
            found = pa.array([shingles(_bytes(t)).tobytes() for t in batch.column(3)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], found], ["fp", "cell", "sim", "s"])

    found = rows.where(sieve(keys, "key")(F.col("key"))).join(keys, "key").select("fp", "cell", "sim", F.col("text_").cast("binary"))
    return work.written(found.mapInArrow(hashed, "fp bigint, cell bigint, sim bigint, s binary").dropDuplicates(["fp"]))


def alike(table: pa.Table) -> pa.Table:
    """(a, b): a spanning forest of the links between the points of two slices of a cell."""
    table = table.sort_by([("left", "descending"), ("fp", "ascending")])
    fp, sim = table.column("fp").to_numpy(), table.column("sim").to_numpy().view(np.uint64)
    index, queries = sides(table.column("left").to_numpy())
    found = [np.frombuffer(s.as_buffer(), np.uint64) for s in table.column("s")]
    n = np.array([len(s) for s in found], np.int64)
    starts = np.cumsum(n) - n
    words, ids = np.unique(np.concatenate(found), return_inverse=True)
    mark, forest = np.zeros(len(words), bool), simhash_vp.Forest(len(fp))
    for q in queries:
        close = (np.bitwise_count(sim[index] ^ sim[q]) <= FAR) & (OF * np.minimum(n[index], n[q]) >= ALIKE * np.maximum(n[index], n[q]))
        some = index[close & (forest.label[index] != forest.label[q])]
        if not len(some):
            continue
        own = ids[starts[q]:starts[q] + n[q]]
        mark[own] = True
        begin = np.cumsum(n[some]) - n[some]
        their = ids[np.repeat(starts[some] - begin, n[some]) + np.arange(n[some].sum())]
        both = np.add.reduceat(mark[their], begin, dtype=np.int64)
        mark[own] = False
        linked_ = some[OF * both >= ALIKE * (n[some] + n[q] - both)]
        forest.join(np.full(len(linked_), q), linked_)
    moved = np.flatnonzero(forest.label != np.arange(len(fp)))
    a, b = fp[moved], fp[forest.label[moved]]
    return pa.table({"a": np.maximum(a, b), "b": np.minimum(a, b)})


def roots(edges: DataFrame, work: Workspace) -> DataFrame:
    """(fp, root): each linked point and the least of its component."""
    state = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    edges, before = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), None
    while (now := state(edges)) != before and now[0]:
        before = now
        edges = work.written(simhash_vp._star(work.written(simhash_vp._star(edges, True)), False))
    return edges.select(F.col("a").alias("fp"), F.col("b").alias("root"))


def linked(points: DataFrame, rows: DataFrame, work: Workspace) -> DataFrame:
    """(fp, root) of the points that are linked with a smaller one."""
    tree = roots(near(members(points, work), work), work).withColumnRenamed("root", "cell")
    cells = work.written(tree.unionByName(tree.select(F.col("cell").alias("fp"), "cell").distinct()))
    known = sets(cells, points, rows, work)
    large = known.groupBy("cell").agg(F.ceil(F.sum(F.octet_length("s")) / TILE).alias("parts")).where("parts > 1")
    known = known.join(work.written(large), "cell", "left")
    found = meeting(known, F.coalesce("parts", F.lit(1).cast("long"))).select("cell", "part", "turn", "fp", "sim", "s", "left")
    found = found.groupBy("cell", "part", "turn").applyInArrow(alike, "a bigint, b bigint")
    return roots(work.written(found.distinct()), work)


def components(marked: DataFrame, rows: DataFrame, work: Workspace) -> DataFrame:
    """(fp, root) for the points that hold more than one row or are linked."""
    points = work.written(marked.groupBy("fp").agg(
        F.first("sim").alias("sim"), F.first("bands").alias("bands"), F.min("key").alias("key"), F.count("*").alias("times")))
    tree = linked(points, rows, work)
    rooted = work.written(points.select("fp", "times").join(tree, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    several = rooted.groupBy("root").agg(F.sum("times").alias("rows")).where("rows > 1")
    return rooted.join(several, "root").select("fp", "root")


def one_of_each(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """One document of each component, the one with the smallest id (nulls last, then by text hash);
    of repeated rows one stays. Columns and texts stay as they are."""
    key = simhash_vp.identity(F.col(doc_id), whole(text))
    rows = packed(docs, doc_id=F.col(doc_id), key=key, text_=whole(text)).select("doc_id", "key", "text_")
    with Workspace(docs.sparkSession, "near-copies") as work:
        marked = work.written(signatures(rows))
        named = work.written(components(marked, rows, work))
        return simhash_vp.first_of_each(docs, marked, named, doc_id, text)
