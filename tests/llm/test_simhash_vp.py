import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from matchlake.llm import queries
from matchlake.llm import simhash_vp as V


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    fps = [fingerprint(t) for _, t in rows]
    f = np.array(fps, np.uint64)
    group, out = [None] * len(rows), []
    for i in range(len(rows)):
        if group[i] is None:
            todo, group[i] = [i], i
            while todo:
                for k in np.flatnonzero(np.bitwise_count(f ^ f[todo.pop()]) <= 4):
                    if group[k] is None:
                        group[k] = i
                        todo.append(int(k))
    for (d, _), p, g in zip(rows, fps, group):
        ids = [e for (e, _), h in zip(rows, group) if h == g and e is not None]
        out.append((d, f"{p:016x}", min(ids, default=None)))
    return Counter(out)


@pytest.mark.parametrize("shard", [8192, 20])
def test_documents(spark, sf, shard, monkeypatch):
    monkeypatch.setattr(V, "SHARD", shard)
    monkeypatch.setattr(V, "LEAF", 8)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(map(tuple, queries.QUERIES["op3_simhash"](spark, sf).collect())) == brute(rows)


def test_odd_rows(frame, odd):
    assert Counter(map(tuple, V.report(frame(odd)).collect())) == brute([r[:2] for r in odd])
    kept = V.one_of_each(frame(odd)).collect()
    assert Counter(r.doc_id for r in kept) == Counter({c for _, _, c in brute([r[:2] for r in odd])})
    assert V.one_of_each(frame(odd)).columns == frame(odd).columns


def test_empty(frame):
    assert V.report(frame([])).collect() == V.one_of_each(frame([])).collect() == []


def test_dense_cluster_in_slices(spark, monkeypatch):
    """Points too close to be divided: the shard is sliced, and chains across slices hold."""
    monkeypatch.setattr(V, "SHARD", 4)
    rng = random.Random(5)
    points = {0}
    while len(points) < 300:
        points.add(rng.choice(sorted(points)) ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)))
    far = {rng.getrandbits(63) for _ in range(50)}
    df = spark.createDataFrame([(p,) for p in points | far], "fp long")
    tree = {r.a: r.b for r in V.roots(V.links(df)).collect()}
    assert {tree.get(p, p) for p in points} == {0}
    assert all(tree.get(p, p) == p for p in far)


def test_route_loses_no_pair():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 400, dtype=np.int64).view(np.uint64)
    near = base ^ np.array([1 << int(rng.integers(64)) for _ in base], np.uint64)
    points = np.concatenate([base, near])
    tree = V.fit_tree(points[:64], 5)
    home, who, where = V.route(tree, points, 4)
    asked = set(zip(who.tolist(), where.tolist())) | set(enumerate(home.tolist()))
    for i, j in zip(*np.nonzero(np.bitwise_count(points[:, None] ^ points) <= 4)):
        assert (i, home[j]) in asked or (j, home[i]) in asked
