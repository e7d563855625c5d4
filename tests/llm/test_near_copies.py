import random
import re
from collections import Counter

import pytest

from matchlake.llm import near_copies as N


def shingled(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """The ids that stay: the least of each component of all pairs."""
    sets = [shingled(t) for _, t in rows]
    holders = {}
    for i, s in enumerate(sets):
        for g in s or ["no words"]:
            holders.setdefault(g, set()).add(i)
    group, kept = [None] * len(rows), Counter()
    for i in range(len(rows)):
        if group[i] is None:
            todo, group[i] = [i], i
            while todo:
                x = todo.pop()
                for y in set().union(*[holders[g] for g in sets[x] or ["no words"]]):
                    if group[y] is None and 5 * len(sets[x] & sets[y]) >= 4 * len(sets[x] | sets[y]):
                        group[y] = i
                        todo.append(y)
            ids = [d for (d, _), g in zip(rows, group) if g == i and d is not None]
            kept[min(ids, default=None)] += 1
    return kept


def copies(rng):
    """Texts and copies of Jaccard similarity from about 0.7 to 1, and a chain of them."""
    prose = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    texts = []
    for n in (12, 30, 60, 120, 300, 800):
        for _ in range(7):
            words = prose(n)
            texts.append(words)
            for share in (0.005, 0.01, 0.02, 0.03):
                other = list(words)
                for _ in range(max(1, round(share * n))):
                    other[rng.randrange(n)] = f"x{rng.randrange(5000)}"
                texts.append(other)
    chain = prose(200)
    for k in range(10):
        chain = chain[5:] + prose(5)
        texts.append(chain)
    rng.shuffle(texts)
    return [(i, " ".join(t).title(), "en", "a") for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [4, 5])
def test_copies(frame, seed):
    rows = copies(random.Random(seed))
    want = brute([r[:2] for r in rows])
    assert len(want) < 0.7 * len(rows)
    assert Counter(r.doc_id for r in N.one_of_each(frame(rows)).collect()) == want


def test_documents(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    got = N.one_of_each(docs)
    assert got.schema == docs.schema and Counter(r.doc_id for r in got.collect()) == want


def test_odd_rows(frame, odd):
    assert Counter(r.doc_id for r in N.one_of_each(frame(odd)).collect()) == brute([r[:2] for r in odd])
    assert N.one_of_each(frame([])).collect() == []
