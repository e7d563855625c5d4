"""Vantage-point search in buckets, exact sets in cells: whole links, whatever the size of a group."""

import random
from collections import Counter

import numpy as np
import pytest

from matchlake.llm import near_copies as N
from matchlake.session import Workspace
from tests.llm.test_near_copies import brute, copies


def marked(frame, rows, work):
    texts = frame(rows).selectExpr("doc_id", "cast(doc_id as string) AS key", "text AS text_")
    signed = work.written(N.signatures(texts))
    return texts, work.written(signed.selectExpr("fp", "sim", "bands", "key"))


def family(rng, count, words, changes):
    """Copies of one text, most of them a little below or above the similarity."""
    text = [f"w{rng.randrange(5000)}" for _ in range(words)]
    rows = []
    for i in range(count):
        other = list(text)
        for _ in range(rng.choice(changes)):
            other[rng.randrange(words)] = f"x{rng.randrange(9000)}"
        rows.append((i, " ".join(other), "en", "a"))
    return rows


def test_a_pair_in_the_bucket_of_another(frame):
    """All buckets of the linked pair hold a third text, alike to neither, that comes before both."""
    rng = random.Random(3519)
    text = [f"w{rng.randrange(5000)}" for _ in range(120)]
    rows = []
    for i, k in enumerate((2, 1, 1)):
        other = list(text)
        for _ in range(k):
            other[rng.randrange(120)] = f"x{rng.randrange(5000)}"
        rows.append((i, " ".join(other), "en", "a"))
    assert Counter(r.doc_id for r in N.one_of_each(frame(rows)).collect()) == brute([r[:2] for r in rows]) == {0: 1, 1: 1}


def test_each_set_goes_to_its_cell_once(spark, frame):
    rows = family(random.Random(3), 300, 120, (3, 4, 5, 6))
    with Workspace(spark, "test") as work:
        texts, points = marked(frame, rows, work)
        inside = N.members(points, work)
        forest = N.near(inside, work)
        assert forest.count() < inside.count()  # a forest for each bucket, no pairs
        cells = N.roots(forest, work).withColumnRenamed("root", "cell")
        known = N.sets(cells, points, texts, work)
        assert known.count() == known.select("fp").distinct().count() == cells.count()


@pytest.mark.parametrize("limit, size", [("SLICE", 3), ("TILE", 4000)])
def test_sliced_groups(frame, monkeypatch, limit, size):
    monkeypatch.setattr(N, limit, size)
    rows = family(random.Random(5), 60, 80, (1, 2, 3)) + [(i + 100, *r) for i, *r in copies(random.Random(6))[:80]]
    assert Counter(r.doc_id for r in N.one_of_each(frame(rows)).collect()) == brute([r[:2] for r in rows])


def test_slices_meet_once(spark):
    rows = spark.range(50).selectExpr("id AS fp", "5L AS parts")
    met = {}
    for r in N.meeting(rows, rows["parts"]).collect():
        met.setdefault((r.part, r.turn), []).append((r.fp, r.left))
    pairs = Counter()
    for points in met.values():
        index, queries = N.sides(np.array([left for _, left in points]))
        if index is queries:
            pairs.update((a, b) for a, _ in points for b, _ in points if a < b)
        else:
            pairs.update(tuple(sorted((points[i][0], points[q][0]))) for i in index for q in queries)
    assert pairs == Counter((a, b) for a in range(50) for b in range(a + 1, 50))
