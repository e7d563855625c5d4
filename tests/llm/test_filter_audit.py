"""The filter audit against a plain run of every order, and its potential against the formula of Shapley."""

import re
from collections import Counter
from fractions import Fraction
from itertools import combinations, permutations
from math import factorial

import pytest
from pyspark.sql import functions as F

from matchlake.llm import filter_audit as A

LABELS = "doc_id bigint, quality int, toxic int, source string, part string"


def failing(rows):
    """The set of failed filters of each row."""
    least = {}
    for d, t, *_ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    out = []
    for d, t, *_ in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append({k for k, f in {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and d > least[t],
        }.items() if f})
    return out


def brute(rows, labels):
    """Every order run filter by filter over what is left."""
    good, toxic = ({d for d, *said in labels if d is not None and said[i] == 1} for i in (0, 1))
    parts = {}
    for row, failed in zip(rows, failing(rows)):
        parts.setdefault(row[3] or "", []).append((row[0], failed))
    out, removals = [], Counter()
    for part, docs in parts.items():
        for order in permutations("ABCDE"):
            left = docs
            for step, k in enumerate(order, 1):
                gone, left = [x for x in left if k in x[1]], [x for x in left if k not in x[1]]
                removals[part, k] += len(gone)
                out.append((part, "".join(order), step, len(left), len(gone), sum(k in f for _, f in docs) - len(gone),
                            sum(f == {k} for _, f in docs), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)))
    return Counter((*o, removals[o[0], o[1][o[2] - 1]]) for o in out)


def got(docs, labels):
    return Counter(tuple(r) for r in A.report(docs, labels).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley").collect())


def varied():
    prose = " ".join(f"word{i}" for i in range(60))
    texts = [prose, prose.upper(), "few words", "same " * 80, prose + " #tag", "SAME$ " * 10, "", None, "x\n" * 50, "Ä ß " + prose, "\x85 " + prose]
    return [(i, texts[i * i % len(texts)], "en", [None, "", "a", "b", "a"][i % 5]) for i in range(200)]


def test_varied_rows(spark, frame, odd):
    rows = varied() + [(300, "few words", "en", "hot")] * 40 + odd
    labels = [(i, i % 2, int(i % 7 == 0)) for i in range(0, 200, 3)] + [(3, 1, 1), (None, 1, 1), (9, None, None)]
    table = spark.createDataFrame([(*x, "s", "p") for x in labels], LABELS)
    assert got(frame(rows), table) == brute(rows, labels)


def test_documents(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    assert got(docs, labels) == brute(rows, [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])


def test_empty(spark, frame):
    labels = spark.createDataFrame([], LABELS)
    assert A.report(frame([]), labels).collect() == []
    rows = [(1, None, None, None)]
    assert got(frame(rows), labels) == brute(rows, [])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_potential(spark, seed):
    """60 P by the recursion against the sum of marginal contributions that defines the Shapley value."""
    n = {m: (m * 7919 * seed) % 1000 for m in range(32)}
    v = [sum(c for m, c in n.items() if m & s) for s in range(32)]
    row = spark.createDataFrame([(v,)], "v array<bigint>").select(A.potentials(F.col("v")).alias("p")).head().p
    for i in range(5):
        rest, value = [j for j in range(5) if j != i], Fraction(0)
        for k in range(5):
            for s in combinations(rest, k):
                mask = sum(1 << j for j in s)
                value += Fraction(factorial(k) * factorial(4 - k), 120) * (v[mask | 1 << i] - v[mask])
        assert 120 * value == 2 * (row[31] - row[31 ^ 1 << i])


def test_plan_has_no_join_on_the_digest_alone(spark, sf):
    """A group of copies is never dealt by its digest, except as one combined row."""
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    plan = A.marked(A.failures(docs), labels)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "hashpartitioning(digest" in line]
    assert dealt and all("partial_min" in plan[plan.index(line):][:400] for line in dealt)
    assert "Window" not in plan
