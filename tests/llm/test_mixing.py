import hashlib
import re
from fractions import Fraction

import duckdb
import pytest

from matchlake.llm import mixing, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water_fill(sizes, weights, total, epochs):
    """Round by round: clamp what is above its cap, share the rest again."""
    capped = {}
    while True:
        free = [s for s in sizes if s not in capped]
        left = total - sum(capped.values())
        share = {s: Fraction(left * weights[s], sum(weights[t] for t in free)) for s in free} if free else {}
        over = [s for s in free if share[s] > epochs * sizes[s]]
        if not over:
            return {**{s: float(v) for s, v in capped.items()}, **{s: float(v) for s, v in share.items()}}
        capped.update({s: epochs * sizes[s] for s in over})


def brute(rows):
    size = [len(WORD.findall(t or "")) for _, t, _, _ in rows]
    names = sorted({s for *_, s in rows if s is not None}) + [None] * any(s is None for *_, s in rows)
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    sizes = {n: sum(z for z, r in zip(size, rows) if r[3] == n) for n in names}
    goal = water_fill(sizes, weights, Fraction(3 * sum(size), 2), 2)
    out = []
    for name in names:
        mine = sorted(
            (hashlib.md5(f"{'-' if d is None else d}:42".encode()).hexdigest(), z, d)
            for (d, _, _, s), z in zip(rows, size) if s == name for d in [d if d is not None else "-"]
        )
        words = int(goal[name] + 0.5)
        whole, again = divmod(words, sizes[name]) if sizes[name] else (0, 0)
        for _, z, d in mine:
            part = min(z, again)
            again -= part
            out.append((None if d == "-" else d, z, sizes[name], goal[name], whole * z + part))
    return out


def same(got, want):
    key = lambda r: tuple((x is not None, x if x is not None else 0) for x in r)
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want])


def test_odd_rows(frame, odd):
    same(mixing.manifest(frame(odd)).collect(), brute(odd))


def test_capped_sources(frame):
    rows = [(i, "w " * (1 + i % 7), "en", f"s{i % 5}" if i % 11 else "tiny") for i in range(300)] + [(999, "w " * 5000, "en", "big")]
    got = mixing.manifest(frame(rows)).collect()
    same(got, brute(rows))
    assert all(r.taken <= 2 * r["size"] for r in got)


def test_empty(frame):
    assert mixing.manifest(frame([])).collect() == []
    assert mixing.mix(frame([])).collect() == []
    assert [r.taken for r in mixing.manifest(frame([(1, None, None, None)])).collect()] == [0]


def test_mix_repeats_what_the_manifest_says(frame, odd):
    docs = frame(odd)
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "mix_copy", "mix_words"]
    assert sum(r.mix_words for r in mixed.collect()) == sum(r.taken for r in mixing.manifest(docs).collect())


def test_mixing_a_mix_again(frame, odd):
    twice = mixing.mix(mixing.mix(frame(odd)))
    assert twice.columns == [*frame(odd).columns, "mix_copy", "mix_words"] and twice.count() > 0


def test_query_against_sql(spark, sf):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = db.execute(queries.ORACLES["op1_mixing"]).fetchall()
    same(queries.QUERIES["op1_mixing"](spark, sf).collect(), want)
