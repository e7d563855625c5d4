import random

import pytest

from matchlake.llm import qgram_leaks as G
from matchlake.llm import queries

rng = random.Random(11)
VOCAB = ["".join(rng.choice("etaoinsh") for _ in range(rng.randint(1, 8))) for _ in range(400)]
prose = lambda n: " ".join(rng.choice(VOCAB) for _ in range(n))
ITEMS = [(i, prose(rng.randint(8, 60))) for i in range(40)]


def edited(text, k):
    s = list(text)
    for _ in range(k):
        at = rng.randrange(len(s))
        s[at:at + rng.choice((0, 1))] = rng.choice(("", "x", "yz"[:1]))
    return "".join(s)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_items_within_the_budget_are_found():
    index = G.Index(ITEMS)
    for _ in range(150):
        i = rng.randrange(len(ITEMS))
        before = prose(rng.randint(0, 200))
        text = f"{before} {edited(ITEMS[i][1], rng.randint(0, int(index.edits[i]))).upper()} {prose(100)}".replace(" ", rng.choice(" \n\t"))
        regions = [r for r in G.leaks(text, index) if r[0] == i]
        assert len(regions) == 1
        _, start, end, edits, _ = regions[0]
        piece = "".join(map(chr, G.letters(text[start:end])))
        assert distance(ITEMS[i][1], piece) == edits <= index.edits[i]


def test_other_text_is_left_alone():
    index = G.Index(ITEMS)
    assert not any(G.leaks(prose(800), index) for _ in range(50))
    far = ITEMS[3][1]
    assert not G.leaks("".join(c if k % 6 else "#" for k, c in enumerate(far)), index)


def test_twice_in_one_text():
    index = G.Index(ITEMS)
    text = f"{ITEMS[5][1]} {prose(50)} {ITEMS[5][1]}"
    assert [r[1] for r in sorted(G.leaks(text, index))] == [0, len(text) - len(ITEMS[5][1])]


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, edits string")


@pytest.mark.parametrize("block", [4_000_000, 300])
def test_operator(spark, frame, odd, block, monkeypatch):
    monkeypatch.setattr(G, "BLOCK", block)
    bench = rows_of(spark, [(i, t, "x") for i, t in ITEMS] + [(90, ITEMS[7][1], "x"), (91, None, "x"), (92, "", "x"), (93, "short", "x"), (None, ITEMS[8][1], "x")])
    docs = frame(odd + [(70, "a " + ITEMS[7][1] + " b", None, None), (70, "a " + ITEMS[7][1] + " b", None, None), (71, ITEMS[8][1], "en", "a")])
    got = sorted((r.doc_id, r.item_id if r.item_id is not None else -1, r.start, r.edits) for r in G.report(docs, bench).collect())
    assert got == [(70, 7, 2, 0), (70, 7, 2, 0), (70, 90, 2, 0), (70, 90, 2, 0), (71, -1, 0, 0), (71, 8, 0, 0)]
    kept = G.clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(odd)


def test_empty(spark, frame, odd):
    none = rows_of(spark, [])
    assert G.report(frame(odd), none).collect() == [] and G.clean(frame(odd), none).count() == len(odd)
    assert G.report(frame([]), rows_of(spark, [(1, ITEMS[0][1], "x")])).collect() == []


def nearest(item, text):
    """Least edits from the item to any piece of the text: the full table."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        row, last = [i], row
        for j, y in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return min(row)


def test_exactly_the_items_within_the_budget_are_found():
    items = [(i, prose(n)) for i, n in enumerate((3, 4, 5, 6, 8, 10, 12, 16, 20))]
    items = [(i, t) for i, t in items if len(t) >= G.Q]
    index = G.Index(items)
    hits = misses = 0
    for _ in range(120):
        n = rng.randrange(len(items))
        text = f"{prose(rng.randint(0, 9))} {edited(items[n][1], rng.randint(0, int(index.edits[n]) + 2))} {prose(rng.randint(0, 9))}"
        plain = "".join(map(chr, G.letters(text)))
        got = {r[0] for r in G.leaks(text, index)}
        want = {k for k, (_, t) in enumerate(items) if nearest(t, plain) <= index.edits[k]}
        assert got == want
        hits, misses = hits + (n in want), misses + (n not in want)
    assert hits > 30 and misses > 30


def test_short_items():
    index = G.Index([(1, "what is two plus two?"), (2, "2+2"), (3, "yes"), (4, "q"), (5, "two words")])
    at = lambda text: sorted((index.ids[r[0]], r[1], r[2]) for r in G.leaks(text, index))
    assert at("So: What is\ttwo plus two? YES") == [(1, 4, 25), (3, 26, 29)]
    assert at("yesterday eyes 12+2 2+22 two wordsmiths") == []
    assert at("2+2, two\nwords (q)") == [(2, 0, 3), (4, 16, 17), (5, 5, 14)]
    assert at("what is two plus twO") == [] and at("") == []


def test_query_finds_verbatim_items(spark, sf):
    docs = {r.doc_id: r.text.lower() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: r.text.lower() for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    assert min(map(len, items.values())) >= G.Q
    want = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    got = {(r.doc_id, r.item_id) for r in queries.QUERIES["op7_benchmark_leaks"](spark, sf).collect()}
    assert want and want <= got
