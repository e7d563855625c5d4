import re
from collections import Counter

import numpy as np

from matchlake.llm import quality_mcd as Q
from matchlake.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
    }


def verdicts(rows):
    """The whole estimate in numpy, group by group."""
    stats = [counted(t) for _, t, _, _ in rows]
    failed = [s["n_words"] < 10 or 100 * s["n_repeat_words"] > 20 * s["n_words"] for s in stats]
    x = np.array([[
        np.log(max(s["word_chars"], 1) / max(s["n_words"], 1)), np.sqrt(s["n_symbols"] / max(s["word_chars"], 1)),
        s["n_dup_lines"] / max(s["n_lines"], 1), s["n_repeat_words"] / max(s["n_words"], 1),
    ] for s in stats])
    x = np.round(x * Q.SCALE) / Q.SCALE
    cells = Counter((r[2], r[3]) for r, f in zip(rows, failed) if not f)
    pool = Counter()
    for (lang, _), n in cells.items():
        pool[lang] += n if n < Q.SMALL else 0
    name = lambda r: (r[2], r[3]) if cells[r[2], r[3]] >= Q.SMALL else (("pool", r[2]) if pool[r[2]] >= Q.SMALL else "all")
    floor2 = np.diag(np.square(Q.FLOOR))
    kept = [False] * len(rows)
    for g in {name(r) for r, f in zip(rows, failed) if not f}:
        at = [i for i, r in enumerate(rows) if not failed[i] and name(r) == g]
        v = x[at]
        quant = lambda q: np.sort(v, axis=0)[int(np.ceil(len(v) * q)) - 1]
        mid, spread = quant(0.5), np.maximum((quant(0.75) - quant(0.25)) / 1.349, Q.FLOOR)
        z = (v - mid) / spread
        results = []
        for turned in (np.tanh(z), z / np.sqrt((z * z).sum(1, keepdims=True) + 1e-12)):
            c = np.cov(turned.T, bias=True)
            d = np.sqrt(np.diag(c) + 1e-6)
            m, s = mid, c / np.outer(d, d) * np.outer(spread, spread) + floor2
            for _ in range(Q.STEPS):
                dist = np.einsum("ij,jk,ik->i", v - m, np.linalg.inv(s), v - m)
                bins = np.floor(np.log(np.maximum(dist, 1e-6)) * Q.BINS)
                near = v[bins <= np.sort(bins)[int(np.ceil(len(v) * Q.COVER)) - 1]]
                m, s = near.mean(0), np.cov(near.T, bias=True) * Q.CONSISTENCY + floor2
            results.append((np.linalg.det(s), m, s))
        _, m, s = min(results, key=lambda r: r[0])
        dist = np.einsum("ij,jk,ik->i", v - m, np.linalg.inv(s), v - m)
        for i, d in zip(at, dist):
            kept[i] = bool(d <= Q.CUTOFF)
    return stats, failed, kept


def agree(docs, rows):
    stats, failed, kept = verdicts(rows)
    want = Counter((r[0], *[s[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], f, k)
                   for r, s, f, k in zip(rows, stats, failed, kept))
    got = Counter(tuple(r)[:7] + (r.kept,) for r in Q.report(docs).collect())
    assert got == want


def test_odd_rows(frame, odd):
    rows = odd + [(20, "a b c d e f a b c d e g h", "en", "a"), (21, "x\ny\nx\nx\n \n", "en", "a"), (22, "a a a a a a a a a a a", "de", "b")]
    agree(frame(rows), rows)


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    agree(docs, [tuple(r)[:4] for r in docs.select("doc_id", "text", "lang", "source").collect()])


def test_junk_goes_and_prose_stays(spark, sf):
    got = queries.QUERIES["op2_quality_mcd"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    by = {q: [r.kept for r in got.where(f"quality = {q} and not base_failed").collect()] for q in (0, 1)}
    assert np.mean(by[1]) > 0.98 and np.mean(by[0]) < 0.1


def test_keep_returns_the_documents(frame, odd):
    docs = frame(odd)
    got = Q.keep(docs)
    assert got.schema == docs.schema
    want = Counter(r.doc_id for r in Q.report(docs).where("kept").collect())
    assert Counter(r.doc_id for r in got.collect()) == want


def test_empty(frame):
    assert Q.report(frame([])).collect() == [] and Q.keep(frame([])).collect() == []
