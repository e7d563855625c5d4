"""Fill-in-middle against a plain string version; restoring must give back every text."""

import hashlib
import re
from collections import Counter
from functools import partial

import pytest

from matchlake.llm import fill_middle as M


def brute(rows, rate=100):
    out = []
    for d, t, *_ in rows:
        t = t or ""
        units = re.findall(r"[^\n]*\n|[^\n]+", t)
        n, digest = len(units), hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()
        h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
        a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
            out.append((d, n, "plain", None, None, t, t))
        elif h[3] % 100 < 50:
            out.append((d, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", t))
        else:
            out.append((d, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", t))
    return Counter(out)


def digests(want):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return Counter({(*r[:5], sha(r[5]), sha(r[6])): k for r, k in want.items()})


def counted(df):
    return Counter(tuple(r) for r in df.collect())


TEXTS = [
    "one\ntwo\nthree\n", "\n", "\n\n\nx", "no end", "a <P> b\nc", "<M>", "<S", "é\n😀😀\nß\n" * 40, "<P\n>\nx", "x" * 500 + "\ny", "\r\n\x85\n", "a\x00b\nc",
]


@pytest.mark.parametrize("chunk", [1 << 16, 7])
def test_texts(frame, odd, chunk):
    rows = [(100 * i + k, t, "en", "a") for i, t in enumerate(TEXTS) for k in range(8)]
    rows += [r for r in odd if chunk > 100 or len(r[1] or "") < 1000]
    rows += [(None, "same\nrow\n", None, None)] * 30 + [(7, "same\nrow\n", None, None)] * 30
    docs, want = frame(rows), brute(rows)
    assert counted(M.transformed(docs, size=chunk)) == want
    assert counted(M.report(docs, size=chunk)) == digests(want)
    assert {r[2] for r in want} == {"plain", "psm", "spm"}


def test_rate(frame):
    rows = [(i, f"a\nb{i}\nc", None, None) for i in range(300)]
    assert counted(M.transformed(frame(rows), rate=40)) == brute(rows, 40)


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert counted(M.report(docs)) == digests(brute(rows))


def test_pieces_are_whole_lines_and_bounded():
    text = b"".join(b"line %d\n" % i for i in range(5000)) + b"z" * 200_000 + b"\nend"
    ends = M.line_ends(text)
    pieces = list(M.chunks(text, ends, 0, len(text)))
    assert b"".join(pieces) == text and max(map(len, pieces)) <= M.CHUNK
    assert all(p.endswith(b"\n") or set(p) == {ord("z")} for p in pieces[:-1])


def test_original_order_follows_from_the_output_alone():
    """Restoring looks at the form and the pieces of the output, nothing else."""
    pieces = [b"<S>5\n", b"6\n", b"<P>", b"<M>3\n", b"4\n"]
    assert [p for _, p in sorted(M.original("spm", pieces))] == [b"3\n", b"4\n", b"5\n", b"6\n"]


def test_empty(frame):
    assert M.report(frame([])).collect() == M.transformed(frame([])).collect() == []


def test_sort_is_by_partition_and_not_by_text(spark, frame):
    """Copies of one text and rows without an id are dealt over partitions."""
    rows = [(i, "copy\nof\na text\n", None, None) for i in range(400)]
    pairs = M.emitted(0, [(d, t.encode()) for d, t, *_ in rows], rate=100, spm_rate=50, size=7)
    assert len({M.dealt(k) % 16 for k, _ in pairs}) == 16


def test_one_shuffle(spark, frame):
    """The second sort finds its partitioning in place."""
    rows = frame([(i, f"a\nb{i}\nc", None, None) for i in range(50)]).select("doc_id", "text").rdd
    how = {"rate": 100, "spm_rate": 50, "size": 100}
    once = rows.mapPartitionsWithIndex(partial(M.emitted, **how)).repartitionAndSortWithinPartitions(4, M.dealt)
    back = M.outputs(once, False)
    assert back.partitionBy(4, M.dealt) is back
