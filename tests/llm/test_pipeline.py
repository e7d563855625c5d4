"""Each stage of the pipeline against brute force on its own input."""

from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline as P
from tests.llm import test_mixing, test_near_copies, test_quality_mcd, test_spans

COLUMNS = ["doc_id", "text", "lang", "source"]


@pytest.fixture(scope="module")
def kept(spark, sf, tmp_path_factory):
    """The documents after each stage, the input first."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    out.append(docs)
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def rows(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def test_quality(kept):
    before = rows(kept[0])
    _, _, good = test_quality_mcd.verdicts(before)
    assert Counter(rows(kept[1])) == Counter(r for r, k in zip(before, good) if k)


def test_near_duplicates(kept):
    want = test_near_copies.brute([r[:2] for r in rows(kept[1])])
    assert Counter(r[0] for r in rows(kept[2])) == want
    assert set(rows(kept[2])) <= set(rows(kept[1]))


def test_decontamination(spark, sf, kept):
    items = [r.text.lower() for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = [r for r in rows(kept[2]) if not any(i in r[1].lower() for i in items)]
    assert Counter(rows(kept[3])) == Counter(want)


def test_personal_data(kept):
    before = {r[0]: r[1] for r in rows(kept[3])}
    for d, text, *_ in rows(kept[4]):
        spans = test_spans.base(before[d], test_spans.PII)
        assert (text == before[d]) == (not spans)
        assert all(before[d][a:b] not in text for _, a, b in spans)
    assert all(r.n_chars == len(r.text) for r in kept[4].collect())


def test_mixture(kept):
    want = Counter({d: t for d, *_, t in test_mixing.brute(rows(kept[4])) if t})
    got = Counter()
    for r in kept[5].collect():
        got[r.doc_id] += r.mix_words
    assert got == want


def test_columns_and_registration(kept):
    assert all(df.columns == kept[0].columns for df in kept[:-1])
    assert kept[-1].columns == [*kept[0].columns, "mix_copy", "mix_words"]
    assert entry.queries()["pipeline"] is P.run and "pipeline" not in entry.oracle_sql()


def test_odd_rows_and_empty_tables(spark, sf, frame, odd):
    for data in (odd, []):
        docs = frame(data)
        for name, stage in P.STAGES:
            docs = stage(spark, docs, sf)
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns[: len(frame([]).columns)] == frame([]).columns
