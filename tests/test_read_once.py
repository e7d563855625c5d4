"""Documents are built once for queries that go through them several times; a bucketed load moves them once."""

import pytest

from checks import changes, documents as D, loads
from matchlake.plans import bucket_load
from matchlake.plans.bucket_store import BucketStore
from matchlake.session import Workspace, scratch
from matchlake.sources import adapters
from tests.samples import document, documents


@pytest.mark.parametrize("query", [loads.load_partial_snapshot, changes.silver_reload_idempotent, D.stage_counts], ids=lambda q: q.__name__)
def test_documents_are_read_as_a_table(spark, sf, monkeypatch, query):
    built, build = [], adapters.documents
    monkeypatch.setattr(adapters, "documents", lambda *a, **k: (built.append(a), build(*a, **k))[1])
    seen, read = [], adapters.table
    monkeypatch.setattr(adapters, "table", lambda s, d, name: (seen.append(name), read(s, d, name))[1])
    query(spark, sf).collect()
    assert len(built) == 1 and seen.count("lineitem") == 1


def test_stored_documents_are_the_same(spark, sf):
    for defects in (False, True):
        built, stored = adapters.documents(spark, sf, defects), adapters.stored_documents(spark, sf, defects)
        assert built.columns == stored.columns and sorted(built.collect()) == sorted(stored.collect())


def test_a_bucketed_load_moves_documents_once(spark, monkeypatch):
    plans, write = [], Workspace.written

    def written(self, df, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, df, **options)

    monkeypatch.setattr(Workspace, "written", written)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store = BucketStore(spark, scratch(spark, "moved"), buckets=2)
        bucket_load.load(store, documents(spark, {"a": document(), "b": document()}), "v1")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the documents' side and the keys' side, one exchange each
    assert plans[2].count("Exchange hashpartitioning") == 2
    assert store.read(bucket_load.FACT).count() == 2
