"""Remembered hashes as base and deltas."""

import pytest
from pyspark.sql import functions as F

from matchlake.plans.hash_state import HashState
from matchlake.plans.publish import Conflict
from matchlake.session import scratch


@pytest.fixture
def state(spark):
    return HashState(spark, scratch(spark, "state"), buckets=4, fold_at=0.5)


def staged(spark, rows):
    return spark.createDataFrame(rows, "scope string, business_key string, record_hash string")


def run(spark, state, rows, scopes, complete=False):
    found = state.changes(staged(spark, rows), scopes, complete)
    counts = {r.operation: r["count"] for r in found.groupBy("operation").count().collect()}
    state.apply(found)
    return counts


def held(state, scopes=None):
    return {(r.scope, r.business_key): r.record_hash for r in state.read(scopes).collect()}


def test_runs(spark, state):
    first = [(s, f"{s}{i}", f"h{i}") for s in ("a", "b") for i in range(40)] + [(None, "x", "hx")]
    assert run(spark, state, first, ["a", "b", "none"]) == {"INSERT": 81}
    assert run(spark, state, first, ["a", "b", "none"], True) == {"SKIP": 81}
    head = state.head()
    part = [("a", "a1", "new"), ("a", "a99", "h99")]
    assert run(spark, state, part, ["a"]) == {"UPDATE": 1, "INSERT": 1}
    # only the touched buckets of the scope are in the new commit, and nothing was folded
    written = state.commits().where(F.col("number") > head)
    assert {r.scope for r in written.collect()} == {"a"} and written.count() <= 2 and not written.where("base").count()
    want = {(s or "none", k): h for s, k, h in first} | {("a", "a1"): "new", ("a", "a99"): "h99"}
    assert held(state) == want and held(state, ["b"]) == {k: h for k, h in want.items() if k[0] == "b"}
    # a complete snapshot of one scope deletes there only; its entries are folded
    kept = [("b", f"b{i}", f"h{i}") for i in range(10)]
    assert run(spark, state, kept, ["b"], True) == {"SKIP": 10, "DELETE": 30}
    want = {k: h for k, h in want.items() if k[0] != "b"} | {(s, k): h for s, k, h in kept}
    assert held(state) == want
    folded = state.entries(["b"]).where("base").select("bucket", "rows", "number").collect()
    assert {r.number for r in folded if r.number == state.head()} and state.entries(["a"]).where("base").agg(F.max("number")).first()[0] < state.head()
    assert all(r.rows == sum(1 for x in state.read(["b"]).selectExpr(f"pmod(xxhash64(business_key), 4) = {r.bucket} AS here").collect() if x.here)
               for r in folded if r.number == state.head())
    # a deleted key may come back
    assert run(spark, state, [("b", "b39", "again")], ["b"]) == {"INSERT": 1}
    assert held(state)["b", "b39"] == "again"


def test_only_the_scopes_entries_are_read(spark, state):
    run(spark, state, [(s, f"{s}{i}", "h") for s in ("a", "b") for i in range(40)], ["a", "b"])
    plan = state._rows(state.entries(["b"]))._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("PushedFilters")[0]
    assert "(scope#" in filters and "= b)" in filters and "= a)" not in filters and "bucket#" in filters


def test_an_old_start_is_refused(spark, state):
    head = state.head()
    found = state.changes(staged(spark, [("a", "1", "x")]), ["a"])
    state.apply(found, head)
    with pytest.raises(Conflict):
        state.apply(state.changes(staged(spark, [("a", "2", "y")]), ["a"]), head)
    assert held(state) == {("a", "1"): "x"}


def test_without_its_commit_a_run_is_invisible(spark, state):
    run(spark, state, [("a", "1", "x")], ["a"])
    number = state.head() + 1
    left = state._placed(staged(spark, [("a", "2", "y")]))
    left.write.partitionBy("scope", "bucket").parquet(f"{state.root}/rows/number={number}")
    assert held(state) == {("a", "1"): "x"}
    run(spark, state, [("a", "3", "z")], ["a"])
    assert held(state) == {("a", "1"): "x", ("a", "3"): "z"}


def test_an_empty_run_commits_nothing(spark, state):
    assert run(spark, state, [], ["a"], True) == {} and state.head() == 0 and held(state) == {}
