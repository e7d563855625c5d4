"""Loads into cells of season and bucket."""

import pytest
from pyspark.sql import functions as F

from matchlake.operators import gold, silver
from matchlake.plans import bucket_load
from matchlake.plans.bucket_store import BucketStore
from matchlake.plans.publish import Conflict
from matchlake.plans.season_load import judge
from matchlake.session import scratch
from matchlake.sources import adapters

DIGIT = "CAST(match_id AS BIGINT) % 50"


@pytest.fixture(scope="module")
def docs(spark, sf):
    path = scratch(spark, "docs")
    adapters.documents(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def loaded(spark, docs):
    """A store after a first load and an increment of some matches."""
    store = BucketStore(spark, scratch(spark, "cells"), buckets=4)
    first = bucket_load.load(store, docs.where(f"{DIGIT} <> 7"), "run-1")
    before = store.current()
    second = bucket_load.load(store, docs.where(f"{DIGIT} = 7 and season_hint = '1996'"), "run-2")
    return store, first, before, second


def test_only_touched_cells_are_written(spark, loaded, docs):
    store, first, before, second = loaded
    added = docs.where(f"{DIGIT} = 7 and season_hint = '1996'").select("match_id", store.bucket().alias("b")).collect()
    assert second.counts["INSERT"] == len(added) > 0
    assert second.cells == sorted({("1996", r.b) for r in added})
    after = store.current()
    changed = {cell for cell in after if after[cell] != before.get(cell)}
    assert changed == set(second.cells) and set(before) - changed
    kept = docs.where(f"{DIGIT} <> 7 or season_hint = '1996'")
    names = lambda df: sorted(r.match_id for r in df.select("match_id").collect())
    assert names(store.read("match")) == names(judge(kept).where("error_type is null"))
    wrote = spark.read.parquet(f"{store.root}/delivery").where(F.col("version") == second.version)
    assert {(r.season, r.bucket) for r in wrote.select(F.col("season").cast("string").alias("season"), "bucket").distinct().collect()} <= changed


def test_stored_rows_meet_without_a_shuffle(spark, loaded):
    store = loaded[0]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = gold.match_summary(*[store.read(t) for t in ("match", "delivery", "wicket")])
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan and "Exchange" not in plan
        touched = spark.createDataFrame([("7",), ("107",)], "match_id string").withColumn("old_season", F.lit("1996"))
        kept = store.read("delivery").join(touched, "match_id", "left_anti")
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1  # of the keys, not of the stored rows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_folders_of_other_cells_are_not_opened(loaded):
    store = loaded[0]
    cell, version = sorted(store.current().items())[0]
    files = store.read("delivery", {cell: version}).inputFiles()
    assert files and all(f"season={cell[0]}/bucket={cell[1]}/version={version}" in f for f in files)


def test_gold_equals_a_whole_computation(loaded):
    store = loaded[0]
    matches, deliveries, wickets = [store.read(t).drop("bucket") for t in ("match", "delivery", "wicket")]
    rows = lambda df: sorted(map(str, (r.asDict() for r in df.collect())))
    assert rows(store.read(bucket_load.FACT).drop("bucket")) == rows(gold.match_summary(matches, deliveries, wickets).select(*store.read(bucket_load.FACT).drop("bucket").columns))
    players = store.read("team_squad").select("player_name").distinct()
    assert rows(bucket_load.player_dimension(store)) == rows(gold.player_dimension(players, deliveries, wickets))
    teams = matches.select(F.explode(F.array("team1", "team2")).alias("team_name"))
    assert rows(bucket_load.team_dimension(store)) == rows(gold.team_dimension(teams, matches, deliveries))


def test_changes_moves_and_deletes(spark, docs):
    store = BucketStore(spark, scratch(spark, "cells"), buckets=4)
    some = docs.where("season_hint in ('1996', '1997') and CAST(match_id AS BIGINT) % 10 < 3")
    some = judge(some).where("error_type is null").select("match_id", F.col("season").alias("season_hint"), "raw_data").persist()
    total = bucket_load.load(store, some, "run-1").counts["INSERT"]
    head = store.head()
    assert bucket_load.load(store, some, "run-2", complete=True).cells == [] and store.head() == head
    one = some.where("season_hint = '1996'").orderBy("match_id").first()
    # to another season; the text is valid, and the old season has lost the match
    moved = spark.createDataFrame([(one.match_id, one.raw_data.replace("1996", "1997"))], "match_id string, raw_data string")
    got = bucket_load.load(store, moved, "run-3")
    assert got.counts == {"UPDATE": 1, "FAILED": 0} and {s for s, _ in got.cells} == {"1996", "1997"} and len({b for _, b in got.cells}) == 1
    assert [r.season for r in store.read("match").where(F.col("match_id") == one.match_id).collect()] == ["1997"]
    assert store.read("match").count() == store.read("lakehouse").count() == store.read(bucket_load.HASHES).count() == total
    # a complete snapshot of 1996 without some matches, one of them there but broken
    left = some.where("season_hint = '1996'").where(F.col("match_id") != one.match_id).select("match_id", "raw_data")
    broken, lost = [r.match_id for r in left.orderBy("match_id").limit(2).collect()]
    cut = F.when(F.col("match_id") == broken, F.lit("{")).otherwise(F.col("raw_data"))
    snapshot = left.where(F.col("match_id") != lost).withColumn("raw_data", cut)
    got = bucket_load.load(store, snapshot, "run-4", complete=True)
    assert got.counts["DELETE"] == 1 and got.counts["FAILED"] == 1
    ids = {r.match_id for r in store.read("match").collect()}
    assert len(ids) == total - 1 and broken in ids and lost not in ids
    for table in silver.MATCH_TABLES:
        assert not store.read(table).where(F.col("match_id") == lost).count()


def test_another_session_reads_the_folder(spark, loaded):
    store = loaded[0]
    other, held = BucketStore(spark, store.root, store.buckets), store.read("toss").count()
    spark.sql(f"DROP TABLE {store._name('toss')}")
    assert other.read("toss").count() == held > 0


def test_an_old_start_is_refused(loaded):
    store = loaded[0]
    with pytest.raises(Conflict):
        store.commit("late-1", [("1996", 0)], store.head() - 1)
