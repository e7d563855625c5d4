"""What a load moves between tasks, and what it leaves on the disks of the executors."""

import json

from pyspark.sql import functions as F

from matchlake.plans import season_load
from matchlake.plans.publish import Store
from matchlake.session import CLEANUP, scratch, shuffles_dropped
from matchlake.sources import documents as source
from tests.samples import document, documents


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def test_documents_are_parsed_after_their_move(spark):
    plan = season_load.judge(documents(spark, {"a": document(), "b": "{"}), by_season=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RebalancePartitions") == 1 and plan.count("from_json") == 1
    # what stands further down is done before
    assert plan.index("from_json") < plan.index("RebalancePartitions")


def test_the_load_does_not_move_parsed_documents(spark, monkeypatch):
    store, moved = Store(spark, scratch(spark, "moves")), []
    write = Store.write
    monkeypatch.setattr(Store, "write", lambda self, table, df, version, rebalance=True: (moved.append((table, rebalance)), write(self, table, df, version, rebalance))[1])
    season_load.load(store, documents(spark, {"a": document(), "b": document(season="2023"), "cut": "{"}), "v1")
    assert ("checked", False) in moved


def test_gathering_keeps_every_row(spark):
    texts = [json.dumps(document(season="2020/21")), json.dumps(document(season=None)), '{"info": {"season" : 2019}}', "", None, "no json", "{"]
    rows = spark.createDataFrame([(str(i), t, i) for i, t in enumerate(texts)], "match_id string, raw_data string, more int")
    kept = source.gathered(rows)
    assert kept.columns == rows.columns and sorted(map(str, kept.collect())) == sorted(map(str, rows.collect()))
    years = rows.select(F.regexp_extract("raw_data", source.STATED_YEAR, 1).alias("y"))
    assert [r.y for r in years.collect()] == ["2020", "2024", "2019", "", None, "", ""]


def test_a_run_leaves_no_shuffle_files(spark):
    before, store = shuffle_files(spark), Store(spark, scratch(spark, "left"))
    rows = spark.range(1000).selectExpr("id", "CAST(id % 3 AS STRING) AS season")
    store.write("a", rows, "v1")
    store.write_all({"b": rows, "c": rows.groupBy("season").count()}, "v1")
    store.append_log("d", rows.groupBy("season").count(), "v1")
    assert shuffle_files(spark) <= before


def test_the_setting_is_put_back(spark):
    before = spark.conf.get(CLEANUP)
    with shuffles_dropped(spark):
        assert spark.conf.get(CLEANUP) == "true"
    assert spark.conf.get(CLEANUP) == before
