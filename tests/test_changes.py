import pytest
from pyspark.sql import functions as F

from matchlake.operators import cdc, gold
from matchlake.plans import maintenance_suite, season_load
from matchlake.plans.file_table import FileTable
from matchlake.plans.publish import Conflict, Store
from matchlake.operators import maintenance
from matchlake.session import scratch
from matchlake.sources import registry
from tests.samples import document, documents


def hashes(spark, pairs):
    return spark.createDataFrame(list(pairs.items()), "business_key string, record_hash string")


def operations(changes):
    return {r["business_key"]: r["operation"] for r in changes.collect()}


def test_fingerprint(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "k string, t string")
    got = {r["business_key"]: r["record_hash"] for r in cdc.fingerprints(df, "k", "t").collect()}
    assert len(got["a"]) == 64 and got["a"] == got["b"] != got["c"]


def test_classify(spark):
    staged = hashes(spark, {"new": "1", "same": "2", "changed": "3", "removed": "6"})
    state = hashes(spark, {"same": "2", "changed": "0", "gone": "4", "never loaded": "5", "removed": "6"})
    loaded = spark.createDataFrame([("same",), ("changed",), ("gone",), ("loaded only",)], "business_key string")
    changes = cdc.classify(staged, state, loaded, complete=True)
    assert operations(changes) == {
        "new": "INSERT", "same": "SKIP", "changed": "UPDATE", "gone": "DELETE", "loaded only": "DELETE", "removed": "INSERT",
    }
    assert set(operations(cdc.classify(staged, state, loaded)).values()) == {"INSERT", "SKIP", "UPDATE"}
    scoped = loaded.withColumn("in_scope", F.col("business_key") != "gone")
    unreadable = spark.createDataFrame([("loaded only",)], "business_key string")
    assert "DELETE" not in operations(cdc.classify(staged, state, scoped, True, unreadable)).values()
    after = {r["business_key"]: r["record_hash"] for r in cdc.state_after(state, changes).collect()}
    assert after == {"new": "1", "same": "2", "changed": "3", "never loaded": "5", "removed": "6"}


def test_copies_do_not_multiply(spark):
    staged = spark.createDataFrame([("a", "1")] * 300 + [("b", "2")], "business_key string, record_hash string")
    nothing = staged.where("false")
    assert cdc.classify(staged, nothing, nothing.select("business_key")).count() == 2


@pytest.fixture()
def store(spark):
    return Store(spark, scratch(spark, "store"))


def facts(store):
    return {r["match_id"]: r["total_runs"] for r in store.read("fact_match_summary").collect()}


def test_load_again_with_changes(spark, store):
    first = {"a": document(), "b": document(), "old": document(season="2023"), "bad": {"x": 1}}
    done = season_load.load(store, documents(spark, first), "v1")
    assert done.counts["inserted"] == 3 and done.seasons == ["2023", "2024"]
    assert facts(store) == {"a": 35, "b": 35, "old": 35}

    unchanged = season_load.load(store, documents(spark, first), "v2")
    assert unchanged.seasons == [] and unchanged.counts["skipped"] == 3
    assert store.current()["2024"] == "v1"

    second = {"a": document(runs=100), "c": document(), "old": document(season="2023")}
    done = season_load.load(store, documents(spark, second), "v3", complete=True)
    assert {k: done.counts[k] for k in ("inserted", "updated", "deleted", "skipped")} == {
        "inserted": 1, "updated": 1, "deleted": 1, "skipped": 1,
    }
    assert facts(store) == {"a": 100, "c": 35, "old": 35}
    # the untouched season still points at the first version
    assert store.current() == {"2023": "v1", "2024": "v3", "all": "v3"}
    assert store.read("delivery").count() == (100 + 35 + 35) // 5
    team = store.read("dim_team").where("team_name = 'Northern Lions'").first()
    assert (team["matches_played"], team["total_runs"]) == (3, 170)
    assert store.read("lakehouse").count() == 3


def test_filtered_snapshot_deletes_nothing(spark, store):
    season_load.load(store, documents(spark, {"a": document(), "b": document()}), "v1")
    done = season_load.load(store, documents(spark, {"a": document(runs=100)}), "v2")
    assert done.counts["deleted"] == 0
    assert facts(store) == {"a": 100, "b": 35}


def test_snapshot_speaks_for_its_seasons(spark, store):
    season_load.load(store, documents(spark, {"a": document(), "b": document(), "old": document(season="2023")}), "v1")
    done = season_load.load(store, documents(spark, {"a": document()}), "v2", complete=True)
    assert done.counts["deleted"] == 1 and facts(store) == {"a": 35, "old": 35}


def test_broken_update_keeps_the_good_version(spark, store):
    season_load.load(store, documents(spark, {"a": document(), "b": document()}), "v1")
    broken = {"a": document(teams=["one"]), "b": "{cut"}
    done = season_load.load(store, documents(spark, broken), "v2", complete=True)
    assert (done.counts["deleted"], done.counts["failed"]) == (0, 2) and facts(store) == {"a": 35, "b": 35}


def test_logs_hold_all_runs(spark, store):
    season_load.load(store, documents(spark, {"a": document(), "cut": "{", "bad": {"x": 1}}), "v1")
    season_load.load(store, documents(spark, {"a": document(), "late": "{{"}), "v2")
    kept = sorted((r["run"], r["source"], r["season"]) for r in store.read_log("quarantine_records").collect())
    assert kept == [("v1", "bad.json", "unrouted"), ("v1", "cut.json", "unrouted"), ("v2", "late.json", "unrouted")]
    log = sorted((r["run_id"], r["business_key"], r["operation"]) for r in store.read_log("cdc_log").collect())
    assert log == [("v1", "a", "INSERT"), ("v2", "a", "SKIP")]
    stages = [(r["case_id"], r["activity"], r["status"], r["records_processed"]) for r in store.read_log("process_events").orderBy("case_id", "event_id").collect()]
    assert stages == [
        ("v1", "validation", "SUCCESS", 3), ("v1", "cdc", "SUCCESS", 1), ("v1", "silver", "SUCCESS", 1), ("v1", "gold", "SUCCESS", 1),
        ("v1", "lakehouse", "SUCCESS", 1), ("v2", "validation", "SUCCESS", 2), ("v2", "cdc", "SUCCESS", 1),
    ]
    status = {r["season"]: r["gold_status"] for r in season_load.stage_status(season_load.stage_events(store)).collect()}
    assert status["2024"] == "SUCCESS"


def test_deleted_season_comes_back(spark, store):
    docs = documents(spark, {"a": document(), "old": document(season="2023")})
    season_load.load(store, docs, "v1")
    season_load.delete_season(store, "2023", "d1")
    played = lambda: store.read("dim_team").where("team_name = 'Northern Lions'").first()["matches_played"]
    assert facts(store) == {"a": 35} and played() == 1
    done = season_load.load(store, docs, "v2")
    assert done.counts["inserted"] == 1 and facts(store) == {"a": 35, "old": 35} and played() == 2


def test_conflicting_runs(spark, store):
    season_load.load(store, documents(spark, {"a": document()}), "v1")
    parent = store.head()
    store.commit("other", ["2024"], parent=parent)
    with pytest.raises(Conflict):
        store.commit("late", ["2024"], parent=parent)
    assert store.current()["2024"] == "other"
    with pytest.raises(RuntimeError):
        store.require("no_such_table", {"2024": "v1"})


def test_sums_beyond_four_bytes(spark):
    big = spark.createDataFrame([("T", 1, 1, 3_000_000_000, 5, 7)], "team_name string, matches_played long, wins long, total_runs long, total_boundaries long, total_sixes long")
    both = big.unionByName(big)
    assert gold.team_dimension_from(both.select("team_name"), both).first()["total_runs"] == 6_000_000_000


def test_failed_run_changes_nothing(spark, store, monkeypatch):
    season_load.load(store, documents(spark, {"a": document()}), "v1")
    monkeypatch.setattr(season_load.gold, "team_dimension_from", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        season_load.load(store, documents(spark, {"a": document(runs=100)}), "v2")
    monkeypatch.undo()
    assert facts(store) == {"a": 35}
    failed = store.read_log("process_events").where("status = 'FAILED'").collect()
    assert [(r["case_id"], r["activity"]) for r in failed] == [("v2", "gold")] and "ZeroDivision" in failed[0]["error_message"]
    done = season_load.load(store, None, "v2", resume=True)
    assert done.counts["updated"] == 1 and facts(store) == {"a": 100}
    runs = {r["version"]: (r["status"], r["counts"]["updated"]) for r in store.runs().collect()}
    assert runs == {"v1": ("SUCCESS", 0), "v2": ("SUCCESS", 1)}


def test_season_delete_and_maintenance(spark, store):
    season_load.load(store, documents(spark, {"a": document(), "old": document(season="2023")}), "v1")
    assert season_load.delete_season(store, "2023", "d1") == 1
    assert facts(store) == {"a": 35}
    assert season_load.delete_season(store, "1900", "d2") == 0
    store.write("match", store.read("match"), "abandoned")
    lake = FileTable(spark, scratch(spark, "lake"))
    lake.append(store.read("lakehouse"))
    steps = maintenance_suite.run(lake, "2100-01-01 00:00:00", store, apply=True)
    done = {r["step"]: r["affected"] for r in steps.collect()}
    assert done["orphan_cleanup"] == 1
    left = maintenance.list_files(spark, store.root).where(F.col("path").contains("abandoned")).count()
    assert left == 0 and facts(store) == {"a": 35}


def test_registry(spark, tmp_path):
    (tmp_path / "a.json").write_text("1")
    (tmp_path / "b.json").write_text("2")
    found = registry.scan_files(spark, str(tmp_path))
    empty = found.where("false").withColumn("status", F.lit(""))
    first = registry.register(found, empty)
    assert first.count() == 2
    known = spark.createDataFrame(first.collect(), first.schema)
    (tmp_path / "b.json").write_text("changed")
    again = registry.scan_files(spark, str(tmp_path))
    assert [r["source_name"] for r in registry.unregistered(again, known).collect()] == ["b.json"]
    assert registry.register(again, known).count() == 2
