import json

import pytest

from matchlake.operators import eda, quality, silver
from matchlake.schemas import MATCH_DOC
from matchlake.session import scratch
from matchlake.sources import documents as source
from tests.samples import document, documents, without


def verdicts(spark, docs):
    checked = quality.classify(source.parse(documents(spark, docs)))
    return {r["match_id"]: r["error_type"] for r in checked.select("match_id", "error_type").collect()}


def ball(batter=5, extras=0, total=None):
    return {"runs": {"batter": batter, "extras": extras, "total": batter + extras if total is None else total}}


def with_balls(*balls, over=0):
    doc = document()
    doc["innings"][0]["overs"].append({"over": over, "deliveries": list(balls)})
    return doc


CASES = {
    "valid": (document(), None),
    "overs absent": (without(document(), "info", "overs"), None),
    "venue null is present": (document(venue=None), None),
    "no result may be short": (document(runs=5, outcome={"result": "no result", "winner": "Southern Stars"}), None),
    "no winner may be short": (document(runs=5), None),
    "other keys": ({"unrelated": 123}, "SCHEMA_VALIDATION"),
    "not json": ("{{", "SCHEMA_VALIDATION"),
    "cut short": (json.dumps(document())[:-30], "SCHEMA_VALIDATION"),
    "no innings": (without(document(), "innings"), "SCHEMA_VALIDATION"),
    "no venue": (without(document(), "info", "venue"), "REQUIRED_FIELDS"),
    "no match type": (without(document(), "info", "match_type"), "REQUIRED_FIELDS"),
    "teams null": (document(teams=None), "NULL_CHECK"),
    "one team": (document(teams=["Northern Lions"]), "NULL_CHECK"),
    "blank team": (document(teams=["Northern Lions", ""]), "NULL_CHECK"),
    "no dates": (document(dates=[]), "NULL_CHECK"),
    "overs text": (document(overs="twenty"), "DATATYPE_CHECK"),
    "overs null": (document(overs=None), "DATATYPE_CHECK"),
    "over too high": (with_balls(ball(), over=20), "RANGE_CHECK"),
    "over without number": (with_balls(ball(), over=None), "RANGE_CHECK"),
    "batter runs": (with_balls(ball(batter=8)), "RANGE_CHECK"),
    "extras": (with_balls(ball(extras=-1)), "RANGE_CHECK"),
    "sum": (with_balls(ball(total=9)), "INVALID_RUNS"),
    "three teams": (document(teams=["Northern Lions", "Southern Stars", "X"]), "TEAM_VALIDATION"),
    "no players": (without(document(), "info", "players"), "PLAYER_VALIDATION"),
    "empty squad": (document(players={"Northern Lions": []}), "PLAYER_VALIDATION"),
    "foreign batting team": ({**document(), "innings": [{"team": "Nobody"}]}, "REFERENTIAL_INTEGRITY"),
    "too many runs": (document(runs=565), "OUTLIER_DETECTION"),
    "too few runs": (document(runs=25, outcome={"winner": "Southern Stars"}), "OUTLIER_DETECTION"),
    "small squad": (document(players={"Northern Lions": ["a"] * 10}), "OUTLIER_DETECTION"),
    "many overs": (document(overs=25), "OUTLIER_DETECTION"),
    "few overs": (document(overs=4), "OUTLIER_DETECTION"),
}


def test_rules(spark):
    found = verdicts(spark, {k: v[0] for k, v in CASES.items()})
    assert found == {k: v[1] for k, v in CASES.items()}


def test_first_offender_is_named(spark):
    doc = with_balls(ball(), ball(batter=8), ball(batter=9))
    checked = quality.classify(source.parse(documents(spark, {"m": doc})))
    assert "8" in checked.first()["error_message"]


def test_quarantine_keeps_the_text(spark):
    checked = quality.classify(source.parse(documents(spark, {"good": document(), "bad": {"x": 1}})))
    row = quality.quarantine(checked).first()
    assert (row["source"], row["raw_record"], row["status"]) == ("bad.json", '{"x": 1}', "QUARANTINED")
    assert [r["match_id"] for r in quality.valid(checked).select("match_id").collect()] == ["good"]


def test_flat_record(spark):
    """Two innings over three overs with extras and a wicket; rained off, so without a winner."""
    def bowled(*runs, wicket_on=None):
        made = [{"batter": "a", "bowler": "b", "runs": {"batter": bat, "extras": more, "total": bat + more}} for bat, more in runs]
        if wicket_on is not None:
            made[wicket_on]["wickets"] = [{"player_out": "a", "kind": "lbw"}]
        return made

    doc = document(city=None, dates=["2021-09-30", "2021-10-01"], season="2021/22", outcome={"result": "no result"}, overs=50, match_type="ODI")
    doc["innings"] = [
        {"team": "Southern Stars", "overs": [{"over": 0, "deliveries": bowled((1, 0), (0, 2), (4, 0))}, {"over": 1, "deliveries": bowled((0, 0), (6, 1), wicket_on=0)}]},
        {"team": "Northern Lions", "overs": [{"over": 0, "deliveries": bowled((2, 0), (3, 0))}]},
    ]
    row = silver.flat_record(source.parse(documents(spark, {"rain": doc}))).first().asDict()
    want = {
        "match_id": "rain", "season": "2021", "match_date": "2021-09-30", "match_type": "ODI", "team1": "Northern Lions", "team2": "Southern Stars",
        "winner": None, "win_by_runs": None, "win_by_wickets": None, "toss_winner": None, "city": "", "player_of_match": None,
        "total_runs": 19, "total_wickets": 1, "total_overs": 3,
    }
    assert {k: row[k] for k in want} == want


def test_wickets_and_fielders(spark):
    doc = document()
    doc["innings"][0]["overs"][0]["deliveries"][1]["wickets"] = [
        {"player_out": "H0", "kind": "run out", "fielders": [{"name": "A0"}, {"name": "A1"}]},
        {"player_out": "H1", "kind": "bowled"},
    ]
    docs = source.parse(documents(spark, {"m": doc}))
    assert silver.wicket(docs).count() == 2
    assert sorted(r["player_name"] for r in silver.wicket_fielder(docs).collect()) == ["A0", "A1"]
    assert [tuple(r) for r in eda.top_bowlers(docs).collect()] == [("A0", 1)]


def test_player_identifier_survives_a_match_without_it(spark):
    first = document(registry={"people": {"H0": "id-1"}})
    later = document(dates=["2025-01-01"], registry={"people": {}})
    players = silver.player(source.parse(documents(spark, {"a": first, "b": later})))
    assert players.where("player_name = 'H0'").first()["registry_id"] == "id-1"


def test_copies_are_dropped(spark):
    text = json.dumps(document())
    rows = [("m", text)] * 500 + [("n", text)]
    df = source.one_per_match(spark.createDataFrame(rows, "match_id string, raw_data string"))
    assert df.count() == 2


def test_the_copy_that_came_last_is_kept(spark):
    schema = "match_id string, raw_data string, arrived int"
    df = spark.createDataFrame([("m", "zz first", 1), ("m", "aa corrected", 2), ("n", "x", 1)], schema)
    assert sorted(r["raw_data"] for r in source.one_per_match(df).collect()) == ["aa corrected", "x"]


def test_read_and_route(spark, tmp_path):
    (tmp_path / "1 a.json").write_text(json.dumps(document()))
    (tmp_path / "2.json").write_text("broken")
    docs = source.readable(source.parse(source.read_documents(spark, str(tmp_path))))
    assert [r["match_id"] for r in docs.collect()] == ["1 a"]
    assert source.route(docs, ["2024"], team="Southern Stars", player="A5").count() == 1
    assert source.route(docs, ["2024"], team="Delhi Capitals").count() == 0
    assert source.route(docs, ["2023"]).count() == 0


def test_staging_again_replaces(spark):
    path = scratch(spark, "stage")
    docs = source.parse(documents(spark, {"a": document(), "b": document(season="2023")}))
    source.stage(docs, path)
    source.stage(docs.where("season = '2024'"), path)
    assert {r["season"]: r["staged"] for r in source.season_counts(source.read_staged(spark, path)).collect()} == {"2023": 1, "2024": 1}


@pytest.mark.parametrize("build", [quality.valid, quality.quarantine, quality.summary, source.readable])
def test_a_document_is_parsed_once(spark, build):
    stored = scratch(spark, "docs")
    documents(spark, {"a": document()}).write.parquet(stored)
    parsed = source.parse(spark.read.schema("match_id string, raw_data string").parquet(stored))
    df = build(parsed if build is source.readable else quality.classify(parsed))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_flattening_needs_no_shuffle(spark):
    docs = source.parse(documents(spark, {"a": document()}))
    for name in silver.MATCH_TABLES:
        plan = silver.TABLES[name](docs)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Python" not in plan, name


def test_key_figures_and_team_figures_read_the_documents_once(spark, sf):
    from checks.documents import parsed

    path = scratch(spark, "eda")
    parsed(spark, sf).write.parquet(path)
    docs = spark.read.parquet(path)
    for figures in (eda.kpi(docs), eda.team_performance(docs)):
        plan = figures._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 1 and "Join" not in plan and "Union" not in plan


def test_key_figures_of_odd_documents(spark):
    empty = spark.createDataFrame([], f"match_id string, {MATCH_DOC}")
    assert tuple(eda.kpi(empty).first()) == (0,) * 8 and eda.team_performance(empty).collect() == []
    bare = spark.createDataFrame([("m", None, None)], f"match_id string, {MATCH_DOC}")
    assert tuple(eda.kpi(bare).first()) == (1, 0, 0, 0, 0, 0, 0, 0) and eda.team_performance(bare).collect() == []
