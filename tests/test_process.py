import random

import pytest
from pyspark.sql import functions as F

from matchlake.constants import STAGE_SEQUENCE
from matchlake.operators import process_anomalies as anomalies
from matchlake.operators import process_metrics as metrics
from matchlake.operators import process_reports as reports
from matchlake.session import scratch
from matchlake.sources import events as event_log
from tests.samples import events, nightly_run


def test_overlapping_run(spark):
    run = events(spark, nightly_run())
    cycle, lead = metrics.cycle_time(run).select("cycle_time_seconds", "lead_time_seconds").first()
    assert (cycle, lead) == (50.0, 50.0)
    assert {r["activity"]: r["duration_seconds"] for r in metrics.stage_durations(run).collect()} == {"bronze": 12.0, "staging": 21.0, "gold": 6.0}
    assert [r["activity"] for r in metrics.bottlenecks(run).collect()] == ["staging", "bronze", "gold"]
    summary = metrics.process_summary(run).first()
    # 100 records in 50 seconds
    assert (summary["primary_bottleneck"], summary["total_records"], summary["event_count"], summary["throughput_rps"]) == ("staging", 100, 3, 2.0)


def test_no_events(spark):
    nothing = events(spark, nightly_run()).where("false")
    assert metrics.cycle_time(nothing).first()["cycle_time_seconds"] == 0.0
    assert metrics.sla_compliance(nothing).first()["compliance_pct"] == 100.0
    summary = metrics.process_summary(nothing).first()
    assert (summary["primary_bottleneck"], summary["total_records"], summary["event_count"]) == ("none", 0, 0)
    assert anomalies.all_anomalies(nothing).count() == 0


def test_sla_breach(spark):
    found = anomalies.sla_breaches(events(spark, [{"activity": "staging", "seconds": 40.0}]), {"staging": 25.0}).collect()
    assert [(r["type"], r["activity"], r["actual_seconds"]) for r in found] == [("SLA_BREACH", "staging", 40.0)]


def test_event_without_end_counts_with_its_start(spark):
    rows = [{"activity": "bronze", "at": 0, "seconds": 5.0}, {"activity": "gold", "at": 60, "seconds": 20.0}]
    assert metrics.cycle_time(events(spark, rows)).first()["cycle_time_seconds"] == 60.0


def test_out_of_sequence(spark):
    found = anomalies.out_of_sequence(events(spark, [{"activity": "silver", "at": 0}, {"activity": "validation", "at": 10}]))
    row = anomalies.expand_order(found).first()
    assert (row["type"], row["activity"], row["observed_order"]) == ("OUT_OF_SEQUENCE", "validation", ["silver", "validation"])


def test_seasons_in_a_row_are_fine(spark):
    rows = [
        {"activity": a, "season": s, "at": at}
        for at, (a, s) in enumerate([("bronze", "2011"), ("gold", "2011"), ("bronze", "2012"), ("gold", "2012")])
    ]
    assert anomalies.out_of_sequence(events(spark, rows)).count() == 0


def test_duplicates(spark):
    rows = [{"activity": "copy_archive"}, {"activity": "copy_archive"}]
    found = anomalies.duplicates(events(spark, rows), allow_retries=False).collect()
    assert [(r["type"], r["execution_count"]) for r in found] == [("DUPLICATE_ACTIVITY", 2)]
    running = [{"activity": "odd", "status": "RUNNING"}, {"activity": "odd", "status": "SUCCESS"}]
    assert anomalies.duplicates(events(spark, running)).count() == 0


@pytest.mark.parametrize("pair, illegal", [(("validation", "quarantine"), 0), (("bronze", "gold"), 1), (("gold", "bronze"), 0), (("unheard", "gold"), 0)])
def test_deviations(spark, pair, illegal):
    rows = [{"activity": a, "at": 5 * i} for i, a in enumerate(pair)]
    assert anomalies.deviations(events(spark, rows)).count() == illegal


def late_events(rows):
    """(event, its order) of every event that follows a later stage of its own cycle, by looking back.

    A cycle begins at an event that names another season than the case did before, or at one of the
    first two stages once the cycle before has reached one of the last two.
    """
    place = {stage: n for n, stage in enumerate(STAGE_SEQUENCE)}
    key = lambda e: (e["case_id"], e["at"], place[e["activity"]], e["event_id"])
    line = sorted((e for e in rows if e["activity"] in place), key=key)
    begins = []

    def back(i):
        """Events of the same case before the i-th, the nearest first."""
        return (k for k in range(i - 1, -1, -1) if line[k]["case_id"] == line[i]["case_id"])

    def cycle(i):
        """Events before the i-th in its cycle, the nearest first."""
        for k in back(i):
            yield k
            if begins[k]:
                return

    found, late = [], set()
    for i, e in enumerate(line):
        named = next((line[k]["season"] for k in back(i) if line[k]["season"]), None)
        other_season = bool(e["season"] and named and e["season"] != named)
        again = place[e["activity"]] < 2 and any(place[line[k]["activity"]] >= len(place) - 2 for k in cycle(i))
        begins.append(other_season or again)
        if not begins[i] and any(place[line[k]["activity"]] > place[e["activity"]] for k in cycle(i)):
            late.add(i)
            order = [line[k]["activity"] for k in cycle(i) if k not in late][::-1]
            found.append((e["event_id"], tuple([*order, e["activity"]])))
    return sorted(found)


def random_events(seed, cases, n, hot_share):
    rng = random.Random(seed)
    names = STAGE_SEQUENCE + ["quarantine"]
    return [
        {
            "event_id": i + 1,
            "case_id": "hot" if rng.random() < hot_share else f"c{rng.randrange(cases)}",
            "activity": rng.choice(names),
            "season": rng.choice(["2001", "2001", "2002", None]),
            "at": rng.randrange(n // 3),
        }
        for i in range(n)
    ]


@pytest.mark.parametrize("hot_rows, slices", [(10**9, None), (40, 7)])
def test_sequence_rule_against_its_definition(spark, hot_rows, slices):
    """One case owns a third of the events; with the low limit it is scanned in slices."""
    rows = random_events(5, 60, 1500, 0.34)
    found = anomalies.expand_order(anomalies.out_of_sequence(events(spark, rows), hot_rows=hot_rows, slices=slices))
    got = sorted((r["event_id"], tuple(r["observed_order"])) for r in found.collect())
    assert got == late_events(rows)


def test_transitions_of_a_hot_case(spark):
    rows = random_events(7, 40, 1200, 0.4)
    df = events(spark, rows)
    columns = ["case_id", "event_id", "from_activity", "to_activity"]
    plain = anomalies.transitions(df).select(*columns)
    sliced = anomalies.transitions(df, hot_rows=30, slices=9).select(*columns)
    assert sorted(plain.collect()) == sorted(sliced.collect())
    assert plain.count() == len(rows) - len({r["case_id"] for r in rows})


def test_case_breakdown_over_days(spark):
    rows = [{"activity": a, "at": at} for a, at in [("bronze", 0), ("gold", 200_000), ("cdc", 90_000), ("silver", 90_010)]]
    row = reports.case_breakdown(events(spark, rows)).first()
    assert row["executed_path"] == "bronze -> cdc -> silver -> gold"
    assert (row["lead_time_seconds"], row["total_stages_executed"], row["overall_status"]) == (200_000.0, 4, "SUCCESS")


def test_windows_are_free_of_python_and_reuse_one_shuffle(spark):
    df = events(spark, nightly_run())
    plan = anomalies.out_of_sequence(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_event_log(spark):
    path = scratch(spark, "log")
    rows = [{"activity": "Bronze", "at": 0, "status": "success"}, {"activity": "gold", "at": 200_000, "until": 200_004, "status": "RUNNING"}]
    raw = events(spark, rows).withColumn("logged_at", F.expr("event_timestamp + INTERVAL 2 SECONDS"))
    for n in range(2):
        part = event_log.normalize(raw.withColumn("event_id", F.col("event_id") + 2 * n))
        event_log.append(part, path)
    log = event_log.read_log(spark, path)
    assert log.count() == 4
    first = log.where("event_id = 1").first()
    # a finished status in lower case does not get an end time, as it is compared before it is raised
    assert (first["activity"], first["status"], first["duration_seconds"]) == ("bronze", "SUCCESS", None)
    assert log.where("event_id = 2").first()["duration_seconds"] == 4.0
    assert [r["event_id"] for r in event_log.recent(log, 1).collect()] == [4]
    assert event_log.of_case(log, "case", None).count() == 4
