"""Small hand-written inputs."""

import copy
import json
from datetime import datetime, timedelta

HOME = [f"H{i}" for i in range(11)]
AWAY = [f"A{i}" for i in range(11)]


def document(runs=35, **info):
    """A valid match; every ball scores 5, so that a completed match is no outlier."""
    ball = {"batter": "H0", "bowler": "A0", "runs": {"batter": 5, "extras": 0, "total": 5}}
    base = {
        "info": {
            "match_type": "T20",
            "season": "2024",
            "teams": ["Northern Lions", "Southern Stars"],
            "dates": ["2024-05-02"],
            "venue": "Harbour Ground",
            "overs": 20,
            "players": {"Northern Lions": HOME, "Southern Stars": AWAY},
        },
        "innings": [
            {"team": "Northern Lions", "overs": [{"over": 0, "deliveries": [copy.deepcopy(ball) for _ in range(runs // 5)]}]}
        ],
    }
    base["info"].update(info)
    return base


def without(doc, *path):
    doc = copy.deepcopy(doc)
    at = doc
    for key in path[:-1]:
        at = at[key]
    del at[path[-1]]
    return doc


def documents(spark, docs):
    rows = [(k, v if isinstance(v, str) else json.dumps(v)) for k, v in docs.items()]
    return spark.createDataFrame(rows, "match_id string, raw_data string")


EVENT = (
    "event_id bigint, case_id string, activity string, event_timestamp timestamp_ntz, end_timestamp timestamp_ntz, "
    "duration_seconds double, status string, records_processed int, error_message string, metadata string"
)
START = datetime(2026, 1, 1, 12, 0, 0)


def events(spark, rows):
    """Rows as dicts; ``at`` and ``until`` are seconds after the start."""
    made = []
    for n, row in enumerate(rows):
        at, until = row.get("at"), row.get("until")
        made.append((
            row.get("event_id", n + 1),
            row.get("case_id", "case"),
            row["activity"],
            None if at is None else START + timedelta(seconds=at),
            None if until is None else START + timedelta(seconds=until),
            row.get("seconds"),
            row.get("status", "SUCCESS"),
            row.get("records"),
            None,
            json.dumps({"season": row["season"]}) if row.get("season") else None,
        ))
    return spark.createDataFrame(made, EVENT)


def nightly_run():
    """Three overlapping stages with pauses: staging starts before bronze ends, gold after a gap."""
    return [
        {"case_id": "nightly", "activity": "bronze", "at": 0, "until": 12, "seconds": 12.0, "records": 40},
        {"case_id": "nightly", "activity": "staging", "at": 9, "until": 30, "seconds": 21.0, "records": 38},
        {"case_id": "nightly", "activity": "gold", "at": 44, "until": 50, "seconds": 6.0, "records": 22},
    ]
