from collections import Counter

from matchlake.operators import references as R


def frames(spark):
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    return {
        "team": make([("a",), ("b",), (None,)], "team_name string"),
        "match": make([("1", "a", "b", None, "p"), ("2", "a", "x", "x", None), (None, "b", "x", "b", "q")],
                      "match_id string, team1 string, team2 string, winner string, player_of_match string"),
        "team_squad": make([("1", "a", "p"), ("2", "c", "q"), ("9", "a", "p"), ("1", "12", "3")], "match_id string, team_name string, player_name string"),
        "player": make([("p",), ("p",)], "player_name string"),
        "delivery": make([("d1", "1", "a", "p", "p", "q"), ("d2", "11", "a", "p", "p", "p"), ("d3", "2", None, "p", None, "p")],
                         "delivery_id string, match_id string, batting_team string, batter string, non_striker string, bowler string"),
        "wicket": make([("d1", "p", None), ("d1", "z", "z"), ("d9", "z", "p")], "delivery_id string, player_out string, fielder string"),
    }


def brute(tables, references):
    rows = {n: [r.asDict() for r in t.collect()] for n, t in tables.items()}
    out = Counter()
    for child, own, parent, columns in references:
        if child in rows and parent in rows:
            held = {tuple(r[c] for c in columns) for r in rows[parent]}
            for r in rows[child]:
                key = tuple(r[c] for c in own)
                if None not in key and key not in held:
                    out[child, "+".join(own), parent, key[0] if len(key) == 1 else "".join(f"{len(k)}:{k}" for k in key)] += 1
    return out


def test_all_references(spark):
    tables = frames(spark)
    want = brute(tables, R.REFERENCES)
    assert {tuple(r)[:4]: r.rows for r in R.audit(tables).collect()} == want and len(want) > 8
    some = {k: v for k, v in tables.items() if k in ("wicket", "player")}
    assert {tuple(r)[:4]: r.rows for r in R.audit(some).collect()} == brute(some, R.REFERENCES)
    empty = {n: t.limit(0) for n, t in tables.items()}
    assert R.audit(empty).collect() == []
    assert {r.parent for r in R.audit(tables | {"player": empty["player"]}).collect()} >= {"player"}


def test_one_shuffle(spark):
    plan = R.audit(frames(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
