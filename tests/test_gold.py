"""Player figures against plain counting, and the shape of their plan."""

from collections import defaultdict

from matchlake.operators import gold

BALLS = [  # match, innings, batter, bowler, batter_runs, total_runs
    ("m1", 1, "ann", "bob", 4, 4), ("m1", 1, "ann", "bob", 6, 7), ("m1", 2, "bob", "ann", 0, 1), ("m1", 2, "cid", "ann", 1, 1),
    ("m2", 1, "ann", "cid", 100, 100), ("m2", 3, "ann", "cid", 50, 50), ("m2", 1, "bob", "cid", None, 0), ("m3", None, "cid", "bob", 4, 4),
    ("m3", 1, None, "bob", 2, 2), ("m3", 1, "eve", None, 2, 2),
]
OUTS = [("m1", 1, "bob"), ("m1", 1, "bob"), ("m1", 2, "ann"), ("m2", 2, "cid"), ("m3", None, "bob"), ("m3", 1, "zoe")]


def tables(spark):
    deliveries = spark.createDataFrame(BALLS, "match_id string, innings_number int, batter string, bowler string, batter_runs int, total_runs int")
    return deliveries, spark.createDataFrame(OUTS, "match_id string, innings_number int, bowler string")


def test_player_totals(spark):
    bat, bowl = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0, 0])
    for m, i, batter, bowler, runs, total in BALLS:
        bat[batter, m, i][0] += runs or 0
        bat[batter, m, i][1] += 1
        bowl[bowler, m, i][0] += 1
        bowl[bowler, m, i][1] += total
    for m, i, bowler in OUTS:
        if i is not None and (bowler, m, i) in bowl:
            bowl[bowler, m, i][2] += 1
    got = {r.player_name: r for r in gold.player_totals(*tables(spark)).collect()}
    assert set(got) == {k[0] for k in bat} | {k[0] for k in bowl}
    for name, r in got.items():
        own = {k: v for k, v in bat.items() if k[0] == name}
        assert (r.batting_matches, r.batting_innings, r.total_runs, r.total_balls) == (
            len({k[1] for k in own}), len(own), sum(v[0] for v in own.values()), sum(v[1] for v in own.values()))
        assert r.highest_score == max((v[0] for v in own.values()), default=None)
        assert (r.fifties, r.hundreds) == (sum(50 <= v[0] < 100 for v in own.values()), sum(v[0] >= 100 for v in own.values()))
        own = {k: v for k, v in bowl.items() if k[0] == name}
        assert (r.bowling_matches, r.bowling_innings, r.balls_bowled, r.runs_conceded, r.wickets_taken) == (
            len({k[1] for k in own}), len(own), *[sum(v[i] for v in own.values()) for i in range(3)])
        assert r.best_wickets == max((v[2] for v in own.values()), default=None)


def test_player_plan(spark, tmp_path):
    """Deliveries are read once; three levels of sums and the known players are all that is shuffled."""
    paths = [str(tmp_path / n) for n in "dwp"]
    for df, path in zip((*tables(spark), spark.createDataFrame([("ann",)], "player_name string")), paths):
        df.write.parquet(path)
    d, w, p = (spark.read.parquet(path) for path in paths)
    plan = gold.player_dimension(p, d, w)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3 and plan.count("Exchange hashpartitioning") <= 4
    assert "distinct" not in plan.lower().replace("isdistinct", "") and "Expand" not in plan and "FullOuter" not in plan
