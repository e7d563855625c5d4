"""The search for near copies moves the texts that it has to compare or drop, not all of them."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from matchlake.llm import common, near_copies as N
from matchlake.session import Workspace
from tests.llm.test_near_copies import brute


def shuffled_rows(plan):
    """Rows that the exchanges of an executed plan wrote, the largest number."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return shuffled_rows(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled_rows(plan.plan())
    children = [plan.children().apply(i) for i in range(plan.children().size())]
    own = plan.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" else 0
    return max([own, *map(shuffled_rows, children)])


@pytest.fixture
def unsent(spark):
    """As on tables whose keys are too many to be broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def mostly_apart(rng, count=600, copies=20):
    rows = [(i, " ".join(f"w{rng.randrange(9000)}" for _ in range(40)), "en", "a") for i in range(count)]
    return rows + [(count + i, rows[i][1] + f" x{i}", "en", "a") for i in range(copies)]


def test_rows_without_a_copy_stay_where_they_are(frame, unsent):
    rows = mostly_apart(random.Random(8))
    left = N.one_of_each(frame(rows).localCheckpoint())
    assert Counter(r.doc_id for r in left.collect()) == brute([r[:2] for r in rows])
    assert shuffled_rows(left._jdf.queryExecution().executedPlan()) < 200


def test_only_texts_of_cells_are_dealt(spark, frame, unsent, monkeypatch):
    rows = mostly_apart(random.Random(9))
    dealt = []
    with Workspace(spark, "test") as work:
        texts = frame(rows).localCheckpoint().selectExpr("doc_id", "cast(doc_id as string) AS key", "text AS text_")
        points = work.written(N.signatures(texts).select("fp", "sim", "bands", "key"))
        kept = work.written

        def noted(df):
            out = kept(df)
            df.collect()
            dealt.append(shuffled_rows(df._jdf.queryExecution().executedPlan()))
            return out

        cells = N.roots(N.near(N.members(points, work), work), work).withColumnRenamed("root", "cell")
        cells = kept(cells.unionByName(cells.select(F.col("cell").alias("fp"), "cell").distinct()))
        monkeypatch.setattr(work, "written", noted)
        assert N.sets(cells, points, texts, work).count() == 40
    assert dealt[-1] < 200


def test_a_sieve_lets_every_key_through(spark, monkeypatch):
    monkeypatch.setattr(common, "SIEVE_MOST", 1 << 16)  # 70,000 keys are too many for it
    for count in (0, 1, 3000, 70_000):
        keys = spark.range(count).selectExpr("concat('k', id) AS key")
        passes = common.sieve(keys, "key")
        assert keys.where(passes(F.col("key"))).count() == count
        others = spark.range(4000).select(F.concat(F.lit("o"), "id").alias("key"))
        assert others.where(passes(F.col("key"))).count() < (1 if not count else 800 if count < 70_000 else 4000)
