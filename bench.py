"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]: one JSON line.

The tables a platform has at hand when it is queried (staged documents, silver tables, the gold
fact, the lakehouse table) are written first; ``setup_sec`` holds the time of that. Each query
then runs once to warm up and three times for its median. Small results are collected, tables are
computed in full without being kept.
"""

import json
import logging
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F

from matchlake.operators import analytics, cdc, eda, gold, lakehouse, quality, silver
from matchlake.operators import process_anomalies, process_metrics, process_reports
from matchlake.session import build_session, scratch
from matchlake.sources import adapters
from matchlake.sources import documents as docs_source
from matchlake.sources import lakehouse as lake_table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = 3
SEASON = "1998"


def stage(spark, root):
    """Write the tables the queries read."""
    def put(name, df, partition=None):
        writer = df.write.mode("overwrite").option("compression", "zstd")
        (writer.partitionBy(partition) if partition else writer).parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    tables = {
        "match": put("match", adapters.matches(spark, SF_DIR)),
        "delivery": put("delivery", adapters.deliveries(spark, SF_DIR)),
        "wicket": put("wicket", adapters.wickets(spark, SF_DIR)),
        "player": put("player", adapters.players(spark, SF_DIR)),
        "team": put("team", adapters.teams(spark, SF_DIR)),
        "team_squad": put("team_squad", adapters.squads(spark, SF_DIR)),
        "events": put("events", adapters.process_events(spark, SF_DIR)),
        "staged": put("staged", adapters.documents(spark, SF_DIR, defects=True).select("match_id", "raw_data")),
    }
    tables["fact"] = put("fact", gold.match_summary(tables["match"], tables["delivery"], tables["wicket"]))
    tables["dim_player"] = put(
        "dim_player", gold.player_dimension(tables["player"], tables["delivery"], tables["wicket"])
    )
    lake_rows = tables["fact"].select(
        "*", F.lit(20).alias("total_overs"), F.lit(None).cast("string").alias("raw_payload"),
        F.current_timestamp().alias("ingested_at"),
    ).withColumn("match_date", F.col("match_date").cast("string"))
    lake_table.write_seasons(lake_rows, f"{root}/lake")
    tables["lake"] = lake_table.read_table(spark, f"{root}/lake")
    checked = quality.classify(docs_source.readable(docs_source.parse(tables["staged"])))
    tables["checked"] = put("checked", checked, "season").withColumn("season", F.col("season").cast("string"))
    return tables


def headline(t):
    """Name -> a function that builds the query."""
    valid = lambda: quality.valid(t["checked"])
    texts = lambda spark: adapters.table(spark, SF_DIR, "documents").selectExpr("CAST(doc_id AS STRING) AS key", "text")

    def changes():
        all_texts = texts(t["match"].sparkSession)
        old = cdc.fingerprints(all_texts.where("key % 10 <> 0"), "key", "text")
        new = all_texts.where("key % 10 <> 2").withColumn("text", F.expr("IF(key % 10 = 1, text || ' v2', text)"))
        return cdc.classify(cdc.fingerprints(new, "key", "text"), old, old.select("business_key"), complete=True)

    return {
        "q1_row_count": lambda: lakehouse.row_count(t["lake"]),
        "q2_season_agg": lambda: lakehouse.season_trends(t["lake"]),
        "q3_team_wins": lambda: lakehouse.wins_by_team(t["lake"], n=None),
        "q4_partition_pruned": lambda: lakehouse.season_matches(t["lake"], SEASON),
        "top_batters": lambda: analytics.top_players(t["dim_player"], "total_runs"),
        "star_join": lambda: analytics.team_season_report(t["match"], t["delivery"], "NATION_3"),
        "gold_match_summary": lambda: gold.match_summary(t["match"], t["delivery"], t["wicket"]),
        "gold_dim_team": lambda: gold.team_dimension(t["team"], t["match"], t["delivery"]),
        "gold_dim_player": lambda: gold.player_dimension(t["player"], t["delivery"], t["wicket"]),
        "dq_classify": lambda: quality.classify(docs_source.parse(t["staged"])),
        "flatten_delivery": lambda: silver.delivery(valid()),
        "eda_kpi": lambda: eda.kpi(valid()),
        "cdc_classify": changes,
        "bpm_case_breakdown": lambda: process_reports.case_breakdown(t["events"]),
        "bpm_summary": lambda: process_metrics.process_summary(t["events"]),
        "bpm_out_of_sequence": lambda: process_anomalies.out_of_sequence(t["events"]),
        "bpm_deviations": lambda: process_anomalies.deviations(t["events"]),
        "bpm_duplicates": lambda: process_anomalies.duplicates(t["events"]),
    }


def run(query):
    start = time.perf_counter()
    query().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    logging.disable(logging.WARNING)
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        "spark.log.level": "ERROR",
    })
    root = scratch(spark, "bench")
    start = time.perf_counter()
    tables = stage(spark, root)
    setup = time.perf_counter() - start
    timings = {}
    for name, query in headline(tables).items():
        run(query)
        timings[name] = round(statistics.median(run(query) for _ in range(REPEATS)), 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "setup_sec": round(setup, 3),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
