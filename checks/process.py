"""Process events: metrics, reports, anomalies."""

from pyspark.sql import functions as F

from checks.registry import check
from checks.views import half_up, sql
from matchlake.constants import (
    ALLOWED_TRANSITIONS,
    ALWAYS_LEGAL_TRANSITIONS,
    RETRY_ACTIVITIES,
    SLA_REPORT_SECONDS,
    SLA_SECONDS,
    STAGE_SEQUENCE,
)
from matchlake.functions import text
from matchlake.operators import process_anomalies as anomalies
from matchlake.operators import process_metrics as metrics
from matchlake.operators import process_reports as reports
from matchlake.sources import adapters
from matchlake.sources import events as event_log

HOT_ROWS = 15


def events(spark, sf):
    return adapters.process_events(spark, sf)


def stamp(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def stamp_sql(column):
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def table_sql(name, columns, rows):
    body = ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)
    return f"{name}({', '.join(columns)}) AS (VALUES {body})"


SLA = table_sql("sla", ["activity", "sla_limit"], SLA_SECONDS.items())
STAGE = (
    f"stage AS (SELECT activity, {half_up('sum(ms)', 'count(*) * 1000', 3)} AS seconds FROM "
    "(SELECT activity, coalesce(dur_ms, greatest(0, elapsed_ms)) AS ms FROM ev) WHERE ms >= 0 GROUP BY 1)"
)
CYCLE = (
    "cyc AS (SELECT case_id, greatest(0, coalesce(max(coalesce(end_us, CASE WHEN duration_seconds <> 0 THEN start_us END)), max(start_us)) "
    "- min(start_us) + 500) // 1000 AS ms FROM ev GROUP BY 1)"
)
CYCLE_AVERAGE = f"coalesce({half_up('sum(ms)', 'count(*) * 1000', 3)}, 0.0)"


@check(
    "iso_parse",
    "SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS parsed FROM events",
)
def iso_parse(spark, sf):
    raw = adapters.table(spark, sf, "events")
    written = F.expr(
        """CASE event_id % 4
             WHEN 0 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
             WHEN 1 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
             WHEN 2 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')
             ELSE 'at ' || event_id END"""
    )
    return raw.select("event_id", stamp(text.parse_iso(written)).alias("parsed"))


@check(
    "canonical_name",
    "SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'Delhi Capitals' WHEN 1 THEN 'Punjab Kings' "
    "WHEN 2 THEN 'Rising Pune Supergiants' WHEN 3 THEN 'Royal Challengers Bengaluru' WHEN 4 THEN o_orderpriority END AS name FROM orders",
)
def canonical_name(spark, sf):
    raw = F.expr(
        """CASE o_orderkey % 6 WHEN 0 THEN ' Delhi Daredevils ' WHEN 1 THEN 'Kings XI Punjab'
             WHEN 2 THEN '  Rising Pune Supergiant' WHEN 3 THEN 'Royal Challengers Bangalore'
             WHEN 4 THEN ' ' || o_orderpriority END"""
    )
    return adapters.table(spark, sf, "orders").select("o_orderkey", text.canonical_name(raw).alias("name"))


@check(
    "bpm_normalize_events",
    sql(
        "ev",
        f"SELECT event_id, case_id, activity, {stamp_sql('event_timestamp')} AS event_timestamp, "
        f"{stamp_sql('CASE WHEN event_id % 3 = 0 AND end_timestamp IS NOT NULL THEN logged_at ELSE end_timestamp END')} AS end_timestamp, "
        "coalesce(duration_seconds, CASE WHEN event_id % 3 = 0 AND end_timestamp IS NOT NULL THEN 3600.0 ELSE elapsed_ms / 1000.0 END) AS duration_seconds, "
        "status, coalesce(records_processed, 0) AS records_processed, error_message "
        "FROM (SELECT *, event_timestamp + INTERVAL 1 HOUR AS logged_at FROM ev)",
    ),
)
def bpm_normalize_events(spark, sf):
    third = F.col("event_id") % 3 == 0
    raw = (
        events(spark, sf)
        .withColumn("logged_at", F.expr("event_timestamp + INTERVAL 1 HOUR"))
        .withColumn("end_timestamp", F.when(~third, F.col("end_timestamp")))
        .withColumn("activity", F.upper("activity"))
    )
    rows = event_log.normalize(raw).drop("metadata")
    for name in ("event_timestamp", "end_timestamp"):
        rows = rows.withColumn(name, stamp(name))
    return rows


RECENT = "event_id, case_id, activity, status"


@check(
    "bpm_recent_events",
    sql("ev", f"SELECT {RECENT} FROM ev ORDER BY event_timestamp DESC, event_id DESC LIMIT 200"),
)
def bpm_recent_events(spark, sf):
    return event_log.recent(events(spark, sf)).select(*RECENT.split(", "))


@check(
    "bpm_case_events",
    sql("ev", f"SELECT {RECENT} FROM ev WHERE case_id = 'u3-w1'"),
)
def bpm_case_events(spark, sf):
    return event_log.of_case(events(spark, sf), "u3-w1").select(*RECENT.split(", "))


@check(
    "bpm_case_events_page",
    sql("ev", f"SELECT {RECENT} FROM ev WHERE case_id = 'u3-w1' ORDER BY event_timestamp, event_id LIMIT 2"),
)
def bpm_case_events_page(spark, sf):
    return event_log.of_case(events(spark, sf), "u3-w1", 2).select(*RECENT.split(", "))


@check("bpm_stage_durations", sql("ev", "SELECT activity, seconds AS duration_seconds FROM stage", STAGE))
def bpm_stage_durations(spark, sf):
    return metrics.stage_durations(events(spark, sf))


@check(
    "bpm_cycle_time",
    sql(
        "ev",
        f"SELECT {CYCLE_AVERAGE} AS cycle_time_seconds, {CYCLE_AVERAGE} AS lead_time_seconds FROM cyc WHERE ms > 0",
        CYCLE,
    ),
)
def bpm_cycle_time(spark, sf):
    return metrics.cycle_time(events(spark, sf))


@check(
    "bpm_throughput",
    sql(
        "ev",
        "SELECT event_id, activity, CASE WHEN dur_ms > 0 THEN coalesce("
        f"{half_up('records_processed * 1000', 'dur_ms', 2)}, 0.0) ELSE 0.0 END AS throughput_rps FROM ev",
    ),
)
def bpm_throughput(spark, sf):
    return metrics.event_throughput(events(spark, sf))


@check(
    "bpm_bottlenecks_avg",
    sql(
        "ev",
        f"SELECT activity, seconds AS duration_seconds, {half_up('100 * ms', 'total', 1)} AS pct_of_total FROM "
        "(SELECT *, CAST(round(seconds * 1000) AS BIGINT) AS ms, sum(CAST(round(seconds * 1000) AS BIGINT)) OVER () AS total FROM stage)",
        STAGE,
    ),
)
def bpm_bottlenecks_avg(spark, sf):
    return metrics.bottlenecks(events(spark, sf))


LIMITED = f"{SLA}, {STAGE}, lim AS (SELECT s.activity, seconds, coalesce(sla_limit, 30.0) AS sla_limit FROM stage s LEFT JOIN sla USING (activity))"


@check(
    "bpm_sla_compliance",
    sql(
        "ev",
        f"SELECT {half_up('100 * count(*) FILTER (seconds <= sla_limit)', 'count(*)', 1)} AS compliance_pct, count(*) AS total_stages FROM lim",
        LIMITED,
    ),
)
def bpm_sla_compliance(spark, sf):
    return metrics.sla_compliance(events(spark, sf))


@check(
    "bpm_sla_breach_stages",
    sql(
        "ev",
        "SELECT activity, seconds AS actual_seconds, CAST(sla_limit AS DOUBLE) AS sla_limit, "
        "(CAST(round(seconds * 1000) AS BIGINT) - CAST(sla_limit * 1000 AS BIGINT)) / 1000.0 AS breach_seconds FROM lim WHERE seconds > sla_limit",
        LIMITED,
    ),
)
def bpm_sla_breach_stages(spark, sf):
    return metrics.breached_stages(events(spark, sf))


def summary_sql(where=""):
    source = f"(SELECT * FROM ev {where})"
    return sql(
        "ev",
        f"SELECT cycle AS cycle_time_seconds, cycle AS lead_time_seconds, "
        "(SELECT activity FROM lim ORDER BY seconds DESC, activity LIMIT 1) AS primary_bottleneck, "
        f"(SELECT {half_up('100 * count(*) FILTER (seconds <= sla_limit)', 'count(*)', 1)} FROM lim) AS compliance_pct, "
        f"{half_up('records * 1000', 'CAST(round(cycle * 1000) AS BIGINT)', 2)} AS throughput_rps, records AS total_records, n AS event_count FROM "
        f"(SELECT (SELECT {CYCLE_AVERAGE} FROM cyc WHERE ms > 0) AS cycle, "
        f"(SELECT CAST(sum(records_processed) AS BIGINT) FROM {source} WHERE status = 'SUCCESS') AS records, (SELECT count(*) FROM {source}) AS n)",
        f"{LIMITED.replace('FROM ev', 'FROM ' + source)}, {CYCLE.replace('FROM ev', 'FROM ' + source)}",
    )


@check("bpm_summary", summary_sql())
def bpm_summary(spark, sf):
    return metrics.process_summary(events(spark, sf)).drop("case_id")


@check("bpm_summary_case", summary_sql("WHERE case_id = 'u3-w1'"))
def bpm_summary_case(spark, sf):
    return metrics.process_summary(events(spark, sf), "u3-w1").drop("case_id")


@check(
    "bpm_sla_breaches",
    sql(
        "ev",
        "SELECT event_id, case_id, activity, coalesce(dur_ms, elapsed_ms) / 1000.0 AS actual_seconds, "
        "CAST(coalesce(sla_limit, 30.0) AS DOUBLE) AS sla_limit FROM ev LEFT JOIN sla USING (activity) "
        "WHERE coalesce(dur_ms, elapsed_ms) / 1000.0 > coalesce(sla_limit, 30.0)",
        SLA,
    ),
)
def bpm_sla_breaches(spark, sf):
    return anomalies.sla_breaches(events(spark, sf)).drop("type", "severity", "message")


# The order rule as a row-by-row fold: one recursion step per event of a case.
SEQUENCE = table_sql("seq", ["activity", "idx"], [(s, i) for i, s in enumerate(STAGE_SEQUENCE)])
FOLD = f"""{SEQUENCE},
  known AS (SELECT case_id, event_id, activity, idx, event_season,
                   row_number() OVER (PARTITION BY case_id ORDER BY event_timestamp, idx, event_id) AS rn FROM ev JOIN seq USING (activity)),
  fold AS (
    SELECT case_id, rn, event_id, activity, idx AS hi, event_season AS cur, false AS bad, activity AS seen, '' AS observed_order
    FROM known WHERE rn = 1
    UNION ALL
    SELECT case_id, rn, event_id, activity, CASE WHEN fresh THEN idx ELSE greatest(hi, idx) END, cur, NOT fresh AND idx < hi,
           CASE WHEN fresh THEN activity WHEN idx < hi THEN seen ELSE seen || ' > ' || activity END,
           CASE WHEN NOT fresh AND idx < hi THEN seen || ' > ' || activity ELSE '' END
    FROM (SELECT k.case_id, k.rn, k.event_id, k.activity, k.idx, f.hi, f.seen, coalesce(k.event_season, f.cur) AS cur,
                 coalesce(k.event_season <> f.cur, false) OR (f.hi >= 5 AND k.activity IN ('bronze', 'staging')) AS fresh
          FROM fold f JOIN known k ON k.case_id = f.case_id AND k.rn = f.rn + 1))"""
OUT_OF_SEQUENCE = sql("ev", "SELECT case_id, event_id, activity, observed_order FROM fold WHERE bad", FOLD).replace(
    "WITH ", "WITH RECURSIVE ", 1
)


def _order(found):
    spelled = anomalies.expand_order(found)
    return spelled.select("case_id", "event_id", "activity", F.array_join("observed_order", " > ").alias("observed_order"))


@check("bpm_out_of_sequence", OUT_OF_SEQUENCE)
def bpm_out_of_sequence(spark, sf):
    return _order(anomalies.out_of_sequence(events(spark, sf)))


@check("bpm_out_of_sequence_hot", OUT_OF_SEQUENCE)
def bpm_out_of_sequence_hot(spark, sf):
    """The same with a hot-case limit so low that large cases are scanned in slices."""
    return _order(anomalies.out_of_sequence(events(spark, sf), hot_rows=HOT_ROWS, slices=16))


RETRY = ", ".join(repr(a) for a in RETRY_ACTIVITIES)


def duplicates_sql(condition):
    return sql(
        "ev",
        f"SELECT case_id, event_season AS season, activity, count(*) AS execution_count FROM ev e WHERE NOT (status = 'RUNNING' AND EXISTS "
        "(SELECT 1 FROM ev t WHERE t.case_id = e.case_id AND t.activity = e.activity AND t.status IN ('SUCCESS', 'FAILED', 'COMPLETED', 'QUARANTINED'))) "
        f"{condition} GROUP BY 1, 2, 3 HAVING count(*) > 1",
    )


@check("bpm_duplicates", duplicates_sql(f"AND activity NOT IN ({RETRY})"))
def bpm_duplicates(spark, sf):
    return anomalies.duplicates(events(spark, sf)).select("case_id", "season", "activity", "execution_count")


@check("bpm_duplicates_strict", duplicates_sql(""))
def bpm_duplicates_strict(spark, sf):
    found = anomalies.duplicates(events(spark, sf), allow_retries=False)
    return found.select("case_id", "season", "activity", "execution_count")


LEGAL = table_sql(
    "legal",
    ["src", "dst"],
    sorted({(k, t) for k, v in ALLOWED_TRANSITIONS.items() for t in [*v, *ALWAYS_LEGAL_TRANSITIONS.get(k, [])]}),
)
PAIRS = f"""{SEQUENCE}, {LEGAL},
  pairs AS (SELECT case_id, event_id, activity AS from_activity, lead(activity) OVER w AS to_activity FROM ev LEFT JOIN seq USING (activity)
            WINDOW w AS (PARTITION BY case_id ORDER BY event_timestamp, coalesce(idx, 999), event_id)),
  judged AS (SELECT *, from_activity = to_activity OR from_activity NOT IN (SELECT src FROM legal)
                    OR (from_activity, to_activity) IN (SELECT (src, dst) FROM legal) AS fine FROM pairs WHERE to_activity IS NOT NULL)"""
DEVIATIONS = sql("ev", "SELECT case_id, event_id, from_activity, to_activity FROM judged WHERE NOT fine", PAIRS)


@check("bpm_deviations", DEVIATIONS)
def bpm_deviations(spark, sf):
    return anomalies.deviations(events(spark, sf)).drop("type", "severity", "message")


@check("bpm_deviations_hot", DEVIATIONS)
def bpm_deviations_hot(spark, sf):
    """The same with a hot-case limit so low that large cases are scanned in slices."""
    found = anomalies.deviations(events(spark, sf), hot_rows=HOT_ROWS, slices=16)
    return found.drop("type", "severity", "message")


@check(
    "bpm_directly_follows",
    sql("ev", "SELECT from_activity, to_activity, count(*) AS times FROM judged GROUP BY 1, 2", PAIRS),
)
def bpm_directly_follows(spark, sf):
    return anomalies.directly_follows(events(spark, sf))


@check(
    "bpm_transition_fitness",
    sql(
        "ev",
        "SELECT count(*) AS transitions, count(*) FILTER (fine) AS valid_transitions, "
        f"{half_up('100 * count(*) FILTER (fine)', 'count(*)', 2)} AS fitness_pct FROM judged",
        PAIRS,
    ),
)
def bpm_transition_fitness(spark, sf):
    return anomalies.transition_fitness(events(spark, sf))


@check(
    "bpm_anomaly_counts",
    sql(
        "ev",
        "SELECT 'SLA_BREACH' AS type, count(*) AS n FROM ev LEFT JOIN sla USING (activity) WHERE coalesce(dur_ms, elapsed_ms) / 1000.0 > coalesce(sla_limit, 30.0) "
        "UNION ALL SELECT 'OUT_OF_SEQUENCE', count(*) FROM fold WHERE bad "
        "UNION ALL SELECT 'PROCESS_DEVIATION', count(*) FROM judged WHERE NOT fine "
        f"UNION ALL SELECT 'DUPLICATE_ACTIVITY', count(*) FROM ({duplicates_sql(f'AND activity NOT IN ({RETRY})').split(') SELECT', 1)[1].join(['SELECT', ''])})",
        f"{SLA}, {FOLD}, {PAIRS.replace(SEQUENCE + ',', '', 1)}",
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def bpm_anomaly_counts(spark, sf):
    return anomalies.all_anomalies(events(spark, sf)).groupBy("type").agg(F.count(F.lit(1)).alias("n"))


@check(
    "bpm_lead_time",
    sql(
        "ev",
        f"SELECT count(*) AS total_cases, {half_up('sum(us)', 'count(*) * 1000000', 2)} AS avg_lead_time_seconds, "
        f"{half_up('min(us)', '1000000', 2)} AS min_lead_time_seconds, {half_up('max(us)', '1000000', 2)} AS max_lead_time_seconds FROM "
        "(SELECT max(coalesce(end_us, start_us)) - min(start_us) AS us FROM ev GROUP BY case_id HAVING count(*) >= 2)",
    ),
)
def bpm_lead_time(spark, sf):
    return reports.lead_time(events(spark, sf))


CASE_BREAKDOWN = sql(
        "ev",
        f"SELECT case_id, {stamp_sql('min(event_timestamp)')} AS process_start, {stamp_sql('max(coalesce(end_timestamp, event_timestamp))')} AS process_end, "
        f"{half_up('max(coalesce(end_us, start_us)) - min(start_us)', '1000000', 2).replace('max(coalesce(end_us, start_us)) - min(start_us)', '(max(coalesce(end_us, start_us)) - min(start_us))')} AS lead_time_seconds, "
        "CAST(sum(records_processed) AS BIGINT) AS total_records_processed, count(*) AS total_stages_executed, "
        "string_agg(activity, ' -> ' ORDER BY event_timestamp, event_id) AS executed_path, "
        "CASE WHEN bool_or(status = 'FAILED') THEN 'FAILED' WHEN bool_or(status = 'QUARANTINED') THEN 'QUARANTINED' ELSE 'SUCCESS' END AS overall_status "
        "FROM ev GROUP BY case_id",
    )


def _breakdown(rows):
    return rows.withColumn("process_start", stamp("process_start")).withColumn("process_end", stamp("process_end"))


@check("bpm_case_breakdown", CASE_BREAKDOWN)
def bpm_case_breakdown(spark, sf):
    return _breakdown(reports.case_breakdown(events(spark, sf)))


@check("bpm_case_breakdown_hot", CASE_BREAKDOWN)
def bpm_case_breakdown_hot(spark, sf):
    """The same with a hot-case limit so low that large cases are put together from slices."""
    return _breakdown(reports.case_breakdown(events(spark, sf), hot_rows=HOT_ROWS, slices=16))


@check(
    "bpm_stage_benchmark",
    sql(
        "ev",
        f"SELECT activity, count(*) AS execution_count, {half_up('sum(us)', 'count(us) * 1000000', 2)} AS avg_duration_seconds, "
        f"{half_up('min(us)', '1000000', 2)} AS min_duration_seconds, {half_up('max(us)', '1000000', 2)} AS max_duration_seconds, "
        "CAST(sum(records_processed) AS BIGINT) AS total_records_processed FROM "
        "(SELECT *, coalesce(dur_ms * 1000, end_us - start_us) AS us FROM ev WHERE status <> 'RUNNING') GROUP BY 1",
    ),
)
def bpm_stage_benchmark(spark, sf):
    return reports.stage_benchmark(events(spark, sf))


@check(
    "bpm_bottleneck_rank",
    sql(
        "ev",
        f"SELECT activity AS bottleneck_stage, n AS total_runs, {half_up('ms', 'n * 1000', 2)} AS avg_duration_seconds, "
        f"{half_up('100 * ms', 'total', 1)} AS latency_share_percentage, dense_rank() OVER (ORDER BY ms DESC) AS bottleneck_rank FROM "
        "(SELECT *, sum(ms) OVER () AS total FROM (SELECT activity, sum(coalesce(dur_ms, 0)) AS ms, count(*) AS n FROM ev GROUP BY 1))",
    ),
)
def bpm_bottleneck_rank(spark, sf):
    return reports.bottleneck_rank(events(spark, sf))


@check(
    "bpm_sla_sql",
    sql(
        "ev",
        "SELECT e.activity, CAST(any_value(s.sla_limit) AS DOUBLE) AS sla_limit, count(*) AS total_executions, "
        "count(CASE WHEN dur_ms > sla_limit * 1000 THEN 1 END) AS breach_count, "
        f"{half_up('100 * count(CASE WHEN dur_ms <= sla_limit * 1000 THEN 1 END)', 'count(*)', 1)} AS sla_compliance_pct, "
        f"{half_up('sum(dur_ms)', 'count(dur_ms) * 1000', 2)} AS avg_duration_seconds "
        "FROM ev e JOIN rep s ON lower(e.activity) = lower(s.activity) GROUP BY e.activity",
        table_sql("rep", ["activity", "sla_limit"], SLA_REPORT_SECONDS.items()),
    ),
)
def bpm_sla_sql(spark, sf):
    return reports.sla_report(events(spark, sf))


@check(
    "bpm_failure_rate",
    sql(
        "ev",
        "SELECT activity, count(*) AS total_executions, count(*) FILTER (status = 'SUCCESS') AS successful_executions, "
        "count(*) FILTER (status = 'FAILED') AS failed_executions, count(*) FILTER (status = 'QUARANTINED') AS quarantined_executions, "
        f"{half_up('''100 * count(*) FILTER (status = 'FAILED')''', 'count(*)', 2)} AS failure_rate_pct FROM ev GROUP BY 1",
    ),
)
def bpm_failure_rate(spark, sf):
    return reports.failure_rate(events(spark, sf))


@check(
    "bpm_case_throughput",
    sql(
        "ev",
        f"SELECT case_id, CAST(r AS BIGINT) AS total_records, {half_up('us', '1000000', 2)} AS total_time_seconds, "
        f"CASE WHEN us > 0 THEN {half_up('r * 1000000', 'us', 2)} END AS throughput_records_per_sec FROM "
        "(SELECT case_id, sum(records_processed) AS r, max(coalesce(end_us, start_us)) - min(start_us) AS us FROM ev GROUP BY 1) WHERE r > 0",
    ),
)
def bpm_case_throughput(spark, sf):
    return reports.case_throughput(events(spark, sf))


@check(
    "bpm_exception_audit",
    sql(
        "ev",
        f"SELECT event_id, case_id, activity, status, duration_seconds, error_message, {stamp_sql('event_timestamp')} AS event_timestamp, "
        "CASE WHEN status = 'FAILED' THEN 'STAGE_FAILURE' WHEN status = 'QUARANTINED' THEN 'QUALITY_QUARANTINE_EXCEPTION' "
        "WHEN duration_seconds > 45 THEN 'EXTREME_LATENCY_ANOMALY' ELSE 'NORMAL' END AS anomaly_classification FROM ev "
        "WHERE status IN ('FAILED', 'QUARANTINED') OR duration_seconds > 45 ORDER BY ev.event_timestamp DESC, event_id DESC LIMIT 50",
    ),
)
def bpm_exception_audit(spark, sf):
    return reports.exception_audit(events(spark, sf)).withColumn("event_timestamp", stamp("event_timestamp"))


@check(
    "bpm_season_trend",
    sql(
        "ev",
        f"SELECT event_season AS season, count(DISTINCT case_id) AS total_runs, {half_up('sum(dur_ms)', 'count(dur_ms) * 1000', 2)} AS avg_stage_duration, "
        "CAST(sum(records_processed) AS BIGINT) AS total_records_loaded FROM ev GROUP BY 1",
    ),
)
def bpm_season_trend(spark, sf):
    return reports.season_trend(events(spark, sf))
