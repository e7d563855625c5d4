"""The registered queries of this folder, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import attention_lm, fill_middle, filter_audit, html_segments, mixing, pii, qgram_leaks, quality_mcd, secret_scan, simhash_vp, toxicity, trie_bpe, url_model
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(function):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return add


SIZES = """
sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5(coalesce(doc_id::VARCHAR, '-') || ':42') AS digest
  FROM documents),
per_source AS (
  SELECT source, sum(size)::DECIMAL(38,0) AS source_size, (ARRAY[3, 1, 2])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sizes GROUP BY source),
"""


@query("op1_mixing", "WITH " + SIZES.strip() + """
-- a source is capped when the sources that fill up no later, at its own level, do not use the budget up
levels AS (
  SELECT a.source, a.source_size, a.weight,
         (SELECT sum(least(2 * b.source_size::DOUBLE, b.weight * (2 * a.source_size::DOUBLE / a.weight))) FROM per_source b) AS used_at_cap,
         (SELECT sum(source_size) * 1.5 FROM per_source) AS budget
  FROM per_source a),
capped AS (SELECT *, used_at_cap <= budget AS is_capped FROM levels),
targets AS (
  SELECT source, source_size,
         coalesce(CASE WHEN is_capped THEN 2 * source_size::DOUBLE
           ELSE weight * (3 * (sum(source_size) OVER ()) - 4 * coalesce(sum(source_size) FILTER (is_capped) OVER (), 0))::DOUBLE
                / (2 * sum(weight) FILTER (NOT is_capped) OVER ())::DOUBLE END, 0) AS target
  FROM capped),
ordered AS (
  SELECT s.doc_id, s.size, t.source_size::BIGINT AS source_size, t.target, round(t.target)::BIGINT AS words,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.digest, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0
            ELSE (words // source_size) * size + greatest(0, least(size, words - (words // source_size) * source_size - before)) END::BIGINT AS taken
FROM ordered""")
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.manifest(table(spark, sf_dir, "documents"))


@query("op2_quality_mcd")
def op2_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mcd.report(table(spark, sf_dir, "documents"))


@query("op3_simhash")
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_vp.report(table(spark, sf_dir, "documents"))


@query("op4_pii")
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_secrets")
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


@query("op7_benchmark_leaks")
def op7_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qgram_leaks.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_url_model")
def op8_url_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_model.report(table(spark, sf_dir, "pages"))


@query("op9_attention_lm")
def op9_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.report(table(spark, sf_dir, "documents"))


@query("op10_html_segments")
def op10_html_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_segments.report(table(spark, sf_dir, "pages"))


@query("op11_trie_bpe")
def op11_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_bpe.report(table(spark, sf_dir, "documents"))


@query("op12_fill_middle", r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
         sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS digest
  FROM documents),
drawn AS (
  SELECT *, len(units) AS n, [('0x' || substr(digest, 1 + 8 * i, 8))::UBIGINT for i in range(0, 4)] AS h FROM cut),
placed AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
              WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS prefix, coalesce(array_to_string(units[a + 1:b], ''), '') AS middle,
         coalesce(array_to_string(units[b + 1:], ''), '') AS suffix
  FROM placed),
turned AS (
  SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output
  FROM parts),
marked AS (SELECT *, strpos(output, '<P>') AS p, strpos(output, '<S>') AS s, strpos(output, '<M>') AS m FROM turned)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars, sha256(output) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN output
              WHEN 'psm' THEN substr(output, 4, s - 4) || substr(output, m + 3) || substr(output, s + 3, m - s - 3)
              ELSE substr(output, p + 3, m - p - 3) || substr(output, m + 3) || substr(output, 4, p - 4) END) AS restored_sha256
FROM marked""")
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.report(table(spark, sf_dir, "documents"))


@query("op13_filter_audit", r"""
WITH read AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
marked AS (
  SELECT r.part,
         CASE WHEN len(words) < 50 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN r.doc_id > min(r.doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS failed,
         coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic
  FROM read r LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l ON r.doc_id = l.doc_id),
counts AS (SELECT part, failed, good, toxic, count(*) AS n FROM marked GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS k),
orders AS (
  SELECT a.k || b.k || c.k || d.k || e.k AS filter_order
  FROM letters a JOIN letters b ON b.k <> a.k JOIN letters c ON c.k NOT IN (a.k, b.k)
  JOIN letters d ON d.k NOT IN (a.k, b.k, c.k) JOIN letters e ON e.k NOT IN (a.k, b.k, c.k, d.k)),
steps AS (SELECT filter_order, step, substr(filter_order, step, 1) AS own, left(filter_order, step - 1) AS earlier FROM orders, range(1, 6) s(step)),
met AS (
  SELECT c.*, s.*, contains(failed, own) AS fails, failed <> '' AND regexp_matches(failed, '[' || CASE WHEN earlier = '' THEN '-' ELSE earlier END || ']') AS gone
  FROM counts c, steps s),
told AS (
  SELECT part, filter_order, step::INT AS step, own,
         sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN gone AND fails THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN failed = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN NOT gone AND fails AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN NOT gone AND fails AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
  FROM met GROUP BY ALL)
SELECT * EXCLUDE (own), (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM told""")
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
