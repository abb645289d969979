"""Registered queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemart.llm import (
    alignment,
    bpe,
    fingerprints,
    jaccard_join,
    line_dedup,
    lm_scoring,
    packing,
    quality_rules,
    substring_dedup,
    suffix_dedup,
    toxicity,
    url_filters,
    whitening,
)
from tidemart.llm.common import apply_job_conf, documents, labels

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

# the contract's rules (host, path)
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(documents(spark, sf_dir), VOCABULARY)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), VOCABULARY)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir), labels(spark, sf_dir))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_job_conf(spark)
    return jaccard_join.join(documents(spark, sf_dir))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_job_conf(spark)
    return line_dedup.report(documents(spark, sf_dir))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_neighbours(documents(spark, sf_dir))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(documents(spark, sf_dir), labels(spark, sf_dir))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_job_conf(spark)
    values = ", ".join(f"('{r}', '{a}')" for r, a in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS t(rule, action)")
    return url_filters.filter_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(documents(spark, sf_dir))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), VOCABULARY)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return whitening.whiten(vectors, whitening.fit(vectors))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_job_conf(spark)
    return alignment.align(documents(spark, sf_dir), VOCABULARY, PIECES)


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(documents(spark, sf_dir))


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_bpe": op2_bpe,
    "op3_quality_rules": op3_quality_rules,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_line_dedup": op5_line_dedup,
    "op6_fingerprints": op6_fingerprints,
    "op7_toxicity": op7_toxicity,
    "op8_url_filters": op8_url_filters,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_packing": op10_packing,
    "op11_whitening": op11_whitening,
    "op12_alignment": op12_alignment,
    "op13_substring_dedup": op13_substring_dedup,
}

ORACLE = {
    "op5_line_dedup": r"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text, md5(coalesce(text, '')) AS text_id FROM documents),
        raw AS (
            SELECT doc_id, text_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos,
                   unnest(string_split(text, chr(10))) AS raw
            FROM t),
        cleaned AS (
            SELECT doc_id, text_id, pos,
                   trim(translate(raw, chr(9) || chr(13) || chr(11) || chr(12), '    '), ' ') AS line
            FROM raw),
        lines AS (
            SELECT *, regexp_replace(line, '\S*[0-9]\S*', '<*>', 'g') AS masked,
                   len(string_split(line, ' ')) AS n,
                   regexp_replace(array_to_string(string_split(line, ' ')[1:2], ' '), '\S*[0-9]\S*', '<*>', 'g') AS lead
            FROM cleaned WHERE line <> ''),
        leaves AS (SELECT n, lead FROM lines GROUP BY n, lead HAVING count(DISTINCT text_id) >= 10),
        full_lines AS (SELECT * FROM lines SEMI JOIN leaves USING (n, lead)),
        kinds AS (SELECT n, lead, masked, count(DISTINCT text_id) AS texts FROM full_lines GROUP BY ALL),
        tokens AS (
            SELECT n, lead, masked, texts, generate_subscripts(string_split(masked, ' '), 1) AS i,
                   unnest(string_split(masked, ' ')) AS token
            FROM kinds),
        total AS (SELECT n, lead, sum(texts) AS total FROM kinds GROUP BY n, lead),
        frequent AS (
            SELECT t.n, t.lead, i, token, sum(texts) AS times, sum(texts) < 0.5 * any_value(total) AS weak
            FROM tokens t JOIN total USING (n, lead) WHERE token <> '<*>'
            GROUP BY t.n, t.lead, i, token HAVING sum(texts) >= 10),
        known AS (
            SELECT t.*, f.times, coalesce(f.weak, false) AS weak
            FROM tokens t LEFT JOIN frequent f ON t.n = f.n AND t.lead = f.lead AND t.i = f.i AND t.token = f.token),
        shapes AS (
            SELECT n, lead, masked, any_value(texts) AS texts,
                   avg(CASE WHEN token = '<*>' THEN 0 ELSE 1 END) AS words,
                   avg(CASE WHEN times IS NULL THEN 0 ELSE 1 END) FILTER (i > 2) AS share,
                   count(*) FILTER (i > 2 AND weak) AS n_weak,
                   min(times) FILTER (i > 2 AND weak) AS rarest,
                   string_agg(CASE WHEN times IS NULL THEN '<*>' ELSE token END, ' ' ORDER BY i) AS pattern
            FROM known GROUP BY n, lead, masked),
        judged AS (
            SELECT *, coalesce(share >= 0.5, false) AND (
                       n_weak = 0 OR (n_weak > 1 AND 3 * sum(texts) OVER (PARTITION BY n, lead, pattern) >= 2 * rarest)) AS is_template
            FROM shapes),
        less AS (
            SELECT j.n, j.lead, j.masked, gone.i,
                   string_agg(CASE WHEN k.times IS NULL OR k.i = gone.i THEN '<*>' ELSE k.token END, ' ' ORDER BY k.i) AS pattern
            FROM judged j JOIN known gone ON j.n = gone.n AND j.lead = gone.lead AND j.masked = gone.masked
            JOIN known k ON j.n = k.n AND j.lead = k.lead AND j.masked = k.masked
            WHERE NOT j.is_template AND gone.i > 2 AND gone.weak
            GROUP BY j.n, j.lead, j.masked, gone.i),
        given AS (
            SELECT l.n, l.lead, l.masked, arg_min(l.pattern, md5(l.pattern)) AS pattern
            FROM less l SEMI JOIN (SELECT * FROM judged WHERE is_template) t
                 ON l.n = t.n AND l.lead = t.lead AND l.pattern = t.pattern
            GROUP BY l.n, l.lead, l.masked),
        taken AS (
            SELECT j.n, j.lead, j.masked,
                   CASE WHEN is_template THEN 'of ' || j.pattern WHEN g.pattern IS NOT NULL THEN 'of ' || g.pattern
                        WHEN texts >= 10 AND words >= 0.5 THEN 'is ' || j.masked END AS template
            FROM judged j LEFT JOIN given g ON j.n = g.n AND j.lead = g.lead AND j.masked = g.masked),
        found AS (
            SELECT s.doc_id, s.text_id, s.pos, s.n, s.lead, p.template
            FROM full_lines s JOIN taken p ON s.n = p.n AND s.lead = p.lead AND s.masked = p.masked
            WHERE p.template IS NOT NULL),
        recurring AS (
            SELECT n, lead, template, min((doc_id, pos)) AS first
            FROM found GROUP BY n, lead, template HAVING count(DISTINCT text_id) >= 10),
        gone AS (
            SELECT DISTINCT f.doc_id, f.text_id, f.pos FROM found f JOIN recurring r USING (n, lead, template)
            WHERE (f.doc_id, f.pos) <> r.first)
        SELECT t.doc_id, count(*) AS n_lines, count(g.pos) AS n_dropped,
               coalesce(string_agg(g.pos::VARCHAR, ',' ORDER BY g.pos), '') AS dropped_lines,
               sha256(coalesce(string_agg(raw.raw, chr(10) ORDER BY raw.pos) FILTER (g.pos IS NULL), '')) AS kept_sha256
        FROM t JOIN raw USING (doc_id, text_id) LEFT JOIN gone g USING (doc_id, text_id, pos)
        GROUP BY t.doc_id""",
    "op8_url_filters": """
        WITH u AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        s AS (
            SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM u),
        r(rule, action, rhost, rpath) AS (
            VALUES ('net/', 'block', 'net', '/'), ('example.net/en/', 'allow', 'example.net', '/en/'),
                   ('example.com/de/', 'block', 'example.com', '/de/'), ('org/fr/', 'allow', 'org', '/fr/')),
        best AS (
            SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
            FROM (SELECT DISTINCT host, path FROM s), r
            WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
            GROUP BY host, path)
        SELECT page_id, s.host, s.path, best.rule, coalesce(best.action, 'allow') AS verdict
        FROM s LEFT JOIN best ON s.host = best.host AND s.path = best.path""",
}
