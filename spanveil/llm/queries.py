"""The operators with production parameters over whole tables, and SQL with the same results."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from spanveil.llm import (chat, decontaminate, filter_audit, html_text, jaccard, licenses, neighbours, packing, quality, runs, secret_scan,
                          toxicity, urls)
from spanveil.llm.text import fold

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (packing.pack(_read(spark, sf_dir, "documents"), VOCABULARY, keep_ids=False)
            .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan_licenses(_read(spark, sf_dir, "documents"), keep=["doc_id"]))


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    return (urls.judge(pages.select("page_id", "url"), urls.word_counts(pages))
            .select("page_id", "host", "path", "rule", "verdict", "score"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    scored = quality.score_quality(docs, quality.fit(docs, _read(spark, sf_dir, "labels")), ["doc_id"])
    return scored.select("doc_id", (fold(F.col("doc_id"), quality.FOLDS) == quality.HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.find_passages(
        _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), keep=["doc_id"]))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(_read(spark, sf_dir, "conversations"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan_secrets(_read(spark, sf_dir, "documents"), keep=["doc_id"]))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_read(spark, sf_dir, "documents"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(_read(spark, sf_dir, "embeddings"), every=20, k=20)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    scored = toxicity.score_toxicity(docs, toxicity.fit(docs, _read(spark, sf_dir, "labels")), ["doc_id"])
    return scored.select("doc_id", (fold(F.col("doc_id"), toxicity.FOLDS) == toxicity.HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.find_runs(runs.with_repeats(_read(spark, sf_dir, "documents")), keep=["doc_id"]))


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.fit(pages), keep=["page_id", "url"])


def op13_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.failures(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pack, op2_licenses, op3_urls, op4_quality, op5_decontaminate, op6_chat, op7_secrets,
                            op8_jaccard, op9_neighbours, op10_toxicity, op11_runs, op12_main_text, op13_filters)}
QUERIES["pipeline"] = corpus_pipeline.run

ORACLE: dict[str, str] = {
    "op6_chat": """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
             count(*) OVER (PARTITION BY conv_id) AS n FROM t),
s AS (SELECT *, list({'role': role, 'text': text}) OVER (PARTITION BY conv_id ORDER BY i) AS prefix FROM p),
f AS (SELECT min(conv_id) AS conv_id, n, prefix, count(*) AS n_same FROM s WHERE i = n GROUP BY n, prefix),
m AS (SELECT conv_id, n, n_same FROM f
      WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.i < s.n AND s.i = f.n AND s.prefix = f.prefix))
SELECT m.conv_id, m.n AS n_turns, m.n_same, (p.i - 1) // 256 AS part,
       string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' ORDER BY p.i) AS text
FROM m JOIN p ON p.conv_id = m.conv_id GROUP BY m.conv_id, m.n, m.n_same, (p.i - 1) // 256
""",
    "op13_filters": r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
             || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
             || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
             || CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS failed
      FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
g AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, failed),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM x a, x b, x c, x d, x e
      WHERE a.c <> b.c AND c.c NOT IN (a.c, b.c) AND d.c NOT IN (a.c, b.c, c.c) AND e.c NOT IN (a.c, b.c, c.c, d.c)),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS c, filter_order[:step - 1] AS past
      FROM o, generate_series(1, 5) AS t(step)),
r AS (SELECT g.part, s.filter_order, s.step, s.c, n, good, toxic, contains(failed, s.c) AS fails, failed = s.c AS only_this,
             regexp_matches(failed, '[' || s.past || '0]') AS gone
      FROM g, s),
k AS (SELECT part, filter_order, step, c,
             CAST(sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS BIGINT) AS kept,
             CAST(sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS BIGINT) AS removed,
             CAST(sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS BIGINT) AS redundant,
             CAST(sum(CASE WHEN only_this THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
             CAST(sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END) AS BIGINT) AS good_lost,
             CAST(sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
      FROM r GROUP BY part, filter_order, step, c)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, c) AS BIGINT) AS shapley
FROM k
""",
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
