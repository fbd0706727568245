"""Registered queries of the operators, over the whole given tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from arrivo.llm import (
    ann_tree,
    kneser_ney,
    langid_gru,
    line_dedup,
    mixing,
    packing,
    partenum,
    periods,
    pii_crf,
    quality_mil,
    quality_rules,
    spelling,
    token_orc,
)
from arrivo.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality_mil.score_documents(docs, quality_mil.fit(docs, read(spark, sf_dir, "labels")))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality_rules.apply_rules(docs, quality_rules.fit(docs, read(spark, sf_dir, "labels")))


@query
def op8_language_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return langid_gru.predict_documents(docs, langid_gru.fit(docs))


@query
def op3_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    token_orc.write_ids(read(spark, sf_dir, "documents"), path)
    return token_orc.digest(token_orc.read_ids(spark, path))


@query
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, pieces = mixing.mix(read(spark, sf_dir, "documents"))
    return mixing.taken_words(documents, pieces).drop("row")


# targets as least fixed point: the level is the largest of those that the sources, filled in order, leave
SQL["op4_source_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place
  FROM documents),
sources AS (
  SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number
  FROM sized GROUP BY source),
weighed AS (SELECT *, CASE number % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight, 3.0::DOUBLE * source_size AS most FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY most / weight, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (SELECT *, least(most, weight * max(level) OVER ()) AS target FROM levels),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS words,
    sum(d.size) OVER (PARTITION BY t.number ORDER BY substr(d.place, 1, 15), d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS first
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, CAST(
  greatest(least(first + size, words) - first, 0)
  + greatest(least(first + source_size + size, words) - (first + source_size), 0)
  + greatest(least(first + 2 * source_size + size, words) - (first + 2 * source_size), 0) AS BIGINT) AS taken
FROM placed
"""


@query
def op5_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(read(spark, sf_dir, "documents")))


@query
def op6_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_tree.neighbours(read(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


@query
def op9_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return kneser_ney.score_documents(docs, kneser_ney.fit(kneser_ney.training_rows(docs)))


@query
def op10_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.Join(read(spark, sf_dir, "documents")).documents().select("doc_id", "n_shingles", "component_id")


@query
def op2_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pii_crf.find_spans(docs, pii_crf.fit(docs))


@query
def op11_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.digest(read(spark, sf_dir, "documents"), plant=True)


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"), misspelt=199)


@query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(read(spark, sf_dir, "documents"))


SQL["op13_line_dedup"] = r"""
WITH split AS (
  SELECT row_number() OVER () AS place, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
numbered AS (
  SELECT place, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS number FROM split),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM numbered),
repeated AS (
  SELECT key, max(doc_id) AS kept FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT k.*, coalesce(k.doc_id <> r.kept, false) AS gone FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY number) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY place, doc_id
"""
