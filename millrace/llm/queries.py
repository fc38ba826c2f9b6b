"""The named queries of this folder, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import ship_package
from .bpe import encode_column, local_ranks
from .chaining import repeated_passages
from .coordinate_search import hard_negatives
from .ctw import score_documents
from .kneser_ney import classify
from .mixing import mix_report
from .ngram_join import jaccard_components
from .quality_rules import judge_quality
from .run_length_index import without_long_repeats
from .url_filter import judge_urls
from .vector_tiles import nearest
from .whitening import whiten
from .wrappers import main_text

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Run
    sql: str | None = None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return self.build(spark, sf_dir)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(_table(spark, sf_dir, "documents"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(_table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')) AS place
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1 AS rank FROM sources),
capped AS (
  SELECT source, source_size, rank, source_size * 3 AS cap,
    CASE rank % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM ranked),
known AS (
  SELECT *, sum(source_size) OVER () AS total,
    coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
    sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM capped),
judged AS (SELECT *, cap * rest <= (total - below) * weight AS is_full FROM known),
level AS (
  SELECT *, min(CASE WHEN NOT is_full THEN below END) OVER () AS open_below,
    max(CASE WHEN NOT is_full THEN rest END) OVER () AS open_rest FROM judged),
targets AS (
  SELECT source, source_size,
    CASE WHEN is_full THEN cap::DOUBLE ELSE (total - open_below)::DOUBLE * weight / open_rest END AS target
  FROM level),
plan AS (
  SELECT *, least(floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END), 3)::BIGINT AS whole
  FROM targets),
steps AS (
  SELECT s.source, s.place, p.target - p.whole * p.source_size AS want,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place RANGE UNBOUNDED PRECEDING) AS taken
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
cuts AS (
  SELECT source, arg_min(place, (abs(taken - want), place)) AS cut
  FROM (SELECT * FROM steps UNION ALL SELECT source, '' AS place, min(want), 0 FROM steps GROUP BY source)
  GROUP BY source)
SELECT s.doc_id, s.size, p.source_size, p.target,
  ((p.whole + CASE WHEN s.place <= c.cut THEN 1 ELSE 0 END) * s.size)::BIGINT AS taken
FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
JOIN cuts c ON s.source IS NOT DISTINCT FROM c.source
"""



def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = local_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return encode_column(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_table(spark, sf_dir, "pages"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    found = nearest(vectors.where(F.col("vec_id") % 50 == 0), vectors, k=5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_table(spark, sf_dir, "documents")).drop("variant")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"))


def op12_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_long_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(_table(spark, sf_dir, "embeddings"))


OP13_SQL = """
WITH whole AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256.0::DOUBLE * c::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT a.id AS anchor_id, c.id, a.label = c.label AS same,
    list_inner_product(a.x, c.x)::BIGINT AS score
  FROM whole a JOIN whole c ON a.id % 100 = 0 AND a.id <> c.id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""


QUERIES: dict[str, Query] = {
    "op1_byte_bpe": Query(op1_byte_bpe),
    "op2_url_filter": Query(op2_url_filter),
    "op3_ngram_join": Query(op3_ngram_join),
    "op4_quality_rules": Query(op4_quality_rules),
    "op5_lm_scoring": Query(op5_lm_scoring),
    "op6_mixing": Query(op6_mixing, OP6_SQL),
    "op7_quality_classifier": Query(op7_quality_classifier),
    "op8_html_extraction": Query(op8_html_extraction),
    "op9_nearest": Query(op9_nearest),
    "op10_substring_dedup": Query(op10_substring_dedup),
    "op11_whitening": Query(op11_whitening),
    "op12_run_length_index": Query(op12_run_length_index),
    "op13_hard_negatives": Query(op13_hard_negatives, OP13_SQL),
}
