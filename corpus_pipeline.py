"""From raw documents to token ids: five stages, each of them one operator over all that the stage before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns rows with the columns of ``documents``; the last returns the
digests of the encoded texts. ``run`` writes each stage's rows as Parquet below ``spark.checkpoint.dir`` and reads them
again for the next. Stages neither cap nor sample; the classifier learns from all labelled rows.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm.bpe import encode_column, local_ranks
from millrace.llm.chaining import without_repeats
from millrace.llm.common import ship_package, stored
from millrace.llm.kneser_ney import kept_documents
from millrace.llm.mixing import mix_documents
from millrace.llm.ngram_join import one_of_each


def trusted_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Kneser-Ney classifier keeps."""
    ship_package(spark)
    return kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_near_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies."""
    ship_package(spark)
    return one_of_each(docs)


def no_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document with a smaller id has too."""
    ship_package(spark)
    return without_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mix_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document in the mix."""
    ship_package(spark)
    ranks = local_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return encode_column(docs, ranks, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", trusted_quality),
    ("n-gram Jaccard join", one_near_copy),
    ("substring dedup", no_repeated_passages),
    ("mixing sources", source_mix),
    ("byte-level BPE", token_ids),
]

#: Chaining, Kneser-Ney scoring and byte-pair merges have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{number + 1}")
    return docs
