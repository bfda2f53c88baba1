"""From raw documents to token ids, in five stages over everything the one before kept.

``run`` applies the stages to the documents table; each result is written to
the shared folder and read again as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lunario.llm import byte_bpe, exact_dedup, importance, mixing, simhash
from lunario.llm.common import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling toward the labelled good ones keeps."""
    return importance.resampled(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts equal but for white space."""
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash."""
    return simhash.deduplicated(docs, shingle=simhash.SHINGLE, radius=simhash.RADIUS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source mix takes them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests of the ids and of their decoded bytes."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.round_trip(docs, ranks, public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("quality_classifier", quality),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("source_mixing", mix),
    ("byte_bpe", encode),
]

#: SQL cannot express the hashed models, SimHash or the merges; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
