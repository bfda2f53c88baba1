"""Registered queries of the text operators: thin readers of the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lunario.llm import (
    byte_bpe,
    collocations,
    exact_dedup,
    fingerprints,
    importance,
    language_model,
    mixing,
    piece_bpe,
    repeats,
    secret_scan,
    simhash,
    spelling,
    warc,
)
from lunario.llm.common import table


RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return byte_bpe.round_trip(documents, RANKS, public_tokenizers.PATTERN)


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared_with_next(table(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    printed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", printed.alias("fingerprint"), "component_id")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(table(spark, sf_dir, "documents")).drop("text_hash")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scores(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return importance.decisions(documents, labels).drop("text_hash")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.decisions(table(spark, sf_dir, "documents")).drop("text_hash")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.round_trip(table(spark, sf_dir, "documents"), PIECES)


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = (
        op1_byte_bpe,
        op2_document_fingerprints,
        op3_simhash_near_dedup,
        op4_warc,
        op5_exact_dedup,
        op6_suffix_array_dedup,
        op7_language_model,
        op8_quality_classifier,
        op9_secret_scan,
        op10_source_mixing,
        op11_sentencepiece,
        op12_phrase_collocations,
        op13_spelling_variants,
    )
    return {query.__name__: query for query in registered}
