"""The operators as queries over the given tables, with production settings, and their SQL where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, cotraining, jaccard, langid, licenses, lines, merkle, mixing, oracle, pii, quality, search, sharding, spotsigs
from .common import table

RANKS = "byte_bpe_50k.tiktoken"
SHARDS = 8


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and Jensen-Shannon distance to the language's reference."""
    return quality.rate(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text and their way back, as digests."""
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    return bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, files=True)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendezvous hashing of doc_id over eight shards, and over nine."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"), [1.0] * SHARDS)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated runs of lines."""
    return lines.line_report(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and labels by diagonal voting."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the co-trained classifier."""
    return cotraining.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-gram sets have a Jaccard of 0.8 or more."""
    return jaccard.join_documents(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data."""
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spot signature fingerprints of texts and edited texts."""
    return spotsigs.fingerprints(table(spark, sf_dir, "documents"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text by naive Bayes, learned from the documents that are not held out."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every row, its way to the root and whether it still leads there."""
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that rank highest for each benchmark item."""
    return search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_bpe, op3_sharding, op4_line_dedup, op5_license_scan, op6_quality_classifier,
        op7_ngram_jaccard, op8_mixing, op9_pii, op10_spotsigs, op11_language_id, op12_merkle_manifest,
        op13_lexical_search,
    )
}

ORACLE_SQL: dict[str, str] = {"op12_merkle_manifest": oracle.MERKLE, "op13_lexical_search": oracle.SEARCH}
