"""The operators as stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame.

All stages but the last take and return the columns of ``documents``; repeated rows and null values pass as the operators
define it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from . import mixing, near_dedup, packing, quality, secrets
from .common import table


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it is fitted on the labelled ones among ``docs``."""
    return quality.accepted(spark, docs, quality.fit(spark, docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, by shingles of five words."""
    return near_dedup.deduplicated(spark, docs, width=5)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts."""
    return secrets.redacted(spark, docs, scratch_path(spark, "ledger"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeated(spark, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    return packing.pack_documents(spark, docs)
