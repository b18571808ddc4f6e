"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again before the next one. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from delayhouse.llm import stages
from delayhouse.llm.common import staged, table

STAGES = [
    ("quality classifier", stages.reject_low_quality),
    ("near-duplicates", stages.drop_near_duplicates),
    ("secret scans", stages.mask_secrets),
    ("source mixing", stages.mix_sources),
    ("packing", stages.pack),
]

#: Tokenisation and classification have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, from ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
