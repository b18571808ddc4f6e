"""Small helpers shared by the operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staged

__all__ = ["UNSPACED", "few_rows", "significant_bits", "staged", "table", "texts", "word_count"]

#: White space that separates words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = "[^\\x20\\x09-\\x0D]+"
#: Characters of scripts written without spaces: Thai, Lao, Myanmar, Khmer, Kana, Han.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """Identifier and text only, so that no other column can clash; a null text is empty."""
    return docs.select(F.col("doc_id").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def few_rows(batches, rows: int = 256):
    """The batches of a task in small pieces: a batch holds up to 64 MB of text, and as Python objects several times that."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def significant_bits(count: Column) -> Column:
    """Size class of a count: its four leading bits and their position, so a class is at most 12.5 % wide."""
    bits = F.length(F.bin(count))
    drop = F.greatest(bits - 4, F.lit(0))
    return (bits * 16 + F.call_function("shiftright", count, drop)).cast("int")
