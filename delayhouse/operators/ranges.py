"""Distinct legs and prediction rates of any range of days, from what each day stores.

A day keeps a sketch of its legs, an exact bitmap of their numbers, and its counts of scored and of predicted-late legs. Sketches and bitmaps of
a range are united, counts are added, so a question about years reads a few rows per day and never the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .analytics import percent_half_up

#: Size of a sketch as a power of two: a relative error of about 1.04 / sqrt(2^12) = 1.6 percent.
PRECISION = 12
#: Ids of a bucket are numbered from 0, so that bitmaps are dense.
BUCKETS = 64
#: Buckets that the ids of one day are dealt to: few, so that a day needs few bitmaps, but not one, as a day may be large.
DAY_BUCKETS = 4


def numbered(ids: DataFrame, known: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``leg_id, bucket, number`` of all ids: those of ``known`` as they are, new ones behind them.

    A bucket is a hash, so its ids can be put in order by one task; take as many buckets as that needs. Ids with a ``day`` are
    numbered by their first day, and a day falls into few buckets, so its numbers lie together and its bitmaps are full: there are about as
    many as days, and blocks of ids, but not as their product.
    """
    known_ids = ids.filter("leg_id is not null")
    if "day" in ids.columns:
        fresh = known_ids.groupBy("leg_id").agg(F.min("day").alias("day"))
        hashed, ordered = F.xxhash64("day", F.pmod(F.xxhash64("leg_id"), F.lit(DAY_BUCKETS))), ["day", "leg_id"]
    else:
        fresh, hashed, ordered = known_ids.select("leg_id").distinct(), F.xxhash64("leg_id"), ["leg_id"]
    bucket = F.pmod(hashed, F.lit(buckets)).cast("int").alias("bucket")
    order = Window.partitionBy("bucket").orderBy(*ordered)
    if known is None:
        return fresh.select(*ordered, bucket).select("leg_id", "bucket", (F.row_number().over(order) - 1).cast("long").alias("number"))
    used = known.groupBy("bucket").agg((F.max("number") + 1).alias("used"))
    fresh = fresh.join(known.select("leg_id"), "leg_id", "left_anti").select(*ordered, bucket).join(used, "bucket", "left")
    number = (F.row_number().over(order) - 1 + F.coalesce("used", F.lit(0))).cast("long").alias("number")
    return known.select("leg_id", "bucket", "number").unionByName(fresh.select("leg_id", "bucket", number))


def day_sketches(legs: DataFrame) -> DataFrame:
    """``day, sketch`` of rows ``day, leg_id``."""
    return legs.filter("leg_id is not null").groupBy("day").agg(F.hll_sketch_agg("leg_id", PRECISION).alias("sketch"))


def day_bitmaps(legs: DataFrame, numbers: DataFrame) -> DataFrame:
    """``day, bucket, block, bits`` of rows ``day, leg_id``."""
    number = F.col("number") + 1  # the built-in blocks begin at 1
    placed = legs.join(numbers, "leg_id").select(
        "day", "bucket", F.bitmap_bucket_number(number).alias("block"), F.bitmap_bit_position(number).alias("bit")
    )
    # Dealt out before they are drawn: a bitmap is 4 KB however few bits it has, so no task may draw a part of every one.
    return placed.repartition("day", "bucket", "block").groupBy("day", "bucket", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def _between(days: DataFrame, first: str, last: str) -> DataFrame:
    return days.filter(F.col("day").between(first, last))


def distinct_legs(bitmaps: DataFrame, first: str, last: str) -> DataFrame:
    """Exact number of distinct legs on the days from ``first`` to ``last``; a leg on several days counts once."""
    united = _between(bitmaps, first, last).groupBy("bucket", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("legs"))


def about_distinct_legs(sketches: DataFrame, first: str, last: str) -> DataFrame:
    """As :func:`distinct_legs`, from the sketches."""
    estimate = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return _between(sketches, first, last).agg(F.coalesce(estimate, F.lit(0)).alias("legs"))


def day_rates(scored: DataFrame) -> DataFrame:
    """``day, scored, late`` of rows ``day, delay_predicted``, one for each scored leg."""
    late = F.sum(F.when(F.col("delay_predicted") == 1, 1).otherwise(0))
    return scored.groupBy("day").agg(F.count(F.lit(1)).alias("scored"), late.alias("late"))


def predicted_rate(rates: DataFrame, first: str, last: str) -> DataFrame:
    """Percentage of the scored legs of the days that are predicted late; null without any."""
    return _between(rates, first, last).agg(percent_half_up(F.sum("late"), F.sum("scored"), 1).alias("predicted_rate"))
