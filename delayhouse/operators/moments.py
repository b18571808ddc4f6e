"""Feature parameters from stored moments of each period.

A period keeps, for each feature, how many rows it has, how many have a value, their mean and the sum of squared deviations from it. Moments of any
periods combine by the rule for parallel variances, which never subtracts large squares, so parameters over all history need
one small row per period and feature, and a period can be replaced or taken out without reading the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scoring import FEATURES, FeatureParams

SCHEMA = "feature string, rows long, present long, mean double, m2 double"
_PARTS = ("rows", "present", "mean", "m2")


def period_moments(features: DataFrame, period: str) -> DataFrame:
    """Rows ``period, feature, rows, present, mean, m2``; a feature without any value has mean and m2 0."""
    zero = F.lit(0.0)
    wide = [F.count(F.lit(1)).alias("rows")]
    for c in FEATURES:
        wide += [F.count(c).alias(f"{c}__n"), F.coalesce(F.avg(c), zero).alias(f"{c}__mean"), F.coalesce(F.var_pop(c) * F.count(c), zero).alias(f"{c}__m2")]
    each = F.array(*(
        F.struct(
            F.lit(c).alias("feature"), "rows", F.col(f"{c}__n").alias("present"), F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__m2").alias("m2")
        )
        for c in FEATURES
    ))
    return features.groupBy(F.col(period).alias("period")).agg(*wide).select("period", F.inline(each))


def _joined(a: Column, b: Column) -> Column:
    """Moments of two disjoint sets of rows together."""
    n = a["present"] + b["present"]
    share = F.when(n > 0, b["present"] / n).otherwise(0.0)
    away = b["mean"] - a["mean"]
    return F.struct(
        (a["rows"] + b["rows"]).alias("rows"), n.alias("present"), (a["mean"] + away * share).alias("mean"),
        (a["m2"] + b["m2"] + away * away * a["present"] * share).alias("m2"),
    )


def combined(moments: DataFrame) -> DataFrame:
    """One row per feature over all periods given, added up in the periods' order, so that the result is reproducible."""
    nothing = F.struct(F.lit(0).cast("long").alias("rows"), F.lit(0).cast("long").alias("present"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    parts = F.array_sort(F.collect_list(F.struct("period", *_PARTS)))  # one entry per period
    return moments.groupBy("feature").agg(F.aggregate(parts, nothing, _joined).alias("all")).select("feature", "all.*")


def without(total: DataFrame, part: DataFrame) -> DataFrame:
    """Combined moments less those of some of the periods in them, also combined."""
    a, b = total.alias("a"), part.alias("b")
    n = F.col("a.present") - F.coalesce("b.present", F.lit(0))
    m = F.coalesce("b.present", F.lit(0))
    mean = F.when(n > 0, (F.col("a.mean") * F.col("a.present") - F.coalesce("b.mean", F.lit(0.0)) * m) / n).otherwise(0.0)
    away = F.coalesce("b.mean", F.lit(0.0)) - mean
    m2 = F.col("a.m2") - F.coalesce("b.m2", F.lit(0.0)) - away * away * n * m / F.nullif(F.col("a.present"), F.lit(0))
    return a.join(b, "feature", "left").select(
        "feature", (F.col("a.rows") - F.coalesce("b.rows", F.lit(0))).alias("rows"), n.alias("present"), mean.alias("mean"),
        F.when(n > 0, F.greatest(m2, F.lit(0.0))).otherwise(0.0).alias("m2"),
    )


def parameters(total: DataFrame) -> DataFrame:
    """Rows ``feature, mean, std`` as :func:`scoring.fit_params` has them: deviations after imputing the mean."""
    return total.select("feature", "mean", F.coalesce(F.sqrt(F.col("m2") / F.nullif("rows", F.lit(0))), F.lit(0.0)).alias("std"))


def params(moments: DataFrame) -> FeatureParams:
    """Parameters over all periods given."""
    return FeatureParams.from_table(parameters(combined(moments)))
