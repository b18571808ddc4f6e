"""Moments of periods against one pass over all rows."""

import random

import pytest
from pyspark.sql import functions as F

from delayhouse.operators import moments, scoring


@pytest.fixture(scope="module")
def features(spark):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        # Large means with small spread, values missing, one feature without any value in a period, a constant one.
        values = [1e9 + rng.random(), rng.gauss(0, 5), None if i % 7 == 0 else rng.gauss(100, 1), 3.0, None if i % 5 == 2 else float(i)]
        values += [rng.random() for _ in range(len(scoring.FEATURES) - len(values))]
        rows.append((f"2024-0{i % 5 + 1}", *values))
    columns = ", ".join(f"{c} double" for c in scoring.FEATURES)
    return spark.createDataFrame(rows, f"period string, {columns}").repartition(4).cache()


def same(got, want):
    for c in scoring.FEATURES:
        assert got.means[c] == pytest.approx(want.means[c], rel=1e-12, abs=1e-12)
        assert got.stds[c] == pytest.approx(want.stds[c], rel=1e-6, abs=1e-9), c


def test_periods_combine_to_a_full_pass(features):
    stored = moments.period_moments(features, "period")
    assert stored.count() == 5 * len(scoring.FEATURES)
    same(moments.params(stored), scoring.fit_params(features))
    same(moments.params(stored.filter("period <> '2024-03'")), scoring.fit_params(features.filter("period <> '2024-03'")))


def test_a_period_can_be_taken_out(features):
    stored = moments.period_moments(features, "period")
    left = moments.without(moments.combined(stored), moments.combined(stored.filter("period in ('2024-01', '2024-02')")))
    same(scoring.FeatureParams.from_table(moments.parameters(left)), scoring.fit_params(features.filter("period > '2024-02'")))
    none = moments.without(moments.combined(stored), moments.combined(stored))
    assert none.filter("rows <> 0 or present <> 0 or mean <> 0 or m2 <> 0").isEmpty()


def test_no_rows(features):
    empty = moments.period_moments(features.limit(0), "period")
    assert moments.params(empty).means == {}
    one = moments.period_moments(features.filter(F.col("period") == "2024-03").withColumn(scoring.FEATURES[1], F.lit(None).cast("double")), "period")
    assert moments.params(one).means[scoring.FEATURES[1]] == 0.0 and moments.params(one).stds[scoring.FEATURES[1]] == 0.0
