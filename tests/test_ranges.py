"""Range questions from daily sketches, bitmaps and counts."""

import random

from delayhouse.operators import ranges


def test_bitmaps_count_legs_of_any_range_once(spark):
    rng = random.Random(1)
    rows = [(f"2024-01-{rng.randrange(1, 29):02d}", f"leg{rng.randrange(900)}") for _ in range(2500)] + [("2024-01-03", None)]
    legs = spark.createDataFrame(rows, "day string, leg_id string").repartition(3)
    numbers = ranges.numbered(legs, buckets=3)
    bitmaps, sketches = ranges.day_bitmaps(legs, numbers).cache(), ranges.day_sketches(legs).cache()
    assert bitmaps.count() <= 28 * 3
    for first, last in (("2024-01-01", "2024-01-31"), ("2024-01-05", "2024-01-05"), ("2024-01-10", "2024-01-12"), ("2025-01-01", "2025-02-01")):
        want = len({i for d, i in rows if i and first <= d <= last})
        assert ranges.distinct_legs(bitmaps, first, last).first()[0] == want
        about = ranges.about_distinct_legs(sketches, first, last).first()[0]
        assert abs(about - want) <= 0.06 * want


def test_numbers_stay_and_new_ids_follow(spark):
    frame = lambda names: spark.createDataFrame([(n,) for n in names], "leg_id string")
    first = ranges.numbered(frame([f"a{i}" for i in range(100)] + ["a1", None]), buckets=4).cache()
    both = ranges.numbered(frame([f"a{i}" for i in range(0, 100, 2)] + [f"b{i}" for i in range(50)]), first, buckets=4)
    rows = [tuple(r) for r in both.collect()]
    assert {tuple(r) for r in first.collect()} <= set(rows) and len(rows) == 150
    for bucket in range(4):
        mine = sorted(n for _, b, n in rows if b == bucket)
        assert mine == list(range(len(mine)))


def test_rates_add_up(spark):
    rows = [("2024-01-01", 1), ("2024-01-01", 0), ("2024-01-02", 0), ("2024-01-05", 1)]
    rates = ranges.day_rates(spark.createDataFrame(rows, "day string, delay_predicted int"))
    assert ranges.predicted_rate(rates, "2024-01-01", "2024-01-03").first()[0] == 33.3
    assert ranges.predicted_rate(rates, "2024-01-03", "2024-01-04").first()[0] is None
