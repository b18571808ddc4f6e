import uuid
from datetime import date, datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from delayhouse.functions import (
    business_date,
    delay_flag,
    delay_minutes,
    dow_sunday0,
    event_status,
    event_volumes,
    is_delayed,
    iso_minutes,
    percent_half_up,
    uuid5,
)


def column(spark, schema, rows, *expressions):
    out = spark.createDataFrame(rows, schema).select(*expressions).collect()
    return [r[0] if len(r) == 1 else tuple(r) for r in out]


def test_iso_minutes(spark):
    texts = ["PT2H25M", "PT15M", "PT3H", "00", None, "P1DT2H", "PT90S", "P1M"]
    got = column(spark, "d string", [(t,) for t in texts], iso_minutes(F.col("d")))
    assert got == [145, 15, 180, 0, 0, 120, 0, 1]


def test_delay_flag(spark):
    assert column(spark, "d string", [("00",), (None,), ("PT0M",), ("PT5M",)], delay_flag(F.col("d"))) == [0, 0, 1, 1]


def test_delay_minutes_rounds_half_away_from_zero(spark):
    base = datetime(2024, 1, 5, 10)
    rows = [(base + timedelta(seconds=s), base) for s in (30, -30, 29)] + [(None, base)]
    assert column(spark, "a timestamp, s timestamp", rows, delay_minutes(F.col("a"), F.col("s"))) == [1, -1, 0, None]


def test_is_delayed(spark):
    rows = [(15, None, None), (14, 14, 14), (None, None, None), (-20, None, 15)]
    got = column(spark, "a int, b int, c int", rows, is_delayed(F.col("a"), F.col("b"), F.col("c")))
    assert got == [True, False, False, True]


def test_sunday_is_zero(spark):
    assert column(spark, "d date", [(date(2024, 1, 7),), (date(2024, 1, 6),)], dow_sunday0(F.col("d"))) == [0, 6]


def test_event_status(spark):
    rows = [("ERROR", "x_success"), ("INFO", "api_reload"), ("INFO", "Task_FAILURE"), ("INFO", None), (None, "note")]
    got = column(spark, "l string, t string", rows, event_status(F.col("l"), F.col("t")))
    assert got == ["FAILED", "SUCCESS", "FAILED", "RUNNING", "RUNNING"]


def test_event_volumes_zero_counts_as_missing(spark):
    schema = "dag string, task string, kind string, v int, i int, t int, r int, c int"
    rows = [
        ("ingest_dag", "t", "x", 0, 7, None, None, None),
        ("d", "dbt_run", "x", 5, 0, 3, 9, 9),
        ("ingest_dag", "t", "x", 0, 0, 0, 4, 2),
        ("d", "t", "dbt_success", None, None, None, 0, 6),
        ("d", "t", "x", 5, 5, 5, 5, 5),
    ]
    got = column(spark, schema, rows, *event_volumes(*(F.col(c) for c in ("dag", "task", "kind", "v", "i", "t", "r", "c"))))
    assert got == [(7, 0), (0, 3), (4, 0), (0, 6), (0, 0)]


def test_business_date_falls_through(spark):
    schema = "e string, a string, b string, p string, l timestamp, i timestamp, n timestamp"
    l, i, n = datetime(2024, 3, 1), datetime(2024, 3, 2), datetime(2024, 3, 3)
    rows = [
        ("2024-01-01T23:00:00+00:00", "2024-01-02", None, None, l, i, n),
        ("bad", " 2024-01-02 ", None, None, l, i, n),
        (None, "bad", "bad", "2024-01-04", l, i, n),
        (None, None, None, "", l, i, n),
        (None, None, None, None, None, i, n),
        (None, None, None, None, None, None, n),
    ]
    got = column(spark, schema, rows, business_date(*(F.col(c) for c in "eabplin")))
    assert [d.isoformat()[5:] for d in got] == ["01-01", "01-02", "01-04", "03-01", "03-02", "03-03"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=20, max_size=20))
def test_uuid5_equals_the_standard_library(spark, names):
    got = column(spark, "n string", [(n,) for n in names], uuid5(F.col("n")))
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names]


def test_percent_is_exact_half_up(spark):
    rows = [(1, 800), (1, 3), (2, 3), (0, 5), (1, 0), (201, 20000)]
    got = column(spark, "a long, b long", rows, percent_half_up(F.col("a"), F.col("b"), 2))
    assert got == [0.13, 33.33, 66.67, 0.0, None, 1.01]
