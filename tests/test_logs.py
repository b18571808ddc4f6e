"""Late events, silent runs, newest days, footers and typed payloads."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from delayhouse.operators import observability, payloads
from delayhouse.session import scratch_path
from delayhouse.sources import footers, tables
from delayhouse.streaming import logs

from .conftest import values
from .test_plans import plan

T0 = datetime(2024, 1, 5)
EVENTS = "id long, event_at timestamp, level string"


def events(spark, rows):
    return spark.createDataFrame([(i, T0 + timedelta(minutes=m), level) for i, m, level in rows], EVENTS)


@pytest.mark.parametrize("lateness", ["0 seconds", "1 hour", "100 days"])
def test_late_events_correct_closed_windows(spark, lateness):
    rng = random.Random(4)
    rows = [(i, rng.randrange(3000), "ERROR" if i % 5 == 0 else "INFO") for i in range(200)]
    landed, target, state = (scratch_path(spark, n) for n in ("landed", "rates", "state"))
    for wave in (rows[:80], rows[80:150], rows[150:]):
        events(spark, wave).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(EVENTS).parquet(landed)
        logs.stream_corrected_rates(stream, "2 hours", "1 hour", lateness, target, state).awaitTermination()
    got = logs.corrected_rates(spark, target)
    whole = logs.event_rates(events(spark, rows), "2 hours", "1 hour")
    assert values(got.select(whole.columns)) == values(whole)
    late = got.agg(F.sum("late_events")).first()[0]
    assert (late == 0) == (lateness == "100 days")
    newest = max(m for _, m, _ in rows[:80])
    if lateness == "0 seconds":  # of the second wave, at least what lies in windows that the first one closed
        closed = sum(m < (newest // 60) * 60 - 60 for _, m, _ in rows[80:150])
        assert late >= closed > 0


def runs(spark, rows):
    full = [(i, T0 + timedelta(minutes=m), run, status) for i, (run, m, status) in enumerate(rows)]
    return spark.createDataFrame(full, "id long, event_at timestamp, run_id string, status string")


def test_silent_runs_are_told_and_forgotten(spark):
    rows = [("a", 0, "RUNNING"), ("a", 30, "SUCCESS"), ("b", 5, "RUNNING"), ("b", 64, "RUNNING"), ("c", 0, "RUNNING"), ("c", 61, "RUNNING"), ("d", 300, "RUNNING")]
    got = observability.run_episodes(runs(spark, rows), "1 hour")
    assert values(got.select("run_id", "events", "status", "abandoned")) == [
        ("a", 2, "SUCCESS", False), ("b", 2, "RUNNING", True), ("c", 1, "RUNNING", True), ("c", 1, "RUNNING", True), ("d", 1, "RUNNING", True),
    ]
    landed, target, state = (scratch_path(spark, n) for n in ("landed", "episodes", "state"))
    kept = []
    for wave in (rows[:6], rows[6:]):
        runs(spark, wave).coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(runs(spark, rows).schema).parquet(landed).withWatermark("event_at", "0 seconds")
        query = observability.run_episodes(stream, "1 hour").writeStream.outputMode("append").format("parquet").option("path", target).option("checkpointLocation", state).trigger(availableNow=True).start()
        query.awaitTermination()
        kept.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    stored = spark.read.schema(got.schema).parquet(target)
    assert values(stored) == values(got.filter("run_id <> 'd'"))
    assert kept[-1] == 1  # only the run that still may speak


def test_newest_days_do_not_grow_with_the_log(spark):
    def log(days):
        path = scratch_path(spark, "log")
        rows = [(d * 10 + i, T0 + timedelta(days=d, hours=i % 3)) for d in range(days) for i in range(10)]
        frame = spark.createDataFrame(rows, "id long, event_at timestamp").coalesce(1)
        tables.append_events(frame, path, "one")
        schema = frame.withColumns({"event_day": F.to_date("event_at"), "batch": F.lit("")}).schema
        newest = tables.newest_days(spark, path, schema, 25)
        best = newest.orderBy(F.desc("event_at"), F.desc("id")).limit(25)
        assert values(best.select("id", "event_at")) == values(frame.orderBy(F.desc("event_at"), F.desc("id")).limit(25))
        return newest.select(F.input_file_name()).distinct().count()

    assert log(10) == log(40) == 3
    assert log(2) == 2


def test_newest_days_with_events_without_a_time(spark):
    path = scratch_path(spark, "log")
    frame = spark.createDataFrame([(1, T0), (2, None)], "id long, event_at timestamp")
    tables.append_events(frame, path, "one")
    schema = frame.withColumns({"event_day": F.to_date("event_at"), "batch": F.lit("")}).schema
    assert tables.newest_days(spark, path, schema, 1).count() == 1 and tables.newest_days(spark, path, schema, 5).count() == 2


def test_footers_answer_without_reading_columns(spark):
    path = scratch_path(spark, "source")
    rows = spark.range(1000).select(F.col("id").cast("string").alias("name"), (F.col("id") * 1_000_000).alias("fetched_us"), (F.col("id") % 3).cast("string").alias("period"))
    rows.write.partitionBy("period").parquet(path)
    asked = footers.footer_aggregates(spark, path, "fetched_us")
    text = plan(asked)
    assert "PushedAggregation: [MAX(fetched_us), COUNT(*)]" in text and "Join" not in text, text
    assert asked.first() == (999_000_000, 1000)
    ages = footers.source_ages(spark, {"here": path, "gone": f"{path}-gone"}, "fetched_us")
    assert {r.source: (r.newest and r.newest.second, r.rows) for r in ages.collect()} == {"here": (39, 1000), "gone": (None, 0)}
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_payloads_are_typed_and_broken_ones_told(spark):
    texts = ['{"vols_ingested":5,"other":{"deep":[1,2]}}', '{"vols_ingested":"x"}', '{"vols', None, "[1]"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, extra string")
    found = payloads.with_payload(rows).select("id", "broken", payloads.member("vols_ingested", "bigint").alias("n"), payloads.member("other.deep[1]", "int").alias("deep"))
    assert values(found) == [(0, False, 5, 2), (1, False, None, None), (2, True, None, None), (3, False, None, None), (4, False, None, None)]
    assert payloads.broken_payloads(payloads.with_payload(rows)).first() == (5, 3, 1)
