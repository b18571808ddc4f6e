from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from delayhouse.operators import analytics, quality
from delayhouse.operators.observability import enrich_events, fold_runs, run_events, task_outcome_events
from delayhouse.sources import schemas

from .conftest import values

T0 = datetime(2024, 1, 5, 10)
SCHEMA = (
    "id long, event_at timestamp, level string, layer string, dag_id string, task_id string, run_id string,"
    " event_type string, message string, vols_ingested int, exception string"
)


def events(spark, *steps):
    rows = [
        (i, T0 + timedelta(seconds=s), level, "INGESTION", "ingest_dag", "t", "r", kind, message, vols, error)
        for i, (s, level, kind, message, vols, error) in enumerate(steps)
    ]
    return enrich_events(spark.createDataFrame(rows, SCHEMA))


def folded(spark, *steps):
    return fold_runs(run_events(events(spark, *steps))).first()


def test_single_terminal_event_has_no_end(spark):
    run = folded(spark, (0, "info", "ingestion_success", "ok", 5, None))
    assert (run.status, run.finished_at, run.duration_sec, run.vols_ingested) == ("SUCCESS", None, None, 5)


def test_zero_volume_keeps_the_last_known_one(spark):
    run = folded(
        spark,
        (0, "info", "dag_started", "go", None, None),
        (10, "info", "x_success", "ok", 5, None),
        (75, "info", "x_success", "ok", 0, None),
    )
    assert (run.status, run.vols_ingested, run.finished_at) == ("SUCCESS", 5, T0 + timedelta(seconds=75))
    assert run.duration_sec == 75


def test_note_after_a_failure_reopens_the_run_and_keeps_the_error(spark):
    run = folded(
        spark,
        (0, "info", "dag_started", "go", None, None),
        (9, "error", "task_failure", "boom", None, None),
        (20, "info", "note", "hm", None, None),
    )
    assert (run.status, run.error_message, run.finished_at) == ("RUNNING", "boom", T0 + timedelta(seconds=9))


def test_equal_times_are_ordered_by_id(spark):
    run = folded(spark, (0, "error", "a", "first", None, "E1"), (0, "info", "b_success", "ok", None, None))
    assert (run.status, run.finished_at, run.duration_sec, run.error_message) == ("SUCCESS", T0, 0, "E1")


def test_fold_equals_a_sequential_replay(spark):
    import random

    rng = random.Random(7)
    steps = [
        (rng.randrange(60), rng.choice(["info", "error"]), rng.choice(["a_success", "note", "b_failure"]), f"m{i}", rng.choice([None, 0, 3, 8]), rng.choice([None, "E"]))
        for i in range(40)
    ]
    per_event = run_events(events(spark, *steps)).orderBy("event_at", "id").collect()
    state = None
    for e in per_event:
        if state is None:
            state = dict(started=e.event_at, status=e.status, vols=e.vols_ingested, end=None, error=e.error_message)
            continue
        state["status"] = e.status
        if e.status != "RUNNING":
            state["end"] = e.event_at
        state["vols"] = e.vols_ingested if e.vols_ingested > 0 else state["vols"]
        state["error"] = e.error_message if e.error_message is not None else state["error"]
    run = folded(spark, *steps)
    assert (run.started_at, run.status, run.vols_ingested, run.finished_at, run.error_message) == (
        state["started"], state["status"], state["vols"], state["end"], state["error"]
    )


def test_enrichment(spark):
    row = events(spark, (0, "error", "x", "m", 4, None)).first()
    assert (row.level, row.layer, row.app, row.extra) == ("ERROR", "ingestion", "airflow", '{"vols_ingested":4}')
    assert row.business_date == date(2024, 1, 5)


def test_empty_log_metrics(spark):
    empty = spark.createDataFrame([], schemas.EVENTS)
    assert values(analytics.log_metrics(empty)) == [(0, 0.0, 1)]
    assert values(analytics.ingestion_freshness(spark.createDataFrame([], schemas.RUNS))) == [("Aucun Run",)]
    assert values(analytics.row_count(spark, None)) == [(0,)]


def test_task_outcomes(spark):
    rows = [
        ("a", None, {"k": "1", "row_count": "2"}, None, 9),
        ("b", None, {"k": "1"}, {"k": "3"}, None),
        ("c", "boom", {"k": "1"}, None, 9),
        ("d", None, None, None, 9),
    ]
    df = spark.createDataFrame(rows, "task_id string, exception string, metrics map<string,string>, returned map<string,string>, row_count int")
    df = df.select("*", F.lit(T0).alias("event_at"), F.lit(T0).alias("logical_date"), F.lit("d").alias("dag_id"), F.lit("r").alias("run_id"))
    out = {r.task_id: (r.level, r.extra) for r in task_outcome_events(df, "RAW", "ok").collect()}
    assert out == {
        "a": ("INFO", {"k": "1", "row_count": "2"}),
        "b": ("INFO", {"k": "3"}),
        "c": ("ERROR", {"exception": "boom"}),
        "d": ("INFO", {"row_count": "9"}),
    }


def test_gate_raises_on_errors_and_lists_warnings(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "k string")
    assert quality.run_quality_gate([quality.check_unique(df, "k", "warn")]) == ["unique:table.k"]
    with pytest.raises(quality.QualityGateError, match="unique:table.k"):
        quality.run_quality_gate([quality.check_unique(df, "k")])
    assert quality.check_not_null(df, "k").first().failures == 2
    assert quality.check_row_count(df.limit(0)).first().status == "error"


def test_freshness_levels(spark):
    df = spark.createDataFrame([(T0,)], "t timestamp")
    ages = [(T0 + timedelta(days=d)) for d in (7, 8, 15)]
    got = [quality.check_freshness(df, "t", a).first().status for a in ages]
    assert got == ["pass", "warn", "error"]
    assert quality.check_freshness(df.limit(0), "t", T0).first().status == "error"
