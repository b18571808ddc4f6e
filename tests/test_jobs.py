import json
import os
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from delayhouse.operators import mart, scoring
from delayhouse.plans import jobs
from delayhouse.plans.build import build_features
from delayhouse.session import scratch_path
from delayhouse.sources.storage import path_exists, pruned
from delayhouse.streaming.ingest import stream_ingest

from .conftest import values

NOW = datetime(2024, 3, 1, tzinfo=timezone.utc)
FIRST = date(2024, 1, 1)


def document(day, n, minutes):
    when = datetime.combine(day, datetime.min.time()) + timedelta(hours=n % 20)
    stamp = lambda t: t.strftime("%Y-%m-%dT%H:%M:%SZ")
    info = [{"delayCode": "9", "delayDuration": f"PT{minutes}M"}] if minutes else []
    end = lambda code, t, late: {"airport": {"code": code, "name": code}, "times": {"scheduled": stamp(t), "actual": stamp(t + timedelta(minutes=late))}}
    leg = {
        "departureInformation": end(f"N{n % 3}", when, minutes),
        "arrivalInformation": end(f"N{(n + 1) % 3}", when + timedelta(hours=2), 0),
        "scheduledFlightDuration": "PT2H",
        "aircraft": {"typeCode": f"A{n % 2}"},
        "irregularity": {"cancelled": "N", "delayInformation": info},
    }
    return {"id": f"{day:%Y%m%d}+XX+{n}", "flightNumber": n, "flightScheduleDate": day.isoformat(), "airline": {"code": "XX", "name": "Ex"}, "flightLegs": [leg]}


def land(spark, path, docs):
    lines = [(json.dumps({"page": {"totalPages": 1}, "operationalFlights": [d]}),) for d in docs]
    spark.createDataFrame(lines, "value string").write.mode("append").text(path)


def month():
    return [document(FIRST + timedelta(days=d), n, (d * n) % 40 if n % 2 else 0) for d in range(20) for n in range(4)]


@pytest.fixture(scope="module")
def house(spark):
    """Twenty days ingested and transformed, then one early flight changed, ingested and refreshed."""
    root, pages = scratch_path(spark, "house"), scratch_path(spark, "pages")
    house = jobs.Warehouse(root, by="month")
    land(spark, pages, month())
    counts = jobs.run_ingest(spark, pages, house, "2024-01-01", "2024-01-20", now=NOW)
    assert (counts["flights"], counts["legs"], counts["delays"]) == (80, 80, 80)
    assert jobs.run_transform(spark, house) == []
    changed = document(FIRST + timedelta(days=4), 2, 55)
    update = scratch_path(spark, "update")
    land(spark, update, [changed])
    docs = jobs.documents.read_flight_documents(spark, update, datetime(2024, 1, 1), datetime(2024, 1, 31))
    again = jobs.store_documents(spark, docs, house, NOW)
    assert again["dates"] == ["2024-01-05"]
    jobs.run_transform(spark, house, again["dates"])
    return house


def test_ingest_resumes_after_the_finished_window(spark, house):
    state = jobs.documents.read_checkpoint(spark, house.path("checkpoint"))
    assert state == "2024-01-20T23:59:59+00:00"
    assert jobs.documents.resolve_window(state, None, NOW)[0].date() == date(2024, 1, 21)


def test_refresh_of_touched_dates_equals_a_full_build(spark, house):
    raw = jobs.read_raw(spark, house)
    full = mart.fct_flight_legs(build_features(raw))
    fact = jobs.read_fact(spark, house).select(*full.columns)
    assert fact.count() == 80
    assert values(fact) == values(full)
    late = fact.filter(F.col("date_key") == "2024-01-05").filter("flight_number = 2").first()
    assert late.is_delayed and late.departure_delay_minutes == 55


def test_stored_dates_prune_partitions(spark, house):
    fact = jobs.read_raw(spark, jobs.Warehouse(house.root, by="month")).flights
    plan = pruned(fact, "period", {"2024-01"})._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(period" in plan


def test_vanished_legs_leave_no_children(spark):
    house = jobs.Warehouse(scratch_path(spark, "shrink"))
    pages = scratch_path(spark, "pages")
    two, one = document(FIRST, 1, 5), document(FIRST, 1, 5)
    two["flightLegs"] = two["flightLegs"] * 2
    for doc in (two, one):
        land(spark, pages, [doc])
    read = lambda d: spark.createDataFrame([json.dumps(d)], "string").select(F.from_json("value", jobs.schemas.FLIGHT_DOCUMENT).alias("d")).select("d.*")
    jobs.store_documents(spark, read(two), house, NOW)
    assert jobs.read_raw(spark, house).legs.count() == 2
    jobs.store_documents(spark, read(one), house, NOW)
    raw = jobs.read_raw(spark, house)
    assert (raw.flights.count(), raw.legs.count(), raw.delays.count()) == (1, 1, 1)


def pages_of(docs, total=1):
    return [json.dumps({"page": {"pageNumber": n, "totalPages": total}, "operationalFlights": [d]}) for n, d in enumerate(docs)]


def land_text(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_the_last_landed_document_wins_in_batch_and_stream(spark, tmp_path):
    """Whatever the order of the values, and within one file."""
    for first, last in (("ON_TIME", "ARRIVED"), ("ARRIVED", "ON_TIME")):
        folder = tmp_path / f"{first}-first"
        told = [document(FIRST, 1, 5) | {"flightStatusPublic": s} for s in (first, last)]
        land_text(folder, "one.json", [json.dumps({"page": {"totalPages": 1}, "operationalFlights": told})])
        land_text(folder, "two.json", pages_of([document(FIRST, 2, 5) | {"flightStatusPublic": first}]))
        os.utime(folder / "two.json", (1_700_000_000, 1_700_000_000))
        land_text(folder, "three.json", pages_of([document(FIRST, 2, 5) | {"flightStatusPublic": last}]))
        batch, stream = (jobs.Warehouse(scratch_path(spark, n)) for n in ("batch", "stream"))
        jobs.run_ingest(spark, str(folder), batch, "2024-01-01", now=NOW)
        stream_ingest(spark, str(folder), stream, scratch_path(spark, "state"), NOW).awaitTermination()
        for house in (batch, stream):
            assert [r.flight_status_public for r in jobs.read_raw(spark, house).flights.collect()] == [last, last]


def test_late_cut_and_unusable_pages_are_kept_track_of(spark, tmp_path):
    house, folder = jobs.Warehouse(scratch_path(spark, "tracked")), tmp_path / "landed"
    two = [document(FIRST, 1, 5), document(FIRST, 2, 5)]
    land_text(folder, "a.json", [pages_of(two, total=2)[0], '{"page":{"totalPages":2},"operat', json.dumps({"operationalFlights": [document(FIRST, 3, 0) | {"flightScheduleDate": None}]})])
    first = jobs.run_ingest(spark, str(folder), house, "2024-01-01", now=NOW)
    assert (first["status"], first["flights"], first["pages_skipped"], first["flights_rejected"]) == ("PARTIAL", 1, 1, 1)
    assert first["days_missing"] == ["2024-01-01"] and jobs.documents.read_checkpoint(spark, house.path("checkpoint")) is None
    assert spark.read.parquet(house.path("rejects")).count() == 2

    land_text(folder, "b.json", [pages_of(two, total=2)[1]])
    second = jobs.run_ingest(spark, str(folder), house, "2024-01-01", now=NOW + timedelta(hours=1))
    assert second["days_missing"] == [] and jobs.documents.read_checkpoint(spark, house.path("checkpoint")) == "2024-01-01T23:59:59+00:00"

    # Another flight of the first day comes when the window has moved on.
    land_text(folder, "c.json", pages_of([document(FIRST, 9, 5)]) + pages_of([document(FIRST + timedelta(days=1), 1, 0)]))
    third = jobs.run_ingest(spark, str(folder), house, now=NOW + timedelta(hours=2))
    assert third["window_start"].date() == date(2024, 1, 2) and third["days_missing"] == []
    assert jobs.read_raw(spark, house).flights.filter("flight_schedule_date = '2024-01-01'").count() == 3
    reports = spark.read.parquet(house.path("ingestions")).orderBy("started_at").select("status").collect()
    assert [r.status for r in reports][:2] == ["PARTIAL", "PARTIAL"] and len(reports) == 3


def test_a_failed_run_is_reported(spark, tmp_path):
    house = jobs.Warehouse(scratch_path(spark, "failed"))
    with pytest.raises(Exception):
        jobs.run_ingest(spark, str(tmp_path / "nowhere"), house, "2024-01-01", now=NOW)
    assert spark.read.parquet(house.path("ingestions")).first().status == "FAILED"


def test_a_flight_that_changes_its_date_leaves_no_trace(spark, tmp_path):
    house, folder = jobs.Warehouse(scratch_path(spark, "moving"), by="month"), tmp_path / "landed"
    land_text(folder, "a.json", pages_of(month()))
    jobs.run_ingest(spark, str(folder), house, "2024-01-01", "2024-01-20", now=NOW)
    jobs.run_transform(spark, house)
    moved = document(FIRST + timedelta(days=2), 1, 30) | {"flightScheduleDate": "2024-02-10"}
    land_text(folder, "b.json", pages_of([moved]))
    report = jobs.run_ingest(spark, str(folder), house, now=NOW)
    assert set(report["dates"]) >= {"2024-01-03", "2024-02-10"}
    jobs.run_transform(spark, house, report["dates"])
    full = mart.fct_flight_legs(build_features(jobs.read_raw(spark, house)))
    fact = jobs.read_fact(spark, house).select(*full.columns)
    assert values(fact) == values(full) and fact.filter("date_key = '2024-02-10'").count() == 1
    dates = spark.read.parquet(house.path("dim_date"))
    assert values(dates) == values(mart.dim_date(jobs.read_raw(spark, house).flights).select(*dates.columns))


def test_the_gate_judges_before_anything_is_published(spark, monkeypatch):
    house = jobs.Warehouse(scratch_path(spark, "gated"), by="month")
    pages = scratch_path(spark, "pages")
    land(spark, pages, month())
    jobs.run_ingest(spark, pages, house, "2024-01-01", "2024-01-20", now=NOW)
    original = jobs.mart.fct_flight_legs
    monkeypatch.setattr(jobs.mart, "fct_flight_legs", lambda ready: original(ready).withColumn("leg_id", F.lit("same")))
    with pytest.raises(jobs.quality.QualityGateError):
        jobs.run_transform(spark, house)
    monkeypatch.undo()
    with pytest.raises(jobs.quality.QualityGateError):
        jobs.run_transform(spark, house, as_of=NOW + timedelta(days=20))  # the sources are stale
    assert not path_exists(spark, house.path("fct_flight_legs")) and not path_exists(spark, house.path("dim_date"))
    assert jobs.run_transform(spark, house, as_of=NOW + timedelta(days=9)) == [f"freshness:{t}.fetched_at" for t in ("delays", "flights", "legs")]


def test_source_checks_cover_three_tables(spark, house):
    rows = {r.check_name: r.status for r in jobs.quality.dq_report(jobs.source_checks(spark, house, NOW + timedelta(days=9))).collect()}
    assert rows == {**{f"freshness:{t}.fetched_at": "warn" for t in ("flights", "legs", "delays")}, **{f"row_count:{t}": "pass" for t in ("flights", "legs", "delays")}}


def test_scoring_of_touched_dates_reads_their_periods_only(spark):
    house = jobs.Warehouse(scratch_path(spark, "dated"), by="month")
    pages = scratch_path(spark, "pages")
    days = [FIRST + timedelta(days=31 * m) for m in range(3)]
    land(spark, pages, [document(d, n, 20 * (n % 2)) for d in days for n in range(4)])
    jobs.run_ingest(spark, pages, house, "2024-01-01", now=NOW)
    jobs.run_transform(spark, house)
    model = scoring.fit_delay_model(jobs.read_fact(spark, house), rounds=2, depth=2)
    assert jobs.run_scoring(spark, house, model, NOW, dates=[days[1].isoformat()]) == 4
    assert jobs.run_scoring(spark, house, model, NOW) == 8


def test_stream_ingest_equals_batch_and_replays(spark, house):
    pages, target = scratch_path(spark, "stream-pages"), jobs.Warehouse(scratch_path(spark, "stream-house"), by="month")
    land(spark, pages, month())
    land(spark, pages, month()[:3])
    state = scratch_path(spark, "state")
    for checkpoint in (state, state, scratch_path(spark, "lost-state")):
        stream_ingest(spark, pages, target, checkpoint, NOW).awaitTermination()
    streamed = jobs.read_raw(spark, target)
    ids = lambda df: sorted(r.id for r in df.select("id").collect())
    batch = jobs.read_raw(spark, house)
    assert ids(streamed.legs) == ids(batch.legs) and ids(streamed.flights) == ids(batch.flights)
    assert ids(streamed.delays) == ids(batch.delays)


def test_scoring_is_incremental_and_model_reloads(spark, house):
    model = scoring.fit_delay_model(jobs.read_fact(spark, house), rounds=2, depth=2)
    path = scratch_path(spark, "model")
    model.save(spark, path)
    loaded = scoring.DelayModel.load(spark, path)
    assert loaded.params == model.params
    assert jobs.run_scoring(spark, house, loaded, NOW) == 80
    assert jobs.run_scoring(spark, house, loaded, NOW) == 0
    later = NOW + timedelta(days=1)
    assert jobs.run_scoring(spark, house, loaded, later, rescore=True) == 80
    stored = jobs.read_predictions(spark, house)
    assert stored.count() == 80 and stored.select("timestamp").distinct().count() == 1


def test_feature_names_in_older_spellings(spark):
    old = {"scheduledFlightDuration": 1.0, "departureairportdelayedshare": 2.0, "departureMonthDay": 3.0, "departure_hour": 4.0}
    params = scoring.FeatureParams(old, {})
    assert params.means == {
        "scheduled_flight_duration_minutes": 1.0, "departure_airport_delayed_share": 2.0, "departure_monthday": 3.0, "departure_hour": 4.0,
    }
    for unknown in ({"_duration": 1.0}, {"departurehour": 1.0, "departure_hour": 2.0}):
        with pytest.raises(ValueError):
            scoring.FeatureParams(unknown, {})
