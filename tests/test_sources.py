import json
import uuid
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from delayhouse.session import Stages, remove, scratch_path
from delayhouse.sources import documents, normalize, storage, tables
from delayhouse.sources.storage import latest, upsert, upsert_table

from .conftest import values

NOW = datetime(2024, 1, 10, 8, tzinfo=timezone.utc)


def flight(legs, id="20240105+XX+0042", day="2024-01-05", **extra):
    return {"id": id, "flightNumber": 42, "flightScheduleDate": day, "airline": None, "flightLegs": legs, **extra}


def landed(spark, lines):
    path = scratch_path(spark, "pages")
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(path)
    return path


def page(*flights):
    return json.dumps({"page": {"totalPages": 1}, "operationalFlights": list(flights)})


def docs(spark, *flights):
    window = documents.resolve_window(None, "2024-01-01", NOW, "2024-12-31")
    return documents.read_flight_documents(spark, landed(spark, [page(*flights)]), *window)


def test_window_resolution():
    def days(*args):
        start, end = documents.resolve_window(*args)
        return start.isoformat()[:19], end.isoformat()[:19]

    assert days(None, None, NOW) == ("2024-01-09T00:00:00", "2024-01-09T23:59:59")
    assert days(None, "2024-01-03T15:00:00Z", NOW) == ("2024-01-03T00:00:00", "2024-01-03T23:59:59")
    # A finished window is not fetched again.
    assert days("2024-01-05T23:59:59+00:00", "2024-01-01", NOW)[0] == "2024-01-06T00:00:00"
    assert days(None, "2024-01-03", NOW, "2024-01-07")[1] == "2024-01-07T23:59:59"


def test_unreadable_pages_are_skipped_and_counted(spark):
    path = landed(spark, [page(flight([{}])), '{"page": {"totalPa', page(flight([], id="b"), flight(None, id="c", day="2023-12-31"))])
    window = documents.resolve_window(None, "2024-01-01", NOW, "2024-12-31")
    pages = documents.read_pages(spark, path)
    found = documents.explode_pages(pages, *window)
    assert sorted(r.id for r in found.collect()) == ["20240105+XX+0042", "b"]
    counts = documents.ingestion_metrics(
        found, normalize.normalize_legs(found), normalize.normalize_delays(found), pages
    )
    assert counts.first().asDict() == {"flights": 2, "legs": 1, "delays": 1, "pages_skipped": 1, "status": "PARTIAL"}


def test_legs_tolerate_missing_levels(spark):
    legs = [
        {"departureInformation": {"airport": {"code": "AAA", "city": None}, "times": {"scheduled": "2024-01-05T10:00:00Z", "actual": "junk"}}},
        {"irregularity": {"cancelled": "Y"}},
    ]
    first, second = normalize.normalize_legs(docs(spark, flight(legs))).orderBy("leg_order").collect()
    assert first.id == str(uuid.uuid5(uuid.NAMESPACE_DNS, "20240105+XX+0042_0"))
    assert (first.departure_airport_code, first.departure_city_code, first.cancelled) == ("AAA", None, False)
    assert (first.scheduled_departure, first.actual_departure) == (datetime(2024, 1, 5, 10), None)
    assert (second.leg_order, second.cancelled, second.arrival_airport_code) == (1, True, None)


def test_delay_entries(spark):
    entry = {"delayCode": "81", "delayReasonPublicLangTransl": "ATC", "delayDuration": "PT17M"}
    legs = [
        {"irregularity": {"delayInformation": [entry, {"delayCode": "9"}], "delayCode": ["Z"], "delayDuration": ["PT1M"]}},
        {"irregularity": {"delayInformation": [], "delayCode": ["A", "B"], "delayDuration": ["PT5M"]}},
        {},
        {"irregularity": {"delayCode": ["A"], "delayDuration": []}},
    ]
    rows = normalize.normalize_delays(docs(spark, flight(legs)))
    leg = {str(uuid.uuid5(uuid.NAMESPACE_DNS, f"20240105+XX+0042_{i}")): i for i in range(4)}
    got = sorted((leg[r.flight_leg_id], r.delay_code or "", r.delay_reason, r.delay_duration) for r in rows.collect())
    assert got == [(0, "81", "ATC", "PT17M"), (0, "9", None, None), (1, "A", None, "PT5M"), (2, "", None, "00"), (3, "", None, "00")]
    sentinel = rows.filter("delay_duration = '00'").orderBy("id").first()
    assert sentinel.id in {str(uuid.uuid5(uuid.NAMESPACE_DNS, f"20240105+XX+0042_{i}_0")) for i in (2, 3)}


def test_checkpoint_round_trip(spark):
    path = scratch_path(spark, "state")
    assert documents.read_checkpoint(spark, path) is None
    documents.write_checkpoint(spark, path, datetime(2024, 1, 5, 23, 59, 59, tzinfo=timezone.utc))
    documents.write_checkpoint(spark, path, datetime(2024, 1, 6, 23, 59, 59, tzinfo=timezone.utc))
    assert documents.read_checkpoint(spark, path) == "2024-01-06T23:59:59+00:00"


SCHEMA = "id string, part string, v int, seq int"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def stored(spark, path):
    return values(spark.read.schema(SCHEMA).parquet(path).select("id", "part", "v", "seq"))


def test_latest_takes_the_last_write(spark):
    df = frame(spark, ("a", "p", 1, 2), ("a", "p", 9, 1), ("b", "p", 3, None))
    assert values(latest(df, ["id"], ["seq"])) == [("a", "p", 1, 2), ("b", "p", 3, None)]


def test_upsert_frames(spark):
    out = upsert(frame(spark, ("a", "p", 1, 1), ("b", "p", 1, 1)), frame(spark, ("b", "p", 2, 2), ("c", "q", 3, 1)), ["id"])
    assert values(out) == [("a", "p", 1, 1), ("b", "p", 2, 2), ("c", "q", 3, 1)]


def test_upsert_table_replay_move_and_emptied_partition(spark):
    path = scratch_path(spark, "table")
    options = {"keys": ["id"], "partition_by": "part", "order_by": ["seq"]}
    upsert_table(spark, path, frame(spark, ("a", "p", 1, 1), ("b", "q", 1, 1), ("c", "r", 1, 1)), **options)
    batch = frame(spark, ("a", "p", 2, 2), ("b", "s", 5, 2), ("b", "s", 4, 1))
    for _ in range(2):
        upsert_table(spark, path, batch, **options)
        assert stored(spark, path) == [("a", "p", 2, 2), ("b", "s", 5, 2), ("c", "r", 1, 1)]
    assert not tables.path_exists(spark, f"{path}/part=q")


@pytest.mark.parametrize("stop", ["before the overwrite", "within the overwrite", "before the emptied go"])
def test_a_merge_that_breaks_off_loses_nothing(spark, monkeypatch, stop):
    path = scratch_path(spark, "broken")
    options = {"keys": ["id"], "partition_by": "part", "order_by": ["seq"]}
    upsert_table(spark, path, frame(spark, ("a", "p", 1, 1), ("b", "q", 1, 1), ("c", "q", 1, 1), ("d", "r", 1, 1)), **options)
    batch = frame(spark, ("a", "p", 2, 2), ("b", "q", 2, 2), ("d", "p", 2, 2))
    want = [("a", "p", 2, 2), ("b", "q", 2, 2), ("c", "q", 1, 1), ("d", "p", 2, 2)]

    class Stopped(Exception):
        pass

    def broken(*_):
        raise Stopped

    with monkeypatch.context() as patched:
        if stop == "before the emptied go":
            patched.setattr(storage, "remove", broken)
        else:
            patched.setattr(storage, "_publish_copy", broken)
        with pytest.raises(Stopped):
            upsert_table(spark, path, batch, **options)
    if stop == "within the overwrite":  # Spark removes the old folders one by one, then moves the new ones in
        remove(spark, f"{path}/part=q")
    storage.settle(spark, path, "part")
    assert stored(spark, path) == want and not tables.path_exists(spark, f"{path}/part=r")
    upsert_table(spark, path, batch, **options)
    assert stored(spark, path) == want and not tables.path_exists(spark, f"{path}/_staged")


def test_an_unfinished_copy_is_dropped(spark):
    path = scratch_path(spark, "unfinished")
    options = {"keys": ["id"], "partition_by": "part"}
    upsert_table(spark, path, frame(spark, ("a", "p", 1, 1)), **options)
    frame(spark, ("a", "p", 9, 9)).write.parquet(f"{path}/_staged/rows")
    remove(spark, f"{path}/_staged/rows/_SUCCESS")
    storage.settle(spark, path, "part")
    assert stored(spark, path) == [("a", "p", 1, 1)] and not tables.path_exists(spark, f"{path}/_staged")


def test_stages_are_removed(spark):
    with pytest.raises(RuntimeError), Stages(spark) as stages:
        kept = stages.add(spark.range(3), "gone")
        assert kept.count() == 3
        path = kept.inputFiles()[0].rsplit("/", 1)[0]
        raise RuntimeError
    assert not tables.path_exists(spark, path)


def test_upsert_table_replaces_all_children_of_a_parent(spark):
    path = scratch_path(spark, "children")
    options = {"keys": ["id"], "partition_by": "part"}
    upsert_table(spark, path, frame(spark, ("f1_0", "p", 1, 1), ("f1_1", "p", 1, 1), ("f2_0", "p", 1, 2), ("f3_0", "q", 1, 3)), **options)
    scope = spark.createDataFrame([(1,), (3,)], "seq int")
    upsert_table(spark, path, frame(spark, ("f1_0", "p", 7, 1)), replace_scope=scope, **options)
    assert stored(spark, path) == [("f1_0", "p", 7, 1), ("f2_0", "p", 1, 2)]


def test_extra_json_encodes_times_and_decimals(spark):
    df = spark.sql(
        "select timestamp'2024-01-05 10:00:00' as t, date'2024-01-05' as d, cast(1.50 as decimal(5,2)) as n,"
        " interval '0 00:01:30.5' day to second as s, 'x' as level, cast(null as string) as gone"
    )
    text = df.select(tables.event_extra(df, df.columns)).first()[0]
    assert json.loads(text) == {"t": "2024-01-05T10:00:00+00:00", "d": "2024-01-05", "n": 1.5, "s": 90.5}
    empty = df.select(tables.event_extra(df, ["level", "gone"])).first()[0]
    assert empty is None


def test_append_events_keeps_every_row(spark):
    path = scratch_path(spark, "log")
    df = spark.range(5).select("id", F.lit(datetime(2024, 1, 5)).alias("event_at"))
    first = tables.append_events(df, path)
    tables.append_events(df, path)
    tables.append_events(df, path, first)  # a repeated batch replaces itself
    assert spark.read.parquet(path).filter(F.col("event_day") == date(2024, 1, 5)).count() == 10


def test_rows_processed_counts_numbers_only(spark):
    bodies = [
        '{"results":[{"adapter_response":{"rows_affected":5}},{"adapter_response":{"rows_affected":"7"}},{},{"adapter_response":{"rows_affected":2.9}}]}',
        '{"results":[]}',
        "{}",
        "not json",
    ]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    assert [r.rows_processed for r in tables.rows_processed(df).collect()] == [7, 0, 0, 0]
