"""Figures that must not outgrow the input."""

import json
import pathlib
import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from delayhouse.operators import features, ranges
from delayhouse.operators.legs import DELAYS_LEG_COLUMNS, delays_per_leg, legs_with_delays, legs_with_delays_at_flights
from delayhouse.operators.shares import entity_days_of
from delayhouse.plans import build, catalog, jobs
from delayhouse.session import Stages, staged
from delayhouse.sources import documents, fixtures, keys, schemas, storage
from delayhouse.streaming import logs

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def folder_bytes(path) -> int:
    return sum(f.stat().st_size for f in pathlib.Path(path).rglob("*") if f.is_file())


def test_landed_pages_take_a_fraction_of_their_text(spark, tmp_path, monkeypatch):
    """Nothing is lost by compression, and files, which are not split, are bounded by lines."""
    monkeypatch.setattr(fixtures, "LANDED_LINES", 1000)
    pages = fixtures.page_lines(spark, SF)
    fixtures.land(pages, str(tmp_path / "landed"))
    landed = spark.read.text(str(tmp_path / "landed"))
    assert sorted(r[0] for r in landed.collect()) == sorted(r[0] for r in pages.collect())
    text = pages.agg(F.sum(F.octet_length("value"))).first()[0]
    assert folder_bytes(tmp_path / "landed") < text / 5
    assert len(landed.inputFiles()) >= pages.count() / 1000


def test_documents_are_landed_compressed(spark):
    files = fixtures.documents(spark, SF).inputFiles()
    assert files and all(re.search(r"\.gz$", f) for f in files)


@pytest.mark.parametrize("few", [True, False])
def test_few_entity_days_leave_the_legs_where_they_are(spark, monkeypatch, few):
    """Lookups that every task can hold cost no exchange and no sort of the legs; the rows are the same either way."""
    given = catalog.Given(spark, SF)
    laid_out = features.legs_ready
    monkeypatch.setattr(features, "SENT_DAYS", 10**6 if few else 0)
    ready = build.build_features(given.raw)
    text = plan(ready)
    assert text.count("Exchange hashpartitioning") == (0 if few else 5)
    if few:
        assert "SortMergeJoin" not in text and "Sort [" not in text
    base = legs_with_delays(given.legs, given.flights, given.delays)
    other = laid_out(base.select(*DELAYS_LEG_COLUMNS), entity_days_of(base), 2)
    assert ready.exceptAll(other).count() == 0 and ready.count() == other.count()


def test_bitmaps_of_days_do_not_grow_with_the_ids(spark):
    """Numbers of one day lie together, so a day needs a bitmap or two of a few buckets, not of every block of every bucket."""
    legs = spark.range(240_000).selectExpr("concat('leg', id) leg_id", "concat('2024-01-', lpad(xxhash64(id) % 10 + 15, 2, '0')) day")
    numbers = staged(ranges.numbered(legs, buckets=2), "numbers")
    bitmaps = staged(ranges.day_bitmaps(legs, numbers), "bitmaps")
    days = legs.select("day").distinct().count()
    assert bitmaps.count() <= 2 * 2 * days + 8  # about as many blocks of ids as days here; their product is 152
    assert ranges.distinct_legs(bitmaps, "2024-01-01", "2024-01-31").first()[0] == 240_000
    assert plan(ranges.day_bitmaps(legs, numbers)).count("hashpartitioning(day") == 1


def test_index_of_keys_draws_each_bitmap_once(spark):
    """The bits are those of the built-in functions, without a row for each bit."""
    rows = spark.range(3000).selectExpr("concat('k', id) key", "concat('2024-0', id % 3 + 1) period").repartition(5)
    index = keys.index_of(rows.unionByName(rows.limit(500)).unionByName(rows.limit(1).withColumn("key", F.lit(None).cast("string"))))
    sizes = rows.unionByName(rows.limit(500)).groupBy("period").agg(keys._blocks(F.count(F.lit(1))).alias("blocks"))
    bits = rows.join(sizes, "period").select("period", "blocks", keys._bucket(F.col("blocks")).alias("bucket"), F.explode(keys._positions()).alias("bit"))
    wanted = bits.groupBy("period", "blocks", "bucket").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("bits"))
    as_rows = lambda df: sorted((r["period"], r["blocks"], r["bucket"], bytes(r["bits"])) for r in df.collect())
    assert as_rows(index) == as_rows(wanted)
    assert "Generate" not in plan(index)


def test_counts_of_a_batch_are_not_drawn_into_one_task(spark, tmp_path, monkeypatch):
    """The events of a batch are counted by all partitions; only their few counts meet in one."""
    made = []
    original = logs.event_rates
    monkeypatch.setattr(logs, "event_rates", lambda *a: made.append(original(*a)) or made[-1])
    coalesced = []
    frame = type(spark.range(1))
    plain = frame.coalesce
    monkeypatch.setattr(frame, "coalesce", lambda self, n: coalesced.append(n) or plain(self, n))
    rows = spark.range(500).selectExpr("id", "timestamp_seconds(1700000000 + id * 60) event_at", "if(id % 5 = 0, 'ERROR', 'INFO') level")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    logs.stream_corrected_rates(stream, "2 hours", None, "1 hour", str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert made and not coalesced
    found = logs.corrected_rates(spark, str(tmp_path / "out")).select("window_start", "events", "errors")
    wanted = original(rows, "2 hours").select("window_start", "events", "errors")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
    assert len(list((tmp_path / "out" / "parts").rglob("*.parquet"))) == 1


def test_wide_legs_are_not_sorted_to_meet_their_flights(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(catalog.QUERIES["dim_airports"](catalog.Given(spark, SF)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "ShuffledHashJoin" in text and "Sort [" not in text


@pytest.mark.parametrize("many", [True, False])
def test_a_first_load_is_copied_once_and_dealt_out_only_for_many_partitions(spark, tmp_path, monkeypatch, many):
    monkeypatch.setattr(storage, "FEW_PARTITIONS", 2 if many else 16)
    added, hinted = [], []
    original = storage.Stages.add
    monkeypatch.setattr(storage.Stages, "add", lambda self, df, name, **o: added.append(name) or original(self, df, name, **o))
    frame = type(spark.range(1))
    plain = frame.hint
    monkeypatch.setattr(frame, "hint", lambda self, name, *p: hinted.append(name) or plain(self, name, *p))
    rows = spark.range(60).selectExpr("id", "cast(id % 4 as string) part", "id * 2 v")
    path = str(tmp_path / "t")
    assert storage.upsert_table(spark, path, rows, keys=["id"], partition_by="part", unique=True) == {"0", "1", "2", "3"}
    assert added == [] and hinted == (["rebalance"] if many else [])
    found = lambda: spark.read.schema(rows.schema).parquet(path).select(*rows.columns)
    assert sorted(map(tuple, found().collect())) == sorted(map(tuple, rows.collect()))
    assert storage.upsert_table(spark, path, rows.filter("id < 3"), keys=["id"], partition_by="part") == {"0", "1", "2"}
    assert found().count() == 60
    empty = str(tmp_path / "empty")
    assert storage.upsert_table(spark, empty, rows.limit(0), keys=["id"], partition_by="part") == set()
    assert spark.read.schema(rows.schema).parquet(empty).count() == 0


def test_wide_legs_are_not_shuffled_to_meet_their_delays(spark):
    """No exchange carries the mapped columns of the legs, nor are these sorted twice."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        query = catalog.QUERIES["delays_per_leg"](catalog.Given(spark, SF))
        text = spark._jvm.PythonSQLUtils.explainString(query._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved, ordered = (re.findall(rf"\(\d+\) {node}\s+Input \[\d+\]: \[([^\]]*)\]", text) for node in ("Exchange", "Sort"))
    assert moved and not any("aircraft_name" in columns for columns in moved), moved
    assert sum("aircraft_name" in columns for columns in ordered) == 1, ordered


def test_delays_sent_to_the_legs_find_repeated_and_missing_keys(spark):
    """Same rows as when the legs go to their delays: ids that repeat within and across flights, nulls, undeclared events."""
    blank = dict.fromkeys(schemas.LEGS.names)
    pairs = [("a", "f"), ("a", "f"), ("a", "g"), ("b", "f"), ("c", "g"), (None, "f"), ("d", None), ("e", "gone"), (None, None), ("h", "twice")]
    rows = [tuple((blank | {"id": i, "flight_id": f, "leg_order": n, "cancelled": False}).values()) for n, (i, f) in enumerate(pairs)]
    legs = spark.createDataFrame(rows, schemas.LEGS)
    names = ("f", "g", None, "twice", "twice")
    blank = dict.fromkeys(schemas.FLIGHTS.names)
    flights = spark.createDataFrame([tuple((blank | {"id": f, "flight_number": n}).values()) for n, f in enumerate(names)], schemas.FLIGHTS)
    events = [("a", "Z", "PT20M"), ("a", "B", "PT1M"), ("a", "A", None), ("b", "C", None), ("c", None, "00"), (None, "N", "PT5M"), ("d", "D", "PT6M"), ("h", "H", "PT7M"), ("x", "X", "PT8M")]
    delays = spark.createDataFrame([(str(n), *e) for n, e in enumerate(events)], schemas.DELAYS)
    wanted = sorted(legs_with_delays(legs, flights, delays).select(*DELAYS_LEG_COLUMNS).collect(), key=repr)
    for keys_of in (None, legs.select("id", "flight_id")):
        found = delays_per_leg(legs, flights, delays, keys_of)
        assert found.columns == list(DELAYS_LEG_COLUMNS)
        assert sorted(found.collect(), key=repr) == wanted
    assert len(wanted) == 8
    assert [(r.delay_code, r.delay_duration_minutes) for r in wanted if r.leg_id == "a"] == [("B", 21)] * 3


def columns_moved(spark, df) -> list[str]:
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.findall(r"\(\d+\) Exchange\s+Input \[\d+\]: \[([^\]]*)\]", text)


def test_features_do_not_shuffle_the_wide_legs_to_meet_their_delays(spark, monkeypatch):
    moved = {}
    write = build.staged
    monkeypatch.setattr(build, "staged", lambda df, name: moved.update({name: columns_moved(spark, df)}) or write(df, name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        build.build_features(catalog.Given(spark, SF).raw)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert moved["leg-delays"] and not any("aircraft_name" in columns for columns in moved["leg-delays"]), moved


def test_stats_sent_to_the_legs_find_repeated_and_missing_keys(spark):
    blank = dict.fromkeys(schemas.LEGS.names)
    pairs = [("a", "f"), ("a", "f"), ("a", "g"), ("b", "f"), (None, "f"), ("d", None), ("e", "gone"), ("h", "twice")]
    rows = [tuple((blank | {"id": i, "flight_id": f, "leg_order": n}).values()) for n, (i, f) in enumerate(pairs)]
    blank = dict.fromkeys(schemas.FLIGHTS.names)
    flights = [tuple((blank | {"id": f, "flight_number": n}).values()) for n, f in enumerate(("f", "g", None, "twice", "twice"))]
    events = [("1", "a", "Z", None, "PT20M"), ("2", "a", "A", None, None), ("3", "b", "C", None, "00"), ("4", None, "N", None, "PT5M"), ("5", "x", "X", None, "PT8M")]
    columns = ["id", "flight_leg_id", "delay_code", "delay_reason", "delay_duration"]
    delays = spark.createDataFrame(events, ", ".join(f"{c} string" for c in columns))
    raw = spark.createDataFrame(rows, schemas.LEGS), spark.createDataFrame(flights, schemas.FLIGHTS), delays
    wanted = sorted(legs_with_delays(*raw).collect(), key=repr)
    assert len(wanted) == 7 and sorted((r.events, r.delayed) for r in wanted if r.leg_id == "a") == [(2, 1)] * 3
    for keys_of in (None, raw[0].select("id", "flight_id")):
        assert sorted(legs_with_delays_at_flights(*raw, keys_of).collect(), key=repr) == wanted


def test_only_what_a_model_reads_is_written_for_it(spark, monkeypatch):
    written, added = {}, []
    write, add = catalog.staged, Stages.add
    monkeypatch.setattr(catalog, "staged", lambda df, name: written.update({name: df.columns}) or write(df, name))
    monkeypatch.setattr(Stages, "add", lambda self, df, name, **o: added.append(name) or add(self, df, name, **o))
    assert catalog.QUERIES["fitted_scores"](catalog.Given(spark, SF)).count()
    assert written == {"fact": ["leg_id", "flight_id", "cancelled", *catalog.scoring.FEATURES, "is_delayed"]} and added == []


def test_wide_facts_of_few_periods_are_not_dealt_out(spark, monkeypatch):
    class Written(Exception):
        pass

    def stop(*_):
        raise Written

    hinted = []
    frame = type(spark.range(1))
    plain = frame.hint
    monkeypatch.setattr(frame, "hint", lambda self, name, *p: hinted.append(name) or plain(self, name, *p))
    monkeypatch.setattr(catalog.jobs, "read_fact", stop)
    with pytest.raises(Written):
        catalog.QUERIES["score_increment"](catalog.Given(spark, SF))
    assert "rebalance" not in hinted


def test_pages_are_parsed_once_for_their_counts(spark):
    text = plan(catalog.QUERIES["ingestion_metrics"](catalog.Given(spark, SF)))
    assert "FileScan parquet" in text and "FileScan json" not in text


def landed_pages(spark, path, pages):
    spark.createDataFrame([(p if isinstance(p, str) else json.dumps(p),) for p in pages], "value string").write.mode("append").text(path)


def flight_of(name, status, day="2024-01-05", legs=1):
    return {"id": name, "flightScheduleDate": day, "flightStatusPublic": status, "flightLegs": [{"publishedStatus": status}] * legs}


def test_landed_rows_say_what_pages_say(spark, tmp_path):
    """Several flights on a page, none, a null among them, a repeated flight, missing dates and identifiers, a cut page."""
    path = str(tmp_path / "pages")
    flights = [flight_of("a", "1"), flight_of("b", "1"), None, flight_of("a", "2", legs=2), flight_of(None, "1"), flight_of("c", "1", day=None)]
    landed_pages(spark, path, [{"page": {"totalPages": 2, "pageNumber": 1}, "operationalFlights": flights}, {"operationalFlights": []}, {}, '{"page": {"to'])
    landed_pages(spark, path, [{"page": {"totalPages": 1}, "operationalFlights": [flight_of("b", "0"), flight_of("d", "1", day="2023-01-01")]}])
    pages = staged(documents.read_pages(spark, path), "pages")
    landed = staged(documents.landed_rows(pages), "landed")
    as_rows = lambda df: sorted(map(repr, df.collect()))
    assert as_rows(documents.flights_of(landed)) == as_rows(documents.landed_flights(pages))
    assert as_rows(documents.page_rows(documents.pages_of(landed))) == as_rows(documents.page_rows(pages))
    old, new = documents.landed_flights(pages), documents.flights_of(landed)
    assert as_rows(documents.rejects(documents.pages_of(landed), new)) == as_rows(documents.rejects(pages, old))
    window = datetime(2024, 1, 1), datetime(2024, 12, 31)
    assert as_rows(documents.explode_pages(landed, *window)) == as_rows(documents.explode_pages(pages, *window))
    with Stages(spark) as stages:
        usable = new.filter(documents.usable(new))
        found = as_rows(jobs._current(stages, usable))
    assert found == as_rows(jobs.latest_documents(usable)) and len(found) == 3


def test_documents_are_written_once(spark, tmp_path, monkeypatch):
    """Parsed pages are the only wide copy while no flight comes twice; a merge needs no copy of its own."""
    added = []
    add = Stages.add
    monkeypatch.setattr(Stages, "add", lambda self, df, name, **o: added.append(name) or add(self, df, name, **o))
    house, path = jobs.Warehouse(str(tmp_path / "house"), by="year"), str(tmp_path / "pages")
    landed_pages(spark, path, [{"operationalFlights": [flight_of(n, "1", legs=2)]} for n in "abc"])
    now = datetime(2024, 2, 1, tzinfo=timezone.utc)
    for status in ("1", "2"):
        report = jobs.run_ingest(spark, path, house, "2024-01-05", "2024-01-05", incremental=False, now=now)
        assert (report["flights"], report["legs"], report["delays"]) == ((3, 6, 6) if status == "1" else (3, 5, 5))
        assert added.count("documents") == (status == "2") and "pages" not in added
        assert sum(n == "fresh" for n in added) == (status == "2")  # the table of pages
        landed_pages(spark, path, [{"operationalFlights": [flight_of("b", "2")]}])
    stored = jobs.read_raw(spark, house)
    assert sorted((r.id, r.flight_status_public) for r in stored.flights.collect()) == [("a", "1"), ("b", "2"), ("c", "1")]
    assert stored.legs.count() == 5 and stored.delays.count() == 5


def test_partitions_without_replaced_rows_are_not_compared(spark, tmp_path, monkeypatch):
    published = []
    publish = storage.publish
    monkeypatch.setattr(storage, "publish", lambda s, path, rows, *a: published.append(plan(rows)) or publish(s, path, rows, *a))
    rows, path = spark.range(60).selectExpr("id", "cast(id % 3 as string) part", "id * 2 v"), str(tmp_path / "t")
    storage.upsert_table(spark, path, rows, keys=["id"], partition_by="part", unique=True)
    new = spark.range(60, 70).selectExpr("id", "cast(id % 2 as string) part", "id v")
    assert storage.upsert_table(spark, path, new, keys=["id"], partition_by="part", unique=True, within={"0", "1"}, holding=set()) == {"0", "1"}
    assert "Join" not in published[-1] and "Exchange" not in published[-1]
    moved = spark.range(1, 3).selectExpr("id", "'0' part", "-1L v")  # 1 and 2 lie in the partitions of their names
    assert storage.upsert_table(spark, path, moved, keys=["id"], partition_by="part", unique=True, within={"0", "1", "2"}, holding={"1", "2"}) == {"0", "1", "2"}
    found = {r.id: (r.part, r.v) for r in spark.read.schema(rows.schema).parquet(path).collect()}
    assert len(found) == 70 and found[1] == found[2] == ("0", -1) and found[65] == ("1", 65) and found[4] == ("1", 8)


def test_keys_are_dealt_to_the_index_without_their_positions(spark):
    rows = spark.range(300).selectExpr("concat('k', id) key", "concat('2024-0', id % 3 + 1) period")
    moved = columns_moved(spark, keys.candidates(staged(keys.index_of(rows), "index"), rows.select("key")))
    assert moved and not any("positions" in columns for columns in moved), moved
