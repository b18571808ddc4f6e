"""Shape of the plans that must hold at any scale."""

import os
import pathlib
import re
import time
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from delayhouse.operators import analytics, shares
from delayhouse.operators.legs import delays_per_leg, legs_with_flights
from delayhouse.functions import instant, newest_instant
from delayhouse.plans import build, catalog, oracles
from delayhouse.sources import documents, storage

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def given(spark):
    return catalog.Given(spark, SF)


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_core_plans_stay_in_the_jvm_without_products(given):
    for df in (
        shares.entity_days(given.legs, given.flights, given.delays),
        delays_per_leg(given.legs, given.flights, given.delays),
        given.runs,
        given.metrics("airport"),
        catalog.QUERIES["sustained_alerts"](given),
        catalog.QUERIES["counter_rate"](given),
    ):
        text = plan(df)
        assert not re.search("Python|CartesianProduct|BroadcastNestedLoopJoin", text), text


def test_window_input_is_one_row_per_entity_and_day(given):
    text = plan(shares.entity_days(given.legs, given.flights, given.delays))
    window, rest = text.index("Window"), text.index("HashAggregate")
    assert window < rest  # the aggregate is below the window
    assert text.count("Window [") == 1


def test_without_broadcast_joins_are_sort_merge_on_their_keys(given, no_broadcast):
    text = plan(delays_per_leg(given.legs, given.flights, given.delays))
    assert text.count("SortMergeJoin") == 2 and "Broadcast" not in text


def test_only_needed_columns_are_read(given):
    congestion = plan(shares.airport_congestion(legs_with_flights(given.legs, given.flights)))
    read = [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^>]*)>", congestion)]
    assert len(read) == 2
    assert read[0].isdisjoint({"l_extendedprice", "l_returnflag", "l_discount", "l_tax", "l_linestatus"})
    assert read[1].isdisjoint({"o_totalprice", "o_custkey", "o_orderpriority"})


def test_bounds_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "fact")
    spark.createDataFrame([("a", "2024-01-05", datetime(2024, 1, 5), True)], "leg_id string, date_key string, scheduled_departure timestamp, is_delayed boolean").write.parquet(path)
    fact = spark.read.parquet(path)
    assert "PushedFilters: [IsNotNull(date_key), GreaterThanOrEqual(date_key,2023-12-30)]" in plan(analytics.recent(fact, date(2024, 1, 6)))
    assert "GreaterThanOrEqual(scheduled_departure" in plan(analytics.time_filter(fact, "scheduled_departure", datetime(2024, 1, 1), datetime(2024, 2, 1)))


def scans(df) -> int:
    return plan(df).count("FileScan")


def test_features_read_each_raw_table_once(spark, given, monkeypatch):
    """The joined legs are written once; entity days and features read them instead of the raw tables."""
    written = []
    original = build.staged
    monkeypatch.setattr(build, "staged", lambda df, name: written.append((name, df)) or original(df, name))
    ready = build.build_features(given.raw)
    names = dict(written)
    assert scans(names["leg-delays"]) == 3
    assert scans(names["entity-days"]) == 1 and "leg-delays" in plan(names["entity-days"])
    assert "lineitem" not in plan(ready) and "orders" not in plan(ready)


def test_lookups_share_one_layout(given, no_broadcast):
    """One exchange of the legs and one of each lookup, all by date and chunk; the joins add none."""
    text = plan(build.build_features(given.raw))
    exchanges = re.findall(r"Exchange (\w+)\(((?:\w+#\d+, )*)", text)
    assert len(exchanges) == 5, text
    for kind, keys in exchanges:
        assert kind == "hashpartitioning" and re.sub(r"#\d+", "", keys) == "flight_schedule_date, chunk, ", keys
    assert text.count("SortMergeJoin") == 4


def test_legs_are_mapped_after_they_are_dealt_out(given, no_broadcast):
    """The join with the flights adds no exchange of the legs."""
    text = plan(legs_with_flights(given.legs, given.flights))
    assert text.count("Exchange") == 2 and "hashpartitioning(cast(l_orderkey" in text


def test_files_that_arrived_earlier_are_not_read(spark, tmp_path):
    folder = tmp_path / "landed"
    folder.mkdir()
    for name, age in (("old", 3600), ("new", 0)):
        (folder / f"{name}.json").write_text('{"page":{"totalPages":1},"operationalFlights":[]}\n')
        when = time.time() - age
        os.utime(folder / f"{name}.json", (when, when))
    since = datetime.now(timezone.utc) - timedelta(minutes=10)
    assert [os.path.basename(f) for f in documents.read_pages(spark, str(folder), since).inputFiles()] == ["new.json"]
    assert len(documents.read_pages(spark, str(folder)).inputFiles()) == 2


def test_touched_periods_prune_the_scans(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(12).selectExpr("id", "concat('2024-', lpad(id + 1, 2, '0')) as period").write.partitionBy("period").parquet(path)
    text = plan(storage.pruned(spark.read.schema("id long, period string").parquet(path), "period", {"2024-03", "2024-04"}))
    assert re.search(r"PartitionFilters: \[[^]]*period#\d+ IN \(2024-03,2024-04\)", text), text


def test_literals_do_not_depend_on_the_drivers_time_zone(spark):
    before = os.environ.get("TZ")
    os.environ["TZ"] = "America/New_York"
    time.tzset()
    try:
        row = spark.range(1).select(F.unix_micros(instant(datetime(2024, 1, 3))).alias("m"), instant(datetime(2024, 1, 3)).alias("t")).first()
        newest = newest_instant(spark.range(1).select(instant(datetime(2024, 1, 3)).alias("t")), "t")
    finally:
        os.environ.pop("TZ") if before is None else os.environ.update(TZ=before)
        time.tzset()
    assert row.m == 1704240000000000 and newest == datetime(2024, 1, 3, tzinfo=timezone.utc)


def test_no_zoneless_literal_is_left():
    root = pathlib.Path(catalog.__file__).parents[1]
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"F\.lit\((datetime\(|(now|as_of|scored_at|fetched_at)\))", path.read_text()), path


def test_registry_and_sql_agree():
    registered, checked = set(catalog.queries()), set(oracles.statements())
    assert checked <= registered
    assert registered - checked == {"fitted_scores"}


def test_range_frame_differs_from_a_row_frame(given):
    from pyspark.sql import Window

    daily = shares.daily_counts(given.legs, given.flights, given.delays, "aircraft")
    frame = Window.partitionBy("aircraft_code").orderBy("flight_schedule_date").rowsBetween(-7, 0)
    by_rows = F.sum("total_count").over(frame)
    by_days = F.sum("total_count").over(shares._trailing("aircraft_code", "flight_schedule_date", 7, True))
    assert daily.select((by_rows != by_days).alias("d")).filter("d").count() > 0
