from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from delayhouse.operators import analytics, mart, scoring, shares
from delayhouse.operators.features import legs_ready
from delayhouse.operators.legs import delay_agg, delays_per_leg
from delayhouse.operators.shares import entity_days
from delayhouse.plans.build import RawTables, build_fact, build_features, build_leg_facts
from delayhouse.sources import fixtures, schemas

from .conftest import values

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark):
    return RawTables(fixtures.flights(spark, SF), fixtures.legs(spark, SF), fixtures.delays(spark, SF))


def daily(spark, days):
    rows = [("K", date(2024, 1, d), 1, 1) for d in days]
    return spark.createDataFrame(rows, "k string, flight_schedule_date date, delayed_count long, total_count long")


def test_share_frame_is_eight_calendar_days(spark):
    df = daily(spark, [1, 8, 9]).withColumn("delayed_count", F.when(F.dayofmonth("flight_schedule_date") == 1, 1).otherwise(0).cast("long"))
    got = [round(r.s, 3) for r in shares.rolling_share(df, "k", "s").orderBy("flight_schedule_date").collect()]
    assert got == [100.0, 50.0, 0.0]


def test_share_can_leave_out_the_current_day(spark):
    got = shares.rolling_share(daily(spark, [1, 2]), "k", "s", include_current=False).orderBy("flight_schedule_date")
    assert [r.s for r in got.collect()] == [None, 100.0]


def test_pre_aggregated_counts_equal_event_counts(raw):
    from delayhouse.operators.legs import delay_events

    events = delay_events(raw.legs, raw.flights, raw.delays)
    for entity in shares.ENTITIES:
        plain = shares.daily_delay_counts(events, entity)
        assert values(shares.daily_counts(raw.legs, raw.flights, raw.delays, entity)) == values(plain)


def test_incremental_shares_equal_a_full_build(raw):
    newest = date(2000, 6, 15)
    full = shares.entity_share(raw.legs, raw.flights, raw.delays, "airport")
    got = shares.share_increment(raw.legs, raw.flights, raw.delays, "airport", newest)
    expected = values(full.filter(F.col("flight_schedule_date") >= F.lit(newest - timedelta(days=7))))
    assert expected and values(got) == expected


def tiny(spark):
    at = datetime(2024, 1, 5, 10)
    blank = dict.fromkeys(schemas.LEGS.fieldNames())
    flights = spark.createDataFrame(
        [("f", 1, "2024-01-05", "X", "Ex", "M", "A", at)], schemas.FLIGHTS
    )
    leg = lambda id, dep, arr, cancelled=False: tuple({**blank, "id": id, "flight_id": "f", "leg_order": 0, "departure_airport_code": dep, "arrival_airport_code": arr, "cancelled": cancelled}.values())
    legs = spark.createDataFrame([leg("a", "P", "Q"), leg("b", None, "Q"), leg("c", "P", "R", True)], schemas.LEGS)
    delays = spark.createDataFrame([("d0", "a", "Z", "PT20M"), ("d1", "a", "B", "PT1M"), ("d2", "a", "A", None)], schemas.DELAYS)
    return RawTables(flights, legs, delays)


def test_features_of_edge_legs(spark):
    rows = {r.leg_id: r for r in build_features(tiny(spark)).collect()}
    assert set(rows) == {"a", "b", "c"}
    a, b, c = rows["a"], rows["b"], rows["c"]
    # The event without a duration counts in the share, but neither in the minutes nor for the code.
    assert (a.delay_duration_minutes, a.delay_code, a.is_delayed) == (21, "B", True)
    assert round(a.departure_airport_delayed_share, 4) == 66.6667
    # Cancelled legs count as traffic.
    assert (a.nb_flight_departing_departure_airport, a.nb_flight_arriving_departure_airport) == (2, 0)
    assert (a.nb_flight_departing_arrival_airport, a.nb_flight_arriving_arrival_airport) == (0, 2)
    assert (b.nb_flight_departing_departure_airport, b.departure_airport_delayed_share) == (0, 0.0)
    assert (b.is_delayed, b.departure_hour) == (False, None)
    assert c.cancelled and c.nb_flight_arriving_arrival_airport == 1


def test_one_pass_equals_separate_reads(raw):
    # Shares are quotients of the same integers either way.
    days = entity_days(raw.legs, raw.flights, raw.delays)
    separate = mart.fct_flight_legs(legs_ready(delays_per_leg(raw.legs, raw.flights, raw.delays), days))
    once = build_fact(raw)
    split = mart.fct_flight_legs(legs_ready(delays_per_leg(raw.legs, raw.flights, raw.delays), days, chunks=3))
    assert sorted(split.collect(), key=repr) == sorted(once.collect(), key=repr)
    assert once.count() == raw.legs.count()
    assert once.exceptAll(separate).isEmpty() and separate.exceptAll(once).isEmpty()


def test_dimensions(spark):
    t = tiny(spark)
    from delayhouse.operators.legs import legs_with_flights

    joined = legs_with_flights(t.legs, t.flights)
    airports = mart.dim_airports(joined)
    assert airports.columns == ["airport_key", "airport_name", "city_code", "city_name", "country_code", "country_name"]
    assert sorted(r.airport_key for r in airports.collect()) == ["P", "Q", "R"]
    assert values(mart.dim_date(joined)) == [("2024-01-05", date(2024, 1, 5), 5, 1, 2024)]


def test_delay_agg_ignores_events_without_duration(spark):
    assert values(delay_agg(tiny(spark).delays)) == [("a", 21, "B")]


def metric_rows(spark, late, legs, label="A"):
    rows = [(f"{label}{i}", label, label, "2024-01-05", label, i < late) for i in range(legs)]
    return spark.createDataFrame(rows, "leg_id string, departure_airport_name string, departure_city_name string, date_key string, airline_name string, is_delayed boolean")


def test_volume_floors(spark):
    as_of = date(2024, 1, 6)
    fact = metric_rows(spark, 1, 49).unionByName(metric_rows(spark, 1, 50, "B"))
    assert values(analytics.delay_metrics(fact, "airport", as_of)) == [("B", 1, 50, 2.0)]
    assert len(values(analytics.delay_metrics(fact, "airline", as_of))) == 2
    empty = analytics.delay_metrics(fact, "airport", date(2024, 2, 1))
    assert values(analytics.delay_kpis(empty)) == [(0.0, 0, 0)]
    assert analytics.worst_label(empty).isEmpty()
    with pytest.raises(ValueError):
        analytics.delay_metrics(fact, "leg_id; drop table", as_of)


def test_repeated_legs_collapse(spark):
    fact = metric_rows(spark, 0, 10).unionByName(metric_rows(spark, 10, 10))
    assert values(analytics.delay_metrics(fact, "airline", date(2024, 1, 6))) == [("A", 10, 10, 100.0)]


def test_ranking_breaks_ties_by_label(spark):
    m = spark.createDataFrame([("b", 1, 2, 50.0), ("a", 1, 2, 50.0), ("c", 0, 2, 0.0)], "label string, total_retards long, total_vols long, delayed_share double")
    assert [r.label for r in analytics.top_delayed(m, 2).collect()] == ["a", "b"]
    assert values(analytics.worst_label(m)) == [("a", 50.0, 33.33)]
    assert analytics.top_delayed(m, None).count() == 3


def test_unscored_day_is_an_error(spark, raw):
    fact = build_leg_facts(raw)
    with pytest.raises(ValueError):
        analytics.day_predictions(fixtures.predictions(spark, SF), fact, "1900-01-01")


def test_increment_without_a_stored_table_keeps_all(raw):
    assert mart.incremental_filter(raw.legs, None, "scheduled_departure").count() == raw.legs.count()


def test_trees_are_fitted_on_all_flown_legs(spark, monkeypatch):
    """None is left out, however many they are: before, some two million."""
    flown, seen = 2_000_500, []
    numbers = {c: F.lit(1.0) for c in scoring.FEATURES} | {scoring.LABEL: F.col("id") % 2 == 0}
    legs = spark.range(flown + 500).select(
        F.concat(F.lit("leg"), "id").alias("leg_id"), F.lit("f").alias("flight_id"), (F.col("id") >= flown).alias("cancelled"),
        *(c.alias(n) for n, c in numbers.items()),
    )
    monkeypatch.setattr(scoring.Pipeline, "fit", lambda self, rows: seen.append(rows.count()))
    scoring.fit_delay_model(legs)
    assert seen == [flown]
