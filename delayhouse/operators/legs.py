"""Legs with their flights and delay events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import delay_flag, delay_minutes, iso_minutes

# Declared output columns of the per-leg delay table, in order.
DELAYS_LEG_COLUMNS = (
    "leg_id", "flight_id", "flight_number", "flight_schedule_date", "airline_code", "airline_name", "leg_order",
    "departure_airport_code", "arrival_airport_code", "departure_airport_name", "arrival_airport_name",
    "departure_city_code", "departure_city_name", "departure_country_code", "departure_country_name",
    "arrival_city_code", "arrival_city_name", "arrival_country_code", "arrival_country_name",
    "published_status", "scheduled_departure", "actual_departure", "scheduled_arrival", "actual_arrival",
    "scheduled_flight_duration", "cancelled", "aircraft_code", "aircraft_name",
    "departure_delay_minutes", "arrival_delay_minutes", "delay_code", "delay_duration_minutes",
)


def legs_with_flights(legs: DataFrame, flights: DataFrame) -> DataFrame:
    """Legs joined to their flight; a leg without a flight is dropped."""
    flight = flights.select(
        F.col("id").alias("flight_id"), "flight_number", "flight_schedule_date", "airline_code", "airline_name"
    )
    # On stored tables both sides carry the date they are partitioned by; the flight's own is kept.
    leg = legs.drop("flight_schedule_date").withColumnRenamed("id", "leg_id")
    return leg.join(flight, "flight_id", "inner")


def active(df: DataFrame, key: str) -> DataFrame:
    """Rows not cancelled and with a key; a null cancelled flag drops the row."""
    return df.filter(~F.col("cancelled") & F.col(key).isNotNull())


def delay_events(legs: DataFrame, flights: DataFrame, delays: DataFrame) -> DataFrame:
    """One row per delay event with its leg and flight."""
    event = delays.select("flight_leg_id", "delay_code", "delay_duration")
    joined = legs_with_flights(legs, flights)
    return joined.join(event, joined["leg_id"] == event["flight_leg_id"], "inner").drop("flight_leg_id")


def delay_agg(delays: DataFrame) -> DataFrame:
    """Per leg: declared minutes and smallest code, over events that declare a duration."""
    return (
        delays.filter(F.col("delay_duration").isNotNull())
        .groupBy("flight_leg_id")
        .agg(
            F.sum(iso_minutes(F.col("delay_duration"))).cast("int").alias("delay_duration_minutes"),
            F.min("delay_code").alias("delay_code"),
        )
    )


def event_counts(delays: DataFrame) -> DataFrame:
    """Per leg: number of delay events and of those that declare a delay."""
    return delays.groupBy("flight_leg_id").agg(
        F.count(F.lit(1)).alias("events"), F.sum(delay_flag(F.col("delay_duration"))).alias("delayed")
    )


def leg_delay_columns() -> list[Column]:
    return [
        delay_minutes(F.col("actual_departure"), F.col("scheduled_departure")).alias("departure_delay_minutes"),
        delay_minutes(F.col("actual_arrival"), F.col("scheduled_arrival")).alias("arrival_delay_minutes"),
    ]


def delay_stats(delays: DataFrame) -> DataFrame:
    """Per leg, in one aggregation: what :func:`delay_agg` and :func:`event_counts` say."""
    declared = F.col("delay_duration").isNotNull()
    return delays.groupBy("flight_leg_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(delay_flag(F.col("delay_duration"))).alias("delayed"),
        F.sum(F.when(declared, iso_minutes(F.col("delay_duration")))).cast("int").alias("delay_duration_minutes"),
        F.min(F.when(declared, F.col("delay_code"))).alias("delay_code"),
    )


def legs_with_delays(legs: DataFrame, flights: DataFrame, delays: DataFrame) -> DataFrame:
    """One row per leg with its flight, time differences, declared delay, and numbers of ``events`` and ``delayed`` ones.

    All that the features need of the three tables, each read once; shares and features both follow from it.
    """
    stats = delay_stats(delays)
    base = legs_with_flights(legs, flights).select("*", *leg_delay_columns())
    joined = base.join(stats, base["leg_id"] == stats["flight_leg_id"], "left")
    return joined.select(*DELAYS_LEG_COLUMNS, "events", "delayed")


def delays_at_flights(keys: DataFrame, stats: DataFrame) -> DataFrame:
    """The ``stats`` (:func:`delay_agg`, :func:`delay_stats`) of each leg, once for every flight that has a leg of this id.

    ``keys`` holds ``id`` and ``flight_id`` of the legs. Both sides meet by leg; ids that repeat within a flight count once.
    """
    key = keys.select(F.col("id").alias("declared_leg_id"), F.col("flight_id").alias("declared_flight_id")).dropna()
    key = key.repartition("declared_leg_id").distinct()
    return key.join(stats, key["declared_leg_id"] == stats["flight_leg_id"], "inner").drop("flight_leg_id")


def _joined_at_flights(legs: DataFrame, flights: DataFrame, declared: DataFrame) -> DataFrame:
    """Legs with their flights and what :func:`delays_at_flights` says of them."""
    # Flights are narrow and one row each, so the legs need not be sorted to meet them.
    base = legs_with_flights(legs, flights.hint("shuffle_hash"))
    same = (base["flight_id"] == declared["declared_flight_id"]) & (base["leg_id"] == declared["declared_leg_id"])
    return base.join(declared, same, "left").select("*", *leg_delay_columns())


def legs_with_delays_at_flights(legs: DataFrame, flights: DataFrame, delays: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """As :func:`legs_with_delays`, for callers that use most columns: see :func:`delays_per_leg`."""
    declared = delays_at_flights(legs if keys is None else keys, delay_stats(delays))
    return legs_with_stats(legs, flights, declared)


def legs_with_stats(legs: DataFrame, flights: DataFrame, declared: DataFrame) -> DataFrame:
    """As :func:`legs_with_delays_at_flights`, from the :func:`delay_stats` that were sent to the flights."""
    return _joined_at_flights(legs, flights, declared).select(*DELAYS_LEG_COLUMNS, "events", "delayed")


def delays_per_leg(legs: DataFrame, flights: DataFrame, delays: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """One row per leg with its flight, time differences and declared delay.

    The wide legs are dealt out and sorted once, by flight: their declared delays are sent there rather than the legs to their
    delays. That pays when most columns are used; :func:`legs_with_delays` is for few. ``keys`` is a reading of the legs' ``id``
    and ``flight_id`` alone, where there is a cheaper one than from ``legs``.
    """
    declared = delays_at_flights(legs if keys is None else keys, delay_agg(delays))
    return _joined_at_flights(legs, flights, declared).select(*DELAYS_LEG_COLUMNS)
