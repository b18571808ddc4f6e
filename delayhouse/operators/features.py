"""The per-leg feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_delayed, iso_minutes, time_parts

# Declared output columns of the feature table, in order.
LEGS_READY_COLUMNS = (
    "leg_id", "flight_id", "flight_number", "flight_schedule_date", "airline_code", "airline_name",
    "departure_airport_code", "arrival_airport_code", "departure_airport_name", "arrival_airport_name",
    "scheduled_departure", "actual_departure", "scheduled_arrival", "actual_arrival", "cancelled",
    "delay_code", "delay_duration_minutes", "departure_delay_minutes", "arrival_delay_minutes",
    "scheduled_flight_duration_minutes", "aircraft_code", "aircraft_name",
    "departure_city_code", "departure_city_name", "departure_country_code", "departure_country_name",
    "arrival_city_code", "arrival_city_name", "arrival_country_code", "arrival_country_name",
    "departure_weekday", "departure_month", "departure_hour", "departure_monthday",
    "nb_flight_departing_departure_airport", "nb_flight_arriving_departure_airport",
    "nb_flight_departing_arrival_airport", "nb_flight_arriving_arrival_airport",
    "departure_airport_delayed_share", "aircraft_delayed_share", "airline_delayed_share", "is_delayed",
)


#: Legs of one date that meet their lookups in one partition.
CHUNK_LEGS = 500_000


#: So many entity days at most are sent to every task, some 100 bytes each; more are laid out with the legs.
SENT_DAYS = 300_000


def chunks_for(legs: DataFrame, days: DataFrame | None = None) -> int:
    """Chunks that the legs of a date are dealt to, so that the busiest date has at most about ``CHUNK_LEGS`` in each.

    0 says that the entity ``days``, a written table, are at most ``SENT_DAYS``, and that the session lets the planner broadcast.
    """
    if days is not None and not legs.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-"):
        if days.count() <= SENT_DAYS:
            return 0
    busiest = legs.groupBy("flight_schedule_date").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    return max(1, -(-(busiest or 0) // CHUNK_LEGS))


def leg_outcomes(delays_leg: DataFrame) -> DataFrame:
    """Features that need only the leg itself: planned minutes, time parts and the label."""
    return delays_leg.select(
        "*",
        iso_minutes(F.col("scheduled_flight_duration")).alias("scheduled_flight_duration_minutes"),
        *time_parts(F.col("scheduled_departure"), "departure"),
        is_delayed(
            F.col("departure_delay_minutes"), F.col("arrival_delay_minutes"), F.col("delay_duration_minutes")
        ).alias("is_delayed"),
    )


def legs_ready(delays_leg: DataFrame, days: DataFrame, chunks: int = 1) -> DataFrame:
    """Attach the entity-day features to every leg; a leg without a match keeps zeros.

    ``days`` is the output of :func:`shares.entity_days`. Departure congestion and airport share have
    the same key, so four lookups serve five groups of features. All four share the flight date, so legs and lookups are
    laid out once by date and chunk, and the joins run inside that layout: the wide legs are shuffled once, on a key that no
    hub airport or carrier skews. ``chunks`` (:func:`chunks_for`) splits busy dates; the lookups, a row per entity and
    day, are repeated for each chunk. With 0 chunks the lookups, few by then, go to every task, and the legs are neither shuffled nor sorted.
    """
    place = ["flight_schedule_date", "chunk"] if chunks else ["flight_schedule_date"]
    dealt = days.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))) if chunks else days

    def lookup(kind: str, code: str, **columns: str) -> DataFrame:
        renamed = [F.col(source).alias(target) for target, source in columns.items()]
        rows = dealt.filter(F.col("kind") == kind).select(F.col("code").alias(code), *place, *renamed)
        return rows.repartition(*place) if chunks else F.broadcast(rows)

    departure = lookup(
        "airport",
        "departure_airport_code",
        nb_flight_departing_departure_airport="departing",
        nb_flight_arriving_departure_airport="arriving",
        departure_airport_delayed_share="delayed_share",
    )
    arrival = lookup(
        "airport",
        "arrival_airport_code",
        nb_flight_departing_arrival_airport="departing",
        nb_flight_arriving_arrival_airport="arriving",
    )
    aircraft = lookup("aircraft", "aircraft_code", aircraft_delayed_share="delayed_share")
    airline = lookup("airline", "airline_code", airline_delayed_share="delayed_share")

    base = delays_leg
    if chunks:
        base = base.withColumn("chunk", F.pmod(F.xxhash64("leg_id"), F.lit(chunks)).cast("int")).repartition(*place)
    for side, key in (
        (departure, "departure_airport_code"),
        (arrival, "arrival_airport_code"),
        (aircraft, "aircraft_code"),
        (airline, "airline_code"),
    ):
        base = base.join(side, [key, *place], "left")

    counts = [c for c in LEGS_READY_COLUMNS if c.startswith("nb_flight_")]
    shares = [c for c in LEGS_READY_COLUMNS if c.endswith("_delayed_share")]
    filled = {c: F.coalesce(c, F.lit(0).cast("long")) for c in counts} | {
        c: F.coalesce(c, F.lit(0.0)) for c in shares
    }
    return leg_outcomes(base).withColumns(filled).select(*LEGS_READY_COLUMNS)
