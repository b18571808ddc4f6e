"""Fact and dimensions. The airport dimension has the six intended columns, city code included."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dow_sunday0, instant

_KEY_NAMES = {
    "airline_code": "airline_key",
    "departure_airport_code": "departure_airport_key",
    "arrival_airport_code": "arrival_airport_key",
    "flight_schedule_date": "date_key",
}

# Declared output columns of the fact, by their name in the feature table.
_FACT_SOURCE = (
    "leg_id", "flight_id", "flight_number", "airline_code", "airline_name",
    "departure_airport_code", "arrival_airport_code", "departure_airport_name", "arrival_airport_name",
    "departure_city_name", "flight_schedule_date",
    "scheduled_departure", "actual_departure", "scheduled_arrival", "actual_arrival", "cancelled",
    "delay_code", "delay_duration_minutes", "departure_delay_minutes", "arrival_delay_minutes",
    "scheduled_flight_duration_minutes", "aircraft_code", "aircraft_name",
    "departure_weekday", "departure_month", "departure_hour", "departure_monthday",
    "nb_flight_departing_departure_airport", "nb_flight_arriving_departure_airport",
    "nb_flight_departing_arrival_airport", "nb_flight_arriving_arrival_airport",
    "departure_airport_delayed_share", "aircraft_delayed_share", "airline_delayed_share", "is_delayed",
)


def fct_flight_legs(ready: DataFrame) -> DataFrame:
    """The fact: feature rows with the join columns renamed to keys."""
    return ready.select(*(F.col(c).alias(_KEY_NAMES.get(c, c)) for c in _FACT_SOURCE))


def leg_facts(outcomes: DataFrame) -> DataFrame:
    """The fact without its entity-day columns, for questions that do not use them."""
    return outcomes.select(*(F.col(c).alias(_KEY_NAMES.get(c, c)) for c in _FACT_SOURCE if c in outcomes.columns))


def incremental_filter(df: DataFrame, newest: datetime | None, column: str, days: int = 3) -> DataFrame:
    """Rows at or after ``newest`` minus ``days``; all rows when nothing is stored yet.

    The bound is a literal, so it prunes partitions and parquet row groups at planning.
    """
    if newest is None:
        return df
    return df.filter(F.col(column) >= instant(newest - timedelta(days=days)))


def dim_airlines(legs: DataFrame) -> DataFrame:
    """Distinct airline code and name; a code with two spellings gives two rows."""
    return (
        legs.filter(F.col("airline_code").isNotNull())
        .select(F.col("airline_code").alias("airline_key"), "airline_name")
        .distinct()
    )


def dim_airports(legs: DataFrame) -> DataFrame:
    """Distinct airports over both ends of every leg, in one pass."""

    def end(side: str):
        names = ("city_code", "city_name", "country_code", "country_name")
        return F.struct(
            F.col(f"{side}_airport_code").alias("airport_key"),
            F.col(f"{side}_airport_name").alias("airport_name"),
            *(F.col(f"{side}_{n}").alias(n) for n in names),
        )

    return (
        legs.select(F.inline(F.array(end("departure"), end("arrival"))))
        .filter(F.col("airport_key").isNotNull())
        .distinct()
    )


def dim_date(legs: DataFrame) -> DataFrame:
    """Distinct flight dates with weekday (Sunday = 0), month and year."""
    day = F.to_date("date_key")
    keys = (
        legs.filter(F.col("flight_schedule_date").isNotNull())
        .select(F.col("flight_schedule_date").alias("date_key"))
        .distinct()
    )
    return keys.select(
        "date_key",
        day.alias("flight_schedule_date"),
        dow_sunday0(day).alias("day_of_week"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
    )


_PART_COLUMNS = ("name", "city_code", "city_name", "country_code", "country_name")


def dimension_parts(legs: DataFrame, period: str) -> DataFrame:
    """The distinct dimension rows of each period: kind, key and attributes. Dimensions are their union over the periods."""

    def part(kind: str, key: str, *attributes: str) -> Column:
        values = [F.col(a) for a in attributes] + [F.lit(None).cast("string")] * (len(_PART_COLUMNS) - len(attributes))
        return F.struct(
            F.lit(kind).alias("kind"), F.col(key).alias("key"), *(v.alias(n) for v, n in zip(values, _PART_COLUMNS))
        )

    def airport(side: str) -> Column:
        attributes = ("airport_name", *_PART_COLUMNS[1:])
        return part("airport", f"{side}_airport_code", *(f"{side}_{a}" for a in attributes))

    parts = F.array(
        part("airline", "airline_code", "airline_name"), airport("departure"), airport("arrival"), part("date", "flight_schedule_date")
    )
    return legs.select(period, F.inline(parts)).filter(F.col("key").isNotNull()).distinct()


def dimensions(parts: DataFrame) -> dict[str, DataFrame]:
    """The three dimensions from their parts."""

    def of(kind: str) -> DataFrame:
        return parts.filter(F.col("kind") == kind)

    airports = of("airport").select(F.col("key").alias("airport_key"), F.col("name").alias("airport_name"), *_PART_COLUMNS[1:])
    return {
        "dim_airlines": dim_airlines(of("airline").select(F.col("key").alias("airline_code"), F.col("name").alias("airline_name"))),
        "dim_airports": airports.distinct(),
        "dim_date": dim_date(of("date").select(F.col("key").alias("flight_schedule_date"))),
    }
