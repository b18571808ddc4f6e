"""Daily delay counts, airport congestion and rolling delayed shares."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import delay_flag
from .legs import active, event_counts, legs_with_flights

# Entity -> (key column, name of its share column).
ENTITIES = {
    "airport": ("departure_airport_code", "departure_airport_delayed_share"),
    "aircraft": ("aircraft_code", "aircraft_delayed_share"),
    "airline": ("airline_code", "airline_delayed_share"),
}
SHARE_DAYS = 7


def airport_congestion(legs_flights: DataFrame) -> DataFrame:
    """Departures and arrivals per airport and date, cancelled legs included.

    Each leg contributes to both its airports in one pass, so a single aggregation (combined before the
    shuffle) gives what two aggregations and a full outer join would.
    """
    ends = F.array(
        F.struct(F.col("departure_airport_code").alias("airport_code"), F.lit(1).alias("out"), F.lit(0).alias("in")),
        F.struct(F.col("arrival_airport_code").alias("airport_code"), F.lit(0).alias("out"), F.lit(1).alias("in")),
    )
    return (
        legs_flights.select("flight_schedule_date", F.inline(ends))
        .filter(F.col("airport_code").isNotNull())
        .groupBy("airport_code", "flight_schedule_date")
        .agg(F.sum("out").alias("nb_flight_departing"), F.sum("in").alias("nb_flight_arriving"))
    )


def daily_delay_counts(events: DataFrame, entity: str) -> DataFrame:
    """Delayed and total events per entity and day, from one row per delay event."""
    key, _ = ENTITIES[entity]
    return (
        active(events, key)
        .groupBy(key, F.to_date("flight_schedule_date").alias("flight_schedule_date"))
        .agg(
            F.sum(delay_flag(F.col("delay_duration"))).alias("delayed_count"),
            F.count(F.lit(1)).alias("total_count"),
        )
    )


def _trailing(key: str | list[str], day: str, days: int, include_current: bool) -> Window:
    keys = [key] if isinstance(key, str) else key
    return Window.partitionBy(*keys).orderBy(F.unix_date(F.col(day))).rangeBetween(-days, 0 if include_current else -1)


def _share(delayed: Column, total: Column) -> Column:
    return delayed * 100.0 / F.nullif(total, F.lit(0).cast("long"))


def rolling_share(
    daily: DataFrame,
    key: str,
    name: str,
    days: int = SHARE_DAYS,
    include_current: bool = True,
) -> DataFrame:
    """Share of delayed events over the day and the ``days`` calendar days before it.

    The window sees one row per entity and day, however many legs a hot entity has.
    """
    frame = _trailing(key, "flight_schedule_date", days, include_current)
    share = _share(F.sum("delayed_count").over(frame), F.sum("total_count").over(frame))
    return daily.select(key, "flight_schedule_date", share.alias(name))


def entity_share(
    legs: DataFrame, flights: DataFrame, delays: DataFrame, entity: str, include_current: bool = True
) -> DataFrame:
    """Rolling share of one entity straight from the raw tables."""
    key, name = ENTITIES[entity]
    return rolling_share(daily_counts(legs, flights, delays, entity), key, name, include_current=include_current)


def daily_counts(legs: DataFrame, flights: DataFrame, delays: DataFrame, entity: str) -> DataFrame:
    """As :func:`daily_delay_counts`, with the events of a leg combined before the join.

    The delay table is reduced to one row per leg first, so a leg with very many events cannot skew
    the join, and the join output is one row per leg.
    """
    key, _ = ENTITIES[entity]
    counts = event_counts(delays)
    base = active(legs_with_flights(legs, flights), key)
    return (
        base.join(counts, base["leg_id"] == counts["flight_leg_id"], "inner")
        .groupBy(key, F.to_date("flight_schedule_date").alias("flight_schedule_date"))
        .agg(F.sum("delayed").alias("delayed_count"), F.sum("events").alias("total_count"))
    )


def entity_days(
    legs: DataFrame,
    flights: DataFrame,
    delays: DataFrame,
    include_current: bool = True,
    flown_only: bool = False,
) -> DataFrame:
    """Every per-day feature of every entity in one pass over the legs."""
    counts = event_counts(delays)
    base = legs_with_flights(legs, flights)
    joined = base.join(counts, base["leg_id"] == counts["flight_leg_id"], "left")
    return entity_days_of(joined, include_current, flown_only)


def entity_days_of(leg_counts: DataFrame, include_current: bool = True, flown_only: bool = False) -> DataFrame:
    """As :func:`entity_days`, from legs that carry their numbers of ``events`` and ``delayed`` ones.

    Columns ``kind, code, flight_schedule_date, departing, arriving, delayed_share``. One shuffle of
    pre-combined rows replaces the separate congestion and share aggregations, and the share is null
    on a day without an active event, where the separate share tables have no row.
    """
    counted = ~F.coalesce("cancelled", F.lit(True))
    if flown_only:
        counted = counted & F.col("actual_departure").isNotNull()

    def entry(kind: str, column: str, departing: int, arriving: int, with_events: bool) -> Column:
        def events(name: str) -> Column:
            value = F.when(counted, F.col(name)) if with_events else F.lit(None)
            return value.cast("long").alias(name)

        return F.struct(
            F.lit(kind).alias("kind"),
            F.col(column).alias("code"),
            F.lit(departing).alias("departing"),
            F.lit(arriving).alias("arriving"),
            events("delayed"),
            events("events"),
        )

    entries = F.array(
        entry("airport", "departure_airport_code", 1, 0, True),
        entry("airport", "arrival_airport_code", 0, 1, False),
        entry("aircraft", "aircraft_code", 0, 0, True),
        entry("airline", "airline_code", 0, 0, True),
    )
    daily = (
        leg_counts.select("flight_schedule_date", F.inline(entries))
        .filter(F.col("code").isNotNull())
        .groupBy("kind", "code", "flight_schedule_date")
        .agg(*(F.sum(c).alias(c) for c in ("departing", "arriving", "delayed", "events")))
        .withColumn("day", F.to_date("flight_schedule_date"))
    )
    frame = _trailing(["kind", "code"], "day", SHARE_DAYS, include_current)
    share = _share(F.sum("delayed").over(frame), F.sum("events").over(frame))
    return daily.select(
        "kind",
        "code",
        "flight_schedule_date",
        "departing",
        "arriving",
        F.when(F.col("events") > 0, share).alias("delayed_share"),
    )


def share_increment_range(newest: date | None, days: int = SHARE_DAYS) -> tuple[date, date]:
    """(first input day, first output day) of an incremental share build.

    Output replays the last ``days`` days before the newest stored one; input starts another ``days``
    earlier so that every replayed frame is complete and equals a full build.
    """
    if newest is None:
        return date(1970, 1, 1), date(1970, 1, 1)
    return newest - timedelta(days=2 * days), newest - timedelta(days=days)


def share_increment(
    legs: DataFrame, flights: DataFrame, delays: DataFrame, entity: str, newest: date | None
) -> DataFrame:
    """Share rows to write when the stored table ends at ``newest``."""
    first_in, first_out = share_increment_range(newest)
    recent = flights.filter(F.col("flight_schedule_date") >= first_in.isoformat())
    return entity_share(legs, recent, delays, entity).filter(F.col("flight_schedule_date") >= F.lit(first_out))
