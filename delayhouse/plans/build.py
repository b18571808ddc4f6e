"""Raw tables to features, fact and dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.features import chunks_for, leg_outcomes, legs_ready
from ..operators.legs import DELAYS_LEG_COLUMNS, delay_stats, delays_at_flights, legs_with_delays, legs_with_stats
from ..operators.mart import fct_flight_legs, leg_facts
from ..operators.shares import entity_days_of
from ..session import compactly_staged as staged


@dataclass(frozen=True)
class RawTables:
    flights: DataFrame
    legs: DataFrame
    delays: DataFrame
    #: ``id`` and ``flight_id`` of the legs alone, where there is a cheaper reading of them than from ``legs``.
    keys: DataFrame | None = None


def build_features(raw: RawTables, include_current: bool = True, flown_only: bool = False) -> DataFrame:
    """The feature table of every leg.

    Legs, flights and delays are read and joined once; the joined legs are written, and the entity days come from a narrow
    projection of them. The entity-day table is small beside the legs and read by four joins, so it is written once too.
    """
    # Narrow, and written, so that the join of the wide legs reads each table once; the legs' keys alone are read before it.
    keys = raw.legs if raw.keys is None else raw.keys
    stats = staged(delays_at_flights(keys, delay_stats(raw.delays)), "leg-stats")
    base = staged(legs_with_stats(raw.legs, raw.flights, stats), "leg-delays")
    days = staged(entity_days_of(base, include_current, flown_only), "entity-days")
    return legs_ready(base.select(*DELAYS_LEG_COLUMNS), days, chunks_for(base, days))


def build_fact(raw: RawTables, **options) -> DataFrame:
    """The fact over all legs."""
    return fct_flight_legs(build_features(raw, **options))


def build_leg_facts(raw: RawTables) -> DataFrame:
    """The fact without entity-day columns: one join chain, no lookups."""
    # Those who ask for it need few columns, so here the legs go to their delays.
    base = legs_with_delays(raw.legs, raw.flights, raw.delays)
    return leg_facts(leg_outcomes(base.select(*DELAYS_LEG_COLUMNS)))
