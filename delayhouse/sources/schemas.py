"""Explicit schemas of every input and stored table; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _I, _L, _TS, _D = T.StringType(), T.IntegerType(), T.LongType(), T.TimestampType(), T.DateType()

_COUNTRY = _struct(code=_S, name=_S)
_CITY = _struct(code=_S, name=_S, country=_COUNTRY)
_AIRPORT = _struct(code=_S, name=_S, city=_CITY)
_TIMES = _struct(scheduled=_S, actual=_S)
_END = _struct(airport=_AIRPORT, times=_TIMES)
_DELAY = _struct(delayCode=_S, delayReasonPublicLangTransl=_S, delayDuration=_S)
_IRREGULARITY = _struct(
    cancelled=_S,
    delayInformation=T.ArrayType(_DELAY),
    delayCode=T.ArrayType(_S),
    delayDuration=T.ArrayType(_S),
)
_LEG = _struct(
    publishedStatus=_S,
    scheduledFlightDuration=_S,
    departureInformation=_END,
    arrivalInformation=_END,
    aircraft=_struct(typeCode=_S, typeName=_S),
    irregularity=_IRREGULARITY,
)
FLIGHT_DOCUMENT = _struct(
    id=_S,
    flightNumber=_I,
    flightScheduleDate=_S,
    airline=_struct(code=_S, name=_S),
    haul=_S,
    # Kept as JSON text: no operator looks inside it.
    route=_S,
    flightStatusPublic=_S,
    flightLegs=T.ArrayType(_LEG),
)
PAGE_DOCUMENT = _struct(
    page=_struct(pageNumber=_I, totalPages=_I),
    operationalFlights=T.ArrayType(FLIGHT_DOCUMENT),
)

FLIGHTS = _struct(
    id=_S,
    flight_number=_I,
    flight_schedule_date=_S,
    airline_code=_S,
    airline_name=_S,
    haul=_S,
    flight_status_public=_S,
    fetched_at=_TS,
)
LEGS = _struct(
    id=_S,
    flight_id=_S,
    leg_order=_I,
    departure_airport_code=_S,
    arrival_airport_code=_S,
    departure_airport_name=_S,
    arrival_airport_name=_S,
    published_status=_S,
    scheduled_departure=_TS,
    actual_departure=_TS,
    scheduled_arrival=_TS,
    actual_arrival=_TS,
    scheduled_flight_duration=_S,
    cancelled=T.BooleanType(),
    aircraft_code=_S,
    aircraft_name=_S,
    departure_city_code=_S,
    departure_city_name=_S,
    departure_country_code=_S,
    departure_country_name=_S,
    arrival_city_code=_S,
    arrival_city_name=_S,
    arrival_country_code=_S,
    arrival_country_name=_S,
)
DELAYS = _struct(id=_S, flight_leg_id=_S, delay_code=_S, delay_duration=_S)
PREDICTIONS = _struct(leg_id=_S, flight_id=_S, delay_predicted=_I, timestamp=_TS)
EVENTS = _struct(
    id=_L,
    event_at=_TS,
    app=_S,
    level=_S,
    layer=_S,
    dag_id=_S,
    task_id=_S,
    run_id=_S,
    event_type=_S,
    message=_S,
    extra=_S,
)
RUNS = _struct(
    run_id=_S,
    dag_id=_S,
    date_metier=_D,
    started_at=_TS,
    status=_S,
    vols_ingested=_L,
    transformation_rows=_L,
    finished_at=_TS,
    duration_sec=_L,
    error_message=_S,
    execution_context=_S,
)
SAMPLES = _struct(
    job=_S, instance=_S, metric=_S, labels=T.MapType(_S, _S), ts=_TS, value=T.DoubleType()
)
