"""The given order, line-item and event tables read as flight, log and metric tables.

Each mapping is narrow (no join, no window), so a query over these tables costs what the query's own
operators cost. A third of the departures use one hub airport, which exercises hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .schemas import PAGE_DOCUMENT

FETCHED_AT = "2002-01-01 06:00:00"


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, with its zone-less timestamps read as UTC."""
    return _zoned(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def given_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a stream of files."""
    path = f"{sf_dir}/{name}.parquet"
    # As a pattern, the source accepts a single file as well as a folder.
    return _zoned(spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path}*"))


def _zoned(df: DataFrame) -> DataFrame:
    casts = {
        f.name: F.col(f.name).cast("timestamp") for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"
    }
    return df.withColumns(casts) if casts else df


def _text(*parts) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _minutes(count: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), count)


def _hours(count: Column) -> Column:
    return F.make_dt_interval(F.lit(0), count)


def _q() -> Column:
    return F.col("l_quantity").cast("int")


def _cancelled() -> Column:
    return (F.col("l_returnflag") == "R") & (_q() > 40)


def leg_key() -> Column:
    parts = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return F.concat_ws("_", *(F.col(c).cast("string") for c in parts), F.date_format("l_shipdate", "yyyyMMdd"))


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flight per order."""
    name = F.when(F.col("o_custkey") % 97 == 0, F.lower("o_orderpriority")).otherwise(F.col("o_orderpriority"))
    return given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("int").alias("flight_number"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("flight_schedule_date"),
        F.substring("o_orderpriority", 1, 1).alias("airline_code"),
        name.alias("airline_name"),
        F.when(F.col("o_totalprice") > 250000, "LONG").otherwise("MEDIUM").alias("haul"),
        F.lit(None).cast("string").alias("route"),
        F.col("o_orderstatus").alias("flight_status_public"),
        F.lit(FETCHED_AT).cast("timestamp").alias("fetched_at"),
    )


def _airport_number(side: str) -> Column:
    if side == "departure":
        hub = F.when(F.col("l_suppkey") % 3 == 0, 0).otherwise(F.col("l_suppkey") % 25)
        return F.when(_q() != 50, hub)
    return (F.col("l_suppkey") + F.col("l_partkey")) % 25


def _place(side: str) -> list[Column]:
    n = _airport_number(side)
    return [
        _text("N", n).alias(f"{side}_airport_code"),
        _text("Airport ", n).alias(f"{side}_airport_name"),
        _text("C", n % 20).alias(f"{side}_city_code"),
        _text("City ", n % 20).alias(f"{side}_city_name"),
        _text("R", n % 5).alias(f"{side}_country_code"),
        _text("Country ", n % 5).alias(f"{side}_country_name"),
    ]


def _flight_key() -> Column:
    return F.col("l_orderkey").cast("string")


def leg_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id and flight of every leg, as they lie."""
    return given(spark, sf_dir, "lineitem").select(leg_key().alias("id"), _flight_key().alias("flight_id"))


def legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One leg per line item."""
    cancelled = _cancelled()
    size = F.col("l_partkey") % 50
    hours = (1 + F.col("l_partkey") % 9).cast("int")
    departure = F.when(_q() != 49, F.col("l_shipdate") + _hours(2 * F.col("l_linenumber")))
    seconds = F.make_dt_interval(F.lit(0), F.lit(0), _q() - 20, (size - 10).cast("decimal(18,6)"))
    actual = F.when(~cancelled, F.col("l_shipdate") + _hours(2 * F.col("l_linenumber")) + seconds)
    arrival = departure + _hours(hours)
    flight = _flight_key()
    # The narrow rows are dealt out by the key they are joined on, before the mapping widens them.
    return given(spark, sf_dir, "lineitem").repartition(flight).select(
        leg_key().alias("id"),
        flight.alias("flight_id"),
        (F.col("l_linenumber") - 1).cast("int").alias("leg_order"),
        *_place("departure"),
        *_place("arrival"),
        F.when(cancelled, "CANCELLED").otherwise("ARRIVED").alias("published_status"),
        departure.alias("scheduled_departure"),
        actual.alias("actual_departure"),
        arrival.alias("scheduled_arrival"),
        (actual + _hours(hours) + _minutes(_q() - 25)).alias("actual_arrival"),
        F.when(_q() % 4 == 0, _text("PT", hours, "H")).otherwise(_text("PT", hours, "H", _q(), "M"))
        .alias("scheduled_flight_duration"),
        cancelled.alias("cancelled"),
        _text("A", F.col("l_partkey") % 40).alias("aircraft_code"),
        _text("Aircraft ", F.col("l_partkey") % 40).alias("aircraft_name"),
    )


def _delay_entries() -> Column:
    none = F.col("l_returnflag") == "N"
    duration = (
        F.when(none, "00")
        .when(_q() < 10, F.lit(None).cast("string"))
        .when(_q() % 2 == 0, _text("PT", _q(), "M"))
        .otherwise(_text("PT", _q() % 3, "H", _q(), "M"))
    )
    first = F.struct(
        F.lit(0).alias("pos"),
        F.when(~none, _text("C", F.col("l_linenumber"))).alias("delay_code"),
        duration.alias("delay_duration"),
    )
    second = F.struct(F.lit(1).alias("pos"), F.lit("C9").alias("delay_code"), _text("PT", _q(), "M").alias("delay_duration"))
    twice = (F.col("l_returnflag") == "A") & (_q() % 5 == 0)
    return F.when(twice, F.array(first, second)).otherwise(F.array(first))


def delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One or two delay events per leg, with sentinel, null and several duration spellings."""
    return (
        given(spark, sf_dir, "lineitem")
        .select(leg_key().alias("flight_leg_id"), F.explode(_delay_entries()).alias("e"))
        .select(
            F.concat_ws("_", "flight_leg_id", F.col("e.pos").cast("string")).alias("id"),
            "flight_leg_id",
            F.col("e.delay_code").alias("delay_code"),
            F.lit(None).cast("string").alias("delay_reason"),
            F.col("e.delay_duration").alias("delay_duration"),
        )
    )


def departure_events(items: DataFrame) -> DataFrame:
    """Delay events with their departure airport, from a batch or a stream of line items."""
    return items.select(
        leg_key().alias("leg_id"),
        F.col("l_orderkey").cast("string").alias("flight_id"),
        _place("departure")[0],
        _cancelled().alias("cancelled"),
        F.explode(_delay_entries()).alias("e"),
    ).select(
        F.concat_ws("_", "leg_id", F.col("e.pos").cast("string")).alias("id"),
        "flight_id",
        "departure_airport_code",
        "cancelled",
        F.col("e.delay_duration").alias("delay_duration"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prediction for two thirds of the uncancelled legs."""
    return (
        given(spark, sf_dir, "lineitem")
        .filter(~_cancelled() & ((F.col("l_partkey") + F.col("l_linenumber")) % 3 != 0))
        .select(
            leg_key().alias("leg_id"),
            F.col("l_orderkey").cast("string").alias("flight_id"),
            F.when(_q() % 3 == 0, 1).otherwise(0).alias("delay_predicted"),
            F.lit(FETCHED_AT).cast("timestamp").alias("timestamp"),
        )
    )


def _json_place(number: Column, scheduled: Column, actual: Column | None) -> Column:
    city = _text(
        '{"code":"C', number % 20, '","name":"City ', number % 20,
        '","country":{"code":"R', number % 5, '","name":"Country ', number % 5, '"}}',
    )
    return _text(
        '{"airport":{"code":"N', number, '","name":"Airport ', number, '","city":',
        F.when(number != 7, city).otherwise("null"),
        '},"times":{"scheduled":"', scheduled, '","actual":',
        "null" if actual is None else _text('"', actual, '"'), "}}",
    )


def _json_leg(i: int) -> Column:
    """Leg ``i`` of a document; its irregularity takes every shape a source may send."""

    def stamp(hours: int, minutes: Column | None = None) -> Column:
        when = F.col("l_shipdate") + _hours(F.lit(hours))
        return F.date_format(when if minutes is None else when + _minutes(minutes), "yyyy-MM-dd'T'HH:mm:ss'Z'")

    kind, pt = (_q() + i) % 5, _text('"PT', _q(), 'M"')
    irregularity = (
        F.when(kind == 0, "null")
        .when(
            kind == 1,
            _text('{"cancelled":"N","delayInformation":[{"delayCode":"81","delayDuration":', pt,
                  '}],"delayCode":["81"],"delayDuration":[', pt, "]}"),
        )
        .when(
            kind == 2,
            _text('{"cancelled":"N","delayInformation":[],"delayCode":["A","B"],"delayDuration":[', pt, "]}"),
        )
        .when(
            kind == 3,
            _text('{"cancelled":"Y","delayInformation":[{"delayCode":"X","delayDuration":', pt,
                  '},{"delayCode":"Y","delayDuration":null}]}'),
        )
        .otherwise("{}")
    )
    return _text(
        '{"publishedStatus":"', F.when(kind == 3, "CANCELLED").otherwise("ARRIVED"),
        f'","scheduledFlightDuration":"PT{1 + i}H', _q(), 'M","departureInformation":',
        _json_place((F.col("l_suppkey") + i) % 25, stamp(2 * i), stamp(2 * i, _q())),
        ',"arrivalInformation":',
        _json_place((F.col("l_suppkey") + i + 1) % 25, stamp(2 * i + 2), None),
        ',"aircraft":{"typeCode":"A', F.col("l_partkey") % 40, '"},"irregularity":', irregularity, "}",
    )


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text of one nested flight document per line item, with zero to three legs."""
    count = 1 + F.col("l_linenumber") % 3
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    more = [F.when(count > i, _text(",", _json_leg(i))).otherwise("") for i in (1, 2)]
    airline = _text('{"code":"', F.col("l_linestatus"), '","name":"Airline ', F.col("l_linestatus"), '"}')
    text = _text(
        '{"id":"', F.concat_ws("+", day, F.col("l_linestatus"), leg_key()), '","flightNumber":',
        F.col("l_orderkey"), ',"flightScheduleDate":"', day, '","airline":',
        F.when(_q() != 2, airline).otherwise("null"),
        ',"haul":"MEDIUM","flightStatusPublic":"', F.col("l_returnflag"), '","flightLegs":',
        F.when(_q() != 1, _text("[", _json_leg(0), *more, "]")).otherwise("null"), "}",
    )
    return given(spark, sf_dir, "lineitem").select(
        text.alias("value"), (F.col("l_orderkey") % 50 == 0).alias("broken"), F.col("l_orderkey").alias("order_key")
    )


#: Compressed files are not split when they are read, so a file holds so many lines at most.
LANDED_LINES = 200_000


def land(lines: DataFrame, path: str) -> None:
    """Append JSON lines to a folder as compressed text, a small fraction of what they would take as they are."""
    writer = lines.write.mode("append").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    writer.option("maxRecordsPerFile", LANDED_LINES).text(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested flight documents, landed as JSON lines and read back.

    Read from files rather than parsed in place: the optimizer may repeat an inline parse per column used.
    """
    path = scratch_path(spark, "documents")
    land(document_lines(spark, sf_dir).select("value"), path)
    return spark.read.schema(PAGE_DOCUMENT["operationalFlights"].dataType.elementType).json(path)


def _page(document: Column) -> Column:
    return _text('{"page":{"totalPages":1},"operationalFlights":[', document, "]}")


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed page text, one page per flight document; some pages are cut short, as after a failed fetch."""
    page = _page(F.col("value"))
    return document_lines(spark, sf_dir).select(
        F.when(F.col("broken"), F.substring(page, 1, 40)).otherwise(page).alias("value")
    )


def page_waves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Pages landed in two waves. Of the first, some are cut, some have no date, and some hold a status that the second
    corrects, once to a larger and once to a smaller text; a tenth of the flights comes with the second only."""
    lines, k = document_lines(spark, sf_dir), F.col("order_key") % 10

    def status(text: str) -> Column:
        return F.regexp_replace("value", '"flightStatusPublic":"[^"]*"', f'"flightStatusPublic":"{text}"')

    early = F.when(k == 3, status("ZZ")).when(k == 4, status("AA")).otherwise(F.col("value"))
    dateless = F.regexp_replace(early, '"flightScheduleDate":"[^"]*"', '"flightScheduleDate":null')
    page = _page(F.when(F.col("order_key") % 50 == 1, dateless).otherwise(early))
    first = lines.filter(k != 5).select(F.when(F.col("broken"), F.substring(page, 1, 40)).otherwise(page).alias("value"))
    return first, lines.filter(k.isin(3, 4, 5)).select(_page(F.col("value")).alias("value"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipeline log payloads, one per event row."""
    return event_payloads(given(spark, sf_dir, "events"))


def event_payloads(events: DataFrame) -> DataFrame:
    """Log payloads from a batch or a stream of event rows."""
    kind = F.col("event_type")
    amount = F.col("value").cast("int")
    return events.select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("event_at"),
        F.lit("scheduler").alias("app"),
        F.when(kind == "error", "error").otherwise("info").alias("level"),
        F.when(kind == "view", "TRUSTED").otherwise("INGESTION").alias("layer"),
        F.when(F.col("user_id") % 2 == 0, "flights_ingest").otherwise("flights_transform").alias("dag_id"),
        F.when(kind == "view", "run_dbt").when(kind == "purchase", "ingest_task").otherwise("tracking").alias("task_id"),
        F.when(F.col("user_id") % 40 != 39, _text("run-", F.col("user_id") % 40, "-", F.date_format("ts", "yyyyMMdd")))
        .alias("run_id"),
        F.when(kind == "signup", "dag_started")
        .when(kind == "purchase", "ingestion_success")
        .when(kind == "error", "quality_check_failure")
        .when(kind == "view", "dbt_run_success")
        .alias("event_type"),
        _text("event ", F.col("event_id")).alias("message"),
        F.when(kind == "purchase", amount).alias("vols_ingested"),
        F.when(kind == "view", amount).alias("rows_inserted"),
        F.lit(None).cast("int").alias("transformation_rows"),
        F.when(kind == "click", amount).alias("records_processed"),
        F.lit(None).cast("int").alias("row_count"),
        F.when((kind == "error") & (F.col("user_id") % 3 == 0), "timeout").alias("exception"),
        F.when(F.col("user_id") % 5 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.col("user_id") % 5 == 1, "not a date")
        .alias("explicit_business_date"),
        F.when(F.col("user_id") % 7 == 0, F.lit(" 2024-02-01 ")).alias("conf_start_date"),
        F.when(F.col("user_id") % 7 == 1, F.lit("2024-02-02T10:00:00+00:00")).alias("conf_business_date"),
        F.when(F.col("user_id") % 7 == 2, F.lit("bad")).alias("param_start_date"),
        F.when(F.col("user_id") % 2 == 0, F.col("ts") - F.expr("INTERVAL 1 DAY")).alias("logical_date"),
        F.lit(None).cast("timestamp").alias("interval_start"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric samples: gauges from event values, and a counter that restarts every 500 events."""
    kind = F.col("event_type")
    metric = (
        F.when(kind == "click", "http_requests_total")
        .when(kind == "error", "up")
        .when(kind == "purchase", "node_filesystem_free_bytes")
        .when(kind == "signup", "node_filesystem_size_bytes")
        .otherwise("process_resident_memory_bytes")
    )
    value = (
        F.when(kind == "click", (F.col("event_id") % 500).cast("double"))
        .when(kind == "error", F.when(F.col("user_id") % 4 == 0, 0.0).otherwise(1.0))
        .when(kind == "signup", F.col("value") + 500.0)
        .otherwise(F.col("value"))
    )
    status = F.when(F.col("user_id") % 3 == 0, "500").when(F.col("user_id") % 3 == 1, "503").otherwise("200")
    return given(spark, sf_dir, "events").select(
        F.when(F.col("user_id") % 2 == 0, "api").otherwise("database").alias("job"),
        _text("i", F.col("user_id") % 10).alias("instance"),
        metric.alias("metric"),
        F.create_map(F.lit("status"), status, F.lit("mode"), F.lit("busy")).alias("labels"),
        F.col("ts"),
        value.alias("value"),
    )


def service_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of every metric that the alert rules are about; the events' times are drawn together fifty-fold."""
    kind = F.col("event_type")
    metric = (
        F.when(kind == "click", "node_cpu_seconds_total")
        .when(kind == "error", "up")
        .when(kind == "purchase", "node_filesystem_free_bytes")
        .when(kind == "signup", "node_filesystem_size_bytes")
        .otherwise("process_resident_memory_bytes")
    )
    value = (
        F.when(kind == "click", (F.col("event_id") % 500) * 0.25)
        .when(kind == "error", F.when(F.col("user_id") % 2 == 0, 0.0).otherwise(1.0))
        .when(kind == "signup", F.col("value") + 500.0)
        .when(kind == "purchase", F.col("value"))
        .otherwise(F.col("value") * 8000000.0)
    )
    job = F.when(F.col("user_id") % 2 == 0, "postgres-analytics").otherwise("fastapi-service")
    mode = F.when((kind == "click") & (F.col("user_id") % 3 != 0), "idle").otherwise("user")
    return given(spark, sf_dir, "events").select(
        job.alias("job"),
        _text("i", F.col("user_id") % 3).alias("instance"),
        metric.alias("metric"),
        F.create_map(F.lit("mode"), mode).alias("labels"),
        F.timestamp_micros(F.expr("unix_micros(ts) div 50")).alias("ts"),
        value.alias("value"),
    )
