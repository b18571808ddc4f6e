"""The registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import (
    business_date,
    delay_flag,
    delay_minutes,
    event_status,
    event_volumes,
    instant,
    iso_minutes,
    newest_instant,
    time_parts,
    uuid5,
)
from ..functions import is_delayed as delayed_label
from ..operators import analytics, deltas, legs, mart, moments, observability, payloads, quality, ranges, scoring, shares, telemetry
from ..session import COMPACT, compactly_staged as staged, configure, scratch_path
from ..sources import documents, fixtures, footers, keys, normalize, tables
from ..sources.storage import FEW_PARTITIONS, stored_partitions, upsert_table
from ..streaming.daily import read_shares, stream_daily_counts
from ..streaming.ingest import stream_ingest
from ..streaming.logs import (
    corrected_rates,
    event_rates,
    stream_corrected_rates,
    stream_event_rates,
    stream_run_episodes,
    stream_runs,
)
from . import jobs, upkeep
from .build import RawTables, build_fact, build_features, build_leg_facts

AS_OF = date(2001, 8, 1)
METRIC_DAYS = 365
LO, HI = datetime(1996, 1, 1), datetime(1999, 12, 31, 23, 59, 59)
LOG_LO, LOG_HI = datetime(2024, 1, 3), datetime(2024, 1, 25, 12)
BUCKETS = 8
FRESH_AS_OF = datetime(2001, 8, 12)


class Given:
    """The flight, log and metric tables of one scale folder, built on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = configure(spark), sf_dir

    def _map(self, mapping: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
        return mapping(self.spark, self.dir)

    @cached_property
    def flights(self) -> DataFrame:
        return self._map(fixtures.flights)

    @cached_property
    def legs(self) -> DataFrame:
        return self._map(fixtures.legs)

    @cached_property
    def leg_keys(self) -> DataFrame:
        return self._map(fixtures.leg_keys)

    @cached_property
    def delays(self) -> DataFrame:
        return self._map(fixtures.delays)

    @cached_property
    def raw(self) -> RawTables:
        return RawTables(self.flights, self.legs, self.delays, self.leg_keys)

    @cached_property
    def docs(self) -> DataFrame:
        return self._map(fixtures.documents)

    @cached_property
    def predictions(self) -> DataFrame:
        return self._map(fixtures.predictions)

    @cached_property
    def joined(self) -> DataFrame:
        # The wide legs need not be sorted to meet their flights, which are narrow and one row each.
        return legs.legs_with_flights(self.legs, self.flights.hint("shuffle_hash"))

    @cached_property
    def leg_facts(self) -> DataFrame:
        return build_leg_facts(self.raw)

    @cached_property
    def fact(self) -> DataFrame:
        return build_fact(self.raw)

    @cached_property
    def raw_events(self) -> DataFrame:
        return self._map(fixtures.raw_events)

    @cached_property
    def events(self) -> DataFrame:
        return observability.enrich_events(self.raw_events)

    @cached_property
    def runs(self) -> DataFrame:
        return observability.fold_runs(observability.run_events(self.events))

    @cached_property
    def samples(self) -> DataFrame:
        return self._map(fixtures.samples)

    @cached_property
    def service_samples(self) -> DataFrame:
        return self._map(fixtures.service_samples)

    def metrics(self, dimension: str) -> DataFrame:
        return analytics.delay_metrics(self.leg_facts, dimension, AS_OF, METRIC_DAYS)


QUERIES: dict[str, Callable[[Given], DataFrame]] = {}


def query(function: Callable[[Given], DataFrame]) -> Callable[[Given], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def _round6(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# ---- sources, normalisation, sinks


def _landed(g: Given) -> str:
    path = scratch_path(g.spark, "landed")
    fixtures.land(fixtures.page_lines(g.spark, g.dir), path)
    return path


@query
def ingest_documents(g: Given) -> DataFrame:
    start, end = documents.resolve_window(None, LO.isoformat(), datetime.now(timezone.utc), HI.isoformat())
    docs = documents.read_flight_documents(g.spark, _landed(g), start, end)
    return docs.select(
        "id",
        F.col("flightNumber").alias("flight_number"),
        F.col("flightScheduleDate").alias("flight_schedule_date"),
        F.col("airline.code").alias("airline_code"),
        F.coalesce(F.size("flightLegs"), F.lit(0)).alias("nb_legs"),
    ).withColumn("nb_legs", F.greatest("nb_legs", F.lit(0)))


@query
def normalize_flights(g: Given) -> DataFrame:
    return normalize.normalize_flights(g.docs, F.lit(fixtures.FETCHED_AT).cast("timestamp"))


@query
def normalize_legs(g: Given) -> DataFrame:
    return normalize.normalize_legs(g.docs)


@query
def normalize_delays(g: Given) -> DataFrame:
    return normalize.normalize_delays(g.docs)


@query
def deterministic_ids(g: Given) -> DataFrame:
    return g.legs.select(F.col("id").alias("name"), uuid5(F.col("id")).alias("uuid"))


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).alias("bucket")


@query
def upsert_flights(g: Given) -> DataFrame:
    """Load, then merge a batch in which open flights arrive and planned ones move by 200 days, often to another partition."""
    year = F.substring("flight_schedule_date", 1, 4)
    path = scratch_path(g.spark, "flights")
    common = {"keys": ["id"], "partition_by": "year", "order_by": ["fetched_at"]}
    upsert_table(g.spark, path, g.flights.withColumn("year", year), **common)
    later = F.date_format(F.date_add(F.to_date("flight_schedule_date"), 200), "yyyy-MM-dd")
    open_ = g.flights.filter(F.col("flight_status_public") == "O")
    newest = open_.withColumns(
        {"flight_status_public": F.lit("A"), "fetched_at": F.col("fetched_at") + F.expr("INTERVAL 1 DAY")}
    )
    stale = open_.withColumns(
        {"flight_status_public": F.lit("X"), "fetched_at": F.col("fetched_at") + F.expr("INTERVAL 1 HOUR")}
    )
    moved = g.flights.filter(F.col("flight_status_public") == "P").withColumn("flight_schedule_date", later)
    batch = newest.unionByName(stale).unionByName(moved).withColumn("year", year)
    for _ in range(2):  # a replay must change nothing
        upsert_table(g.spark, path, batch, **common)
    return g.spark.read.schema(g.flights.schema).parquet(path).select(*g.flights.columns)


@query
def upsert_legs(g: Given) -> DataFrame:
    """Load, then merge a batch that reroutes cancelled legs, which moves them to another partition."""
    path = scratch_path(g.spark, "legs")
    columns = ["id", "flight_id", "arrival_airport_code", "published_status", "cancelled"]
    part = F.substring("arrival_airport_code", -1, 1)
    loaded = g.legs.select(*columns).withColumn("part", part)
    upsert_table(g.spark, path, loaded, keys=["id"], partition_by="part")
    rerouted = (
        g.legs.select(*columns)
        .filter("cancelled")
        .withColumns({"arrival_airport_code": F.lit("N3"), "published_status": F.lit("REROUTED")})
        .withColumn("part", part)
    )
    upsert_table(g.spark, path, rerouted, keys=["id"], partition_by="part")
    return g.spark.read.schema(loaded.schema).parquet(path).select(*columns)


@query
def upsert_delays(g: Given) -> DataFrame:
    """Load, then re-fetch the legs with two events, which now have one: the second must go."""
    path = scratch_path(g.spark, "delays")
    loaded = tables.stage_delays(g.delays).withColumn("bucket", _bucket("flight_leg_id"))
    upsert_table(g.spark, path, loaded, keys=["id"], partition_by="bucket", keys_may_move=False)
    scope = g.delays.filter(F.col("delay_code") == "C9").select("flight_leg_id")
    again = (
        loaded.join(scope, "flight_leg_id", "left_semi")
        .filter(F.coalesce(F.col("delay_code") != "C9", F.lit(True)))
        .withColumn("delay_duration", F.lit("PT1M"))
    )
    upsert_table(
        g.spark, path, again, keys=["id"], partition_by="bucket", keys_may_move=False, replace_scope=scope
    )
    return tables.stage_delays(g.spark.read.schema(loaded.schema).parquet(path))


@query
def upsert_predictions(g: Given) -> DataFrame:
    path = scratch_path(g.spark, "predictions")
    bucketed = g.predictions.withColumn("bucket", _bucket("leg_id").cast("int"))
    jobs.upsert_predictions(g.spark, path, bucketed, "bucket")
    batch = bucketed.filter(F.col("delay_predicted") == 1).withColumns(
        {"delay_predicted": F.lit(0), "timestamp": F.col("timestamp") + F.expr("INTERVAL 1 DAY")}
    )
    jobs.upsert_predictions(g.spark, path, batch, "bucket")
    return g.spark.read.schema(g.predictions.schema).parquet(path).select(*g.predictions.columns)


@query
def ingestion_metrics(g: Given) -> DataFrame:
    # Parsed once for the four counts, which read few of the written columns.
    landed = staged(documents.landed_rows(documents.read_pages(g.spark, _landed(g))), "landed-rows")
    start, end = documents.resolve_window(None, LO.isoformat(), datetime.now(timezone.utc), HI.isoformat())
    docs, pages = documents.explode_pages(landed, start, end), documents.pages_of(landed)
    return documents.ingestion_metrics(docs, normalize.normalize_legs(docs), normalize.normalize_delays(docs), pages)


@query
def write_checkpoint(g: Given) -> DataFrame:
    """Record the window up to the newest flight, then resume: the next window is the day after."""
    path = scratch_path(g.spark, "watermark")
    newest = g.flights.agg(F.max("flight_schedule_date")).first()[0]
    _, end = documents.resolve_window(None, newest, datetime.now(timezone.utc))
    documents.write_checkpoint(g.spark, path, end)
    start, _ = documents.resolve_window(documents.read_checkpoint(g.spark, path), None, datetime.now(timezone.utc))
    state = g.spark.read.schema("window_end string").parquet(path)
    return state.select("window_end", F.lit(start.date().isoformat()).alias("next_start"))


@query
def stage_flights(g: Given) -> DataFrame:
    return tables.stage_flights(g.flights)


@query
def stage_legs(g: Given) -> DataFrame:
    return tables.stage_legs(g.legs)


@query
def stage_delays(g: Given) -> DataFrame:
    return tables.stage_delays(g.delays)


@query
def materialize_modes(g: Given) -> DataFrame:
    days = mart.dim_date(g.joined).withColumn("year_key", F.substring("date_key", 1, 4))
    view = tables.materialize(days, "flight_days_view", "view")
    table = tables.materialize(days, "flight_days", "table", path=scratch_path(g.spark, "days"))
    path = scratch_path(g.spark, "days-incremental")
    for _ in range(2):
        merged = tables.materialize(
            days, "flight_days", "incremental", ["date_key"], path, partition_by="year_key"
        )
    found = [df.select(F.lit(mode).alias("mode"), "date_key", "day_of_week", "month", "year")
             for mode, df in (("view", view), ("table", table), ("incremental", merged))]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query
def ingest_job(g: Given) -> DataFrame:
    """The ingest job over two waves of pages: every flight with its children, both reports, and what was rejected."""
    house, source = jobs.Warehouse(scratch_path(g.spark, "ingest-house"), by="year"), scratch_path(g.spark, "ingest-pages")
    days = g.spark.read.parquet(f"{g.dir}/lineitem.parquet").agg(F.min("l_shipdate"), F.max("l_shipdate")).first()
    window = [d.date().isoformat() for d in days]
    out = []
    for n, wave in enumerate(fixtures.page_waves(g.spark, g.dir), 1):
        fixtures.land(wave, source)
        report = jobs.run_ingest(g.spark, source, house, *window, incremental=False, now=datetime(2002, 1, n, tzinfo=timezone.utc))
        names = ("status", "flights", "legs", "delays", "pages_skipped", "flights_rejected")
        out += [("report", f"{n}.{name}", str(report[name])) for name in names]
        out.append(("report", f"{n}.days_missing", str(len(report["days_missing"]))))
    raw = jobs.read_raw(g.spark, house)
    legs_ = raw.legs.groupBy("flight_id").agg(F.count(F.lit(1)).alias("legs"))
    delays = raw.delays.groupBy("flight_id").agg(F.count(F.lit(1)).alias("delays"))
    number = lambda c: F.coalesce(c, F.lit(0)).cast("string")
    flights = (
        raw.flights.withColumnRenamed("id", "flight_id").join(legs_, "flight_id", "left").join(delays, "flight_id", "left")
        .select(
            F.lit("flight").alias("kind"), F.col("flight_id").alias("name"),
            F.concat_ws("|", "flight_status_public", "flight_schedule_date", number("legs"), number("delays")).alias("value"),
        )
    )
    refused = g.spark.read.schema("kind string, batch string").parquet(house.path("rejects"))
    refused = refused.groupBy(F.concat_ws(".", "batch", "kind").alias("name")).agg(F.count(F.lit(1)).cast("string").alias("value"))
    reports = g.spark.createDataFrame(out, "kind string, name string, value string")
    return flights.unionByName(reports).unionByName(refused.select(F.lit("reject").alias("kind"), "name", "value"))


def _stored_raw(g: Given, house: jobs.Warehouse, flights: DataFrame, legs_: DataFrame, delays: DataFrame) -> None:
    """Merge raw rows as the ingest job does; legs and delays are replaced by their flights."""
    dated = legs_.join(flights.select(F.col("id").alias("flight_id"), "flight_schedule_date"), "flight_id")
    of_leg = dated.select(F.col("id").alias("flight_leg_id"), "flight_id", "flight_schedule_date")
    parents = flights.select(F.col("id").alias("flight_id"))
    for name, rows, scope in (("flights", flights, None), ("legs", dated, parents), ("delays", delays.join(of_leg, "flight_leg_id"), parents)):
        upsert_table(
            g.spark, house.path(name), house.with_period(rows), keys=["id"], partition_by="period", replace_scope=scope, unique=True
        )


@query
def refresh_job(g: Given) -> DataFrame:
    """Build everything, move some flights to other dates and shorten them, refresh the touched dates: equals a full build."""
    house = jobs.Warehouse(scratch_path(g.spark, "refresh-house"), by="month")
    _stored_raw(g, house, g.flights, g.legs, g.delays)
    jobs.run_transform(g.spark, house)
    old = g.flights.filter(F.col("id").cast("long") % 200 == 3)
    moved = old.withColumn("flight_schedule_date", F.date_add(F.to_date("flight_schedule_date"), 45).cast("string"))
    kept = g.legs.join(moved.select(F.col("id").alias("flight_id")), "flight_id", "left_semi").filter("leg_order < 2")
    left = g.delays.join(kept.select(F.col("id").alias("flight_leg_id")), "flight_leg_id", "left_semi")
    dates = {r[0] for r in old.unionByName(moved).select("flight_schedule_date").distinct().collect()}
    _stored_raw(g, house, moved, kept, left)
    jobs.run_transform(g.spark, house, dates)
    fact = jobs.read_fact(g.spark, house).drop("period")
    return _round6(fact, *_SHARES)


@query
def event_extra_json(g: Given) -> DataFrame:
    return g.events.select("id", "extra")


@query
def rows_processed(g: Given) -> DataFrame:
    """A results document per event: a number, a missing member, a text, and a fraction."""
    v = F.col("value").cast("int").cast("string")
    member = '{"adapter_response":{"rows_affected":'
    body = F.concat(
        F.lit('{"results":[' + member), v, F.lit('}},{"adapter_response":{}},' + member + '"7"}},{},' + member + "2.9}}]}")
    )
    docs = fixtures.given(g.spark, g.dir, "events").select(F.col("event_id").alias("id"), body.alias("body"))
    return tables.rows_processed(docs).select("id", "rows_processed")


# ---- scalar functions and predicates


@query
def delay_flag_(g: Given) -> DataFrame:
    return g.delays.select("id", "delay_duration", delay_flag(F.col("delay_duration")).alias("flag"))


@query
def is_delayed(g: Given) -> DataFrame:
    return legs.legs_with_delays(g.legs, g.flights, g.delays).select(
        "leg_id",
        delayed_label(
            F.col("departure_delay_minutes"), F.col("arrival_delay_minutes"), F.col("delay_duration_minutes")
        ).alias("is_delayed"),
    )


@query
def iso_minutes_(g: Given) -> DataFrame:
    return g.delays.select("id", "delay_duration", iso_minutes(F.col("delay_duration")).alias("minutes"))


@query
def delay_minutes_(g: Given) -> DataFrame:
    return g.legs.select(
        "id",
        delay_minutes(F.col("actual_departure"), F.col("scheduled_departure")).alias("departure_delay_minutes"),
        delay_minutes(F.col("actual_arrival"), F.col("scheduled_arrival")).alias("arrival_delay_minutes"),
    )


@query
def time_features(g: Given) -> DataFrame:
    return g.legs.select("id", *time_parts(F.col("scheduled_departure")))


@query
def business_date_(g: Given) -> DataFrame:
    texts = ("explicit_business_date", "conf_start_date", "conf_business_date", "param_start_date")
    rest = ("logical_date", "interval_start", "event_at")
    return g.raw_events.select("id", business_date(*(F.col(c) for c in texts + rest)).alias("business_date"))


@query
def event_status_(g: Given) -> DataFrame:
    return g.events.select("id", event_status(F.col("level"), F.col("event_type")).alias("status"))


@query
def event_volumes_(g: Given) -> DataFrame:
    names = (
        "dag_id", "task_id", "event_type", "vols_ingested", "rows_inserted", "transformation_rows",
        "records_processed", "row_count",
    )
    ingested, transformed = event_volumes(*(F.col(c) for c in names))
    return g.events.select("id", ingested.alias("vols_ingested"), transformed.alias("transformation_rows"))


@query
def flight_label(g: Given) -> DataFrame:
    return analytics.flight_label(g.leg_facts).select("leg_id", "combined_field")


# ---- joins, aggregates, windows


@query
def legs_with_flights(g: Given) -> DataFrame:
    return g.joined


@query
def delay_events(g: Given) -> DataFrame:
    return legs.delay_events(g.legs, g.flights, g.delays).select(
        "leg_id", "flight_id", "flight_schedule_date", "airline_code", "delay_code", "delay_duration", "cancelled"
    )


@query
def delay_agg(g: Given) -> DataFrame:
    return legs.delay_agg(g.delays)


@query
def delays_per_leg(g: Given) -> DataFrame:
    return legs.delays_per_leg(g.legs, g.flights, g.delays, g.leg_keys)


@query
def airport_congestion(g: Given) -> DataFrame:
    return shares.airport_congestion(g.joined)


def _daily(entity: str) -> Callable[[Given], DataFrame]:
    return lambda g: shares.daily_counts(g.legs, g.flights, g.delays, entity)


def _share(entity: str) -> Callable[[Given], DataFrame]:
    name = shares.ENTITIES[entity][1]
    return lambda g: _round6(shares.entity_share(g.legs, g.flights, g.delays, entity), name)


for _entity in shares.ENTITIES:
    QUERIES[f"daily_delay_counts_{_entity}"] = _daily(_entity)
    QUERIES[f"share_{_entity}"] = _share(_entity)


@query
def share_deltas(g: Given) -> DataFrame:
    """Build counts and sums as if cancelled legs had flown and one flight in fifty were later by 20 days, then apply what differs."""
    key, share = shares.ENTITIES["airport"]
    path = scratch_path(g.spark, "share-deltas")
    counts = legs.event_counts(g.delays).withColumnRenamed("flight_leg_id", "leg_id")
    now = staged(
        g.joined.join(counts, "leg_id").select("flight_id", key, F.to_date(deltas.DAY).alias(deltas.DAY), "cancelled", "delayed", "events"), "share-rows"
    )
    moved = F.col("flight_id").cast("long") % 50 == 3
    then = now.withColumn(deltas.DAY, F.when(moved, F.date_add(deltas.DAY, 20)).otherwise(F.col(deltas.DAY)))
    active = now.filter(~F.col("cancelled"))
    upkeep.maintain_daily(g.spark, path, active.limit(0), then, "airport", by="month")
    differs = F.col("cancelled") | moved
    upkeep.maintain_daily(g.spark, path, then.filter(differs), active.filter(differs), "airport", by="month")
    daily = deltas.with_share(upkeep.read_daily(g.spark, path, "airport"), share).drop("period")
    return _round6(daily, share)


@query
def key_index(g: Given) -> DataFrame:
    """Where stored leg keys lie by the index, asked for the legs of one quantity and for as many names that no leg has."""
    path = scratch_path(g.spark, "key-index")
    rows = g.joined.select("leg_id", F.substring("flight_schedule_date", 1, 7).alias("period"))
    rows.hint("rebalance", "period").write.partitionBy("period").parquet(f"{path}/legs")
    stored = g.spark.read.schema("leg_id string, period string").parquet(f"{path}/legs")
    keys.store_keys(g.spark, f"{path}/keys", stored.select("period", F.col("leg_id").alias("key")))
    chosen = fixtures.given(g.spark, g.dir, "lineitem").filter("l_quantity = 7").select(fixtures.leg_key().alias("key"))
    asked = chosen.unionByName(chosen.select(F.concat(F.lit("x"), "key").alias("key")))
    return keys.stored_elsewhere(keys.read_index(g.spark, f"{path}/keys"), asked, stored, "leg_id")


@query
def share_increment(g: Given) -> DataFrame:
    rows = shares.share_increment(g.legs, g.flights, g.delays, "airport", date(2001, 7, 1))
    return _round6(rows, "departure_airport_delayed_share")


@query
def entity_days(g: Given) -> DataFrame:
    return _round6(shares.entity_days(g.legs, g.flights, g.delays), "delayed_share")


_SHARES = [name for _, name in shares.ENTITIES.values()]


@query
def legs_ready(g: Given) -> DataFrame:
    return _round6(build_features(g.raw), *_SHARES)


@query
def fct_flight_legs(g: Given) -> DataFrame:
    return _round6(g.fact, *_SHARES)


@query
def fact_increment(g: Given) -> DataFrame:
    """Rows to refresh when the stored fact ends before 2001."""
    stored = g.leg_facts.filter(F.col("scheduled_departure") < instant(datetime(2001, 1, 1)))
    newest = newest_instant(stored, "scheduled_departure")
    return mart.incremental_filter(g.leg_facts, newest, "scheduled_departure", 3).select(
        "leg_id", "scheduled_departure", "date_key"
    )


@query
def dim_airlines(g: Given) -> DataFrame:
    return mart.dim_airlines(g.joined)


@query
def dim_airports(g: Given) -> DataFrame:
    return mart.dim_airports(g.joined)


@query
def dim_date(g: Given) -> DataFrame:
    return mart.dim_date(g.joined)


# ---- analytics


def _metrics(dimension: str) -> Callable[[Given], DataFrame]:
    return lambda g: g.metrics(dimension)


for _dimension in analytics.DIMENSIONS:
    QUERIES[f"delay_metrics_{_dimension}"] = _metrics(_dimension)


@query
def delay_kpis(g: Given) -> DataFrame:
    return analytics.delay_kpis(g.metrics("airport"))


@query
def top_delayed(g: Given) -> DataFrame:
    return analytics.top_delayed(g.metrics("date"), 20)


@query
def worst_label(g: Given) -> DataFrame:
    return analytics.worst_label(g.metrics("city"))


@query
def confusion_matrix(g: Given) -> DataFrame:
    return analytics.confusion_matrix(g.predictions, g.leg_facts)


@query
def scored_days(g: Given) -> DataFrame:
    return analytics.scored_days(g.predictions, g.leg_facts)


@query
def future_days(g: Given) -> DataFrame:
    # 22:30 UTC is past midnight in Paris in summer.
    return analytics.future_days(analytics.scored_days(g.predictions, g.leg_facts), datetime(1999, 6, 30, 22, 30))


@query
def day_predictions(g: Given) -> DataFrame:
    return analytics.flight_label(analytics.day_predictions(g.predictions, g.leg_facts, "1998-03-10"))


@query
def row_counts(g: Given) -> DataFrame:
    present = analytics.row_count(g.spark, g.leg_facts).select(F.lit("fct_flight_legs").alias("table_name"), "rows")
    missing = tables.read_or_none(g.spark, scratch_path(g.spark, "missing"), g.flights.schema)
    absent = analytics.row_count(g.spark, missing).select(F.lit("missing").alias("table_name"), "rows")
    return present.unionByName(absent)


@query
def covered_traffic(g: Given) -> DataFrame:
    return analytics.covered_traffic(g.leg_facts, LO, HI)


_RANGE_DAYS = ("1996-01-01", "1999-12-31")


@query
def covered_range(g: Given) -> DataFrame:
    """Distinct legs and prediction rate of four years from what each day stores; the second half of the legs is numbered later."""
    day = F.date_format("scheduled_departure", "yyyy-MM-dd").alias("day")
    fact = staged(g.leg_facts.select("leg_id", day), "range-legs")
    late = F.pmod(F.xxhash64("leg_id"), F.lit(2)) == 0
    known = staged(ranges.numbered(fact.filter(late)), "range-numbers")
    numbers = staged(ranges.numbered(fact, known), "range-numbers")
    bitmaps, sketches = staged(ranges.day_bitmaps(fact, numbers), "range-bitmaps"), staged(ranges.day_sketches(fact), "range-sketches")
    rates = staged(ranges.day_rates(g.predictions.join(fact, "leg_id").select("day", "delay_predicted")), "range-rates")
    legs_ = ranges.distinct_legs(bitmaps, *_RANGE_DAYS)
    near = ranges.about_distinct_legs(sketches, *_RANGE_DAYS).withColumnRenamed("legs", "about")
    rate = ranges.predicted_rate(rates, *_RANGE_DAYS)
    one = F.lit(1).alias("one")
    joined = legs_.select("*", one).join(near.select("*", one), "one").join(rate.select("*", one), "one")
    return joined.select("legs", (F.abs(F.col("about") - F.col("legs")) <= 0.06 * F.col("legs")).alias("sketch_is_near"), "predicted_rate")


@query
def predicted_delay_rate(g: Given) -> DataFrame:
    return analytics.predicted_delay_rate(g.predictions, g.leg_facts, LO, HI)


@query
def unscored_legs(g: Given) -> DataFrame:
    return scoring.unscored_legs(g.leg_facts, g.predictions).select("leg_id", "flight_id", "is_delayed")


# ---- feature preparation and scoring


@query
def feature_frame(g: Given) -> DataFrame:
    return _round6(scoring.feature_frame(g.fact), *_SHARES)


@query
def impute_features(g: Given) -> DataFrame:
    frame = scoring.feature_frame(g.fact)
    means = scoring.fit_params(frame).means
    filled = scoring.impute(frame, means)
    return filled.withColumns({c: F.round(c, 6) for c in scoring.FEATURES})


@query
def scale_features(g: Given) -> DataFrame:
    frame = staged(scoring.feature_frame(g.fact), "features")
    params = scoring.fit_params(frame)
    scaled = scoring.scale(scoring.impute(frame, params.means), params)
    # A value at the mean is 0 or -0, as the sums were ordered.
    return scaled.withColumns({c: F.round(c, 4) + F.lit(0.0) for c in scoring.FEATURES})


@query
def fit_params(g: Given) -> DataFrame:
    """Fitted means and deviations of every feature."""
    params = scoring.fit_params(scoring.feature_frame(g.fact))
    rows = [(f, params.means[f], params.stds[f]) for f in scoring.FEATURES]
    fitted = g.spark.createDataFrame(rows, "feature string, mean double, std double")
    return fitted.select("feature", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


@query
def stored_moments(g: Given) -> DataFrame:
    """Parameters from the stored moments of each year but 1995, which is taken out of the combined ones."""
    frame = scoring.feature_frame(g.fact, ("date_key",)).withColumn("year", F.substring("date_key", 1, 4))
    stored = staged(moments.period_moments(frame, "year"), "moments")
    left = moments.without(moments.combined(stored), moments.combined(stored.filter("period = '1995'")))
    fitted = moments.parameters(left).join(left.select("feature", "rows"), "feature")
    return fitted.select("feature", "rows", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


def _stored_model(spark: SparkSession) -> scoring.DelayModel:
    """A model whose classifier is one line that SQL can say too; written and read back as any model is."""
    rule = "scheduled_flight_duration_minutes + 0.5D * departure_hour - departure_monthday > 0"
    line = SQLTransformer(statement=f"select *, cast({rule} as double) as prediction from __THIS__")
    # In an older spelling, as stored parameters may be.
    means = {"scheduledFlightDuration": 300.0, "departureHour": 12.0, "departureMonthDay": 15.0}
    stds = {"scheduledFlightDuration": 120.0, "departureHour": 6.0, "departureMonthDay": 8.0}
    path = scratch_path(spark, "model")
    scoring.DelayModel(scoring.FeatureParams(means, stds), PipelineModel([line])).save(spark, path)
    return scoring.DelayModel.load(spark, path)


@query
def score_legs(g: Given) -> DataFrame:
    unscored = scoring.unscored_legs(g.fact, g.predictions)
    return scoring.score(unscored, _stored_model(g.spark), datetime(2002, 1, 2))


@query
def fitted_scores(g: Given) -> DataFrame:
    """Fit on all flown legs, and score those without a prediction."""
    fact = staged(g.fact.select(*scoring.MODEL_COLUMNS), "fact")
    model = scoring.fit_delay_model(fact)
    return scoring.score(scoring.unscored_legs(fact, g.predictions), model, datetime(2002, 1, 2))


@query
def score_increment(g: Given) -> DataFrame:
    """Score what the given predictions leave open, merge it, and score again: nothing is left."""
    house = jobs.Warehouse(scratch_path(g.spark, "warehouse"), by="year")
    fact = house.with_period(g.fact, "date_key")
    # Legs have the periods of their flights; only for many of these are the wide rows dealt out by them.
    periods = house.with_period(g.flights).select("period").distinct().count()
    dealt = fact if periods <= FEW_PARTITIONS else fact.hint("rebalance", "period")
    dealt.write.options(**COMPACT).partitionBy("period").parquet(house.path("fct_flight_legs"))
    stored = jobs.read_fact(g.spark, house)
    known = g.predictions.join(stored.select("leg_id", "period"), "leg_id")
    jobs.upsert_predictions(g.spark, house.path("predictions"), known, "period")
    model = _stored_model(g.spark)
    years = [f"{p}-01-01" for p in sorted(stored_partitions(g.spark, house.path("fct_flight_legs"), "period"))]
    first = jobs.run_scoring(g.spark, house, model, datetime(2002, 1, 2), dates=years[::2])
    first += jobs.run_scoring(g.spark, house, model, datetime(2002, 1, 2))
    second = jobs.run_scoring(g.spark, house, model, datetime(2002, 1, 3))
    return jobs.read_predictions(g.spark, house).select(
        "leg_id", "delay_predicted", "timestamp", F.lit(first).cast("long").alias("first_run"), F.lit(second).cast("long").alias("second_run")
    )


# ---- observability


@query
def enrich_events(g: Given) -> DataFrame:
    return g.events.select(
        "id", "event_at", "app", "level", "layer", "dag_id", "task_id", "run_id", "event_type", "message", "business_date"
    )


@query
def fold_runs(g: Given) -> DataFrame:
    return g.runs


@query
def task_outcome_events(g: Given) -> DataFrame:
    kind, amount = F.col("event_type"), F.col("value").cast("int")
    pushed = F.when(
        F.col("user_id") % 3 == 0,
        F.create_map(F.lit("records_processed"), amount.cast("string"), F.lit("engine"), F.lit("batch")),
    )
    returned = F.when(kind == "purchase", F.create_map(F.lit("records_processed"), F.lit("1"), F.lit("vols_ingested"), F.lit("2")))
    outcomes = fixtures.given(g.spark, g.dir, "events").select(
        F.col("ts").alias("event_at"),
        F.lit("flights").alias("dag_id"),
        F.concat(F.lit("task"), F.col("event_id").cast("string")).alias("task_id"),
        F.lit("run").alias("run_id"),
        F.col("ts").alias("logical_date"),
        F.when(kind == "error", "timeout").alias("exception"),
        pushed.alias("metrics"),
        returned.alias("returned"),
        F.when(kind == "view", amount).alias("row_count"),
    )
    out = observability.task_outcome_events(outcomes, "TRUSTED", "task_success")
    members = F.transform(F.array_sort(F.map_entries("extra")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return out.select("task_id", "level", "layer", "event_type", "message", "business_date", F.array_join(members, ";").alias("extra"))


@query
def event_payloads(g: Given) -> DataFrame:
    """Members and volumes read from stored VARIANT payloads, some of which were cut."""
    cut = F.when(F.col("id") % 50 == 0, F.substring("extra", 1, 8)).otherwise(F.col("extra"))
    log = g.events.select("id", "dag_id", "task_id", "event_type", cut.alias("extra"))
    stored = staged(payloads.with_payload(log).drop("extra"), "payloads")
    ingested, transformed = payloads.payload_volumes(stored)
    return stored.select(
        "id", "broken", payloads.member("exception", "string").alias("exception"),
        payloads.member("explicit_business_date", "string").alias("explicit_date"),
        payloads.member("exception", "bigint").alias("no_number"),
        ingested.alias("vols_ingested"), transformed.alias("transformation_rows"),
    )


@query
def recent_logs(g: Given) -> DataFrame:
    return analytics.recent_logs(g.events, 50)


@query
def recent_logs_stored(g: Given) -> DataFrame:
    """The newest 50 of a log that was appended in two batches, from its newest days."""
    path = scratch_path(g.spark, "log")
    log = g.events.select("id", "event_at", "level", "layer", "dag_id", "task_id", "event_type", "message")
    for n in (0, 1):
        tables.append_events(log.filter(F.col("id") % 2 == n), path, f"batch-{n}")
    schema = log.withColumns({"event_day": F.to_date("event_at"), "batch": F.lit("")}).schema
    return analytics.recent_logs(tables.newest_days(g.spark, path, schema, 50), 50)


@query
def recent_logs_short(g: Given) -> DataFrame:
    return analytics.recent_logs(g.events, 15)


@query
def error_logs(g: Given) -> DataFrame:
    return analytics.error_logs(g.events)


@query
def log_metrics(g: Given) -> DataFrame:
    return analytics.log_metrics(g.events)


@query
def ingestion_freshness(g: Given) -> DataFrame:
    return analytics.ingestion_freshness(g.runs)


@query
def successful_ingestions(g: Given) -> DataFrame:
    return analytics.successful_ingestions(g.events, LOG_LO, LOG_HI)


@query
def mean_run_minutes(g: Given) -> DataFrame:
    return analytics.mean_run_minutes(g.runs, LOG_LO, LOG_HI)


@query
def throughput(g: Given) -> DataFrame:
    return analytics.throughput(g.runs, LOG_LO, LOG_HI)


@query
def run_audit(g: Given) -> DataFrame:
    return analytics.run_audit(g.runs, LOG_LO, LOG_HI)


# ---- data quality


@query
def dq_unique(g: Given) -> DataFrame:
    return quality.check_unique(mart.dim_airlines(g.joined), "airline_key", "warn", "dim_airlines")


@query
def dq_not_null(g: Given) -> DataFrame:
    return quality.check_not_null(g.legs, "id", "departure_airport_code", "scheduled_departure", table="legs")


@query
def dq_freshness(g: Given) -> DataFrame:
    """Ages of three sources: flights by date, legs by departure, log events."""
    flights = g.flights.withColumn("day", F.to_timestamp("flight_schedule_date"))
    checks = [
        quality.check_freshness(flights, "day", FRESH_AS_OF, table="flights"),
        quality.check_freshness(g.legs, "scheduled_departure", FRESH_AS_OF, table="legs"),
        quality.check_freshness(g.events, "event_at", datetime(2024, 2, 12), table="events"),
    ]
    return quality.dq_report(checks)


@query
def source_freshness(g: Given) -> DataFrame:
    """Ages and sizes of three stored sources from file footers; a fourth is missing."""
    root, places = scratch_path(g.spark, "sources"), {}
    moments_ = {
        "flights": (g.flights, F.to_timestamp("flight_schedule_date")), "legs": (g.legs, F.col("scheduled_departure")),
        "events": (g.events, F.col("event_at") - F.expr("INTERVAL 8200 DAYS")),
    }
    for name, (rows, moment) in moments_.items():
        places[name] = f"{root}/{name}"
        rows.select("id", F.unix_micros(moment).alias("fetched_us")).write.parquet(places[name])
    ages = footers.source_ages(g.spark, places | {"missing": f"{root}/missing"}, "fetched_us")
    checks = []
    for name in (*places, "missing"):
        of = ages.filter(F.col("source") == name)
        checks += [quality.check_freshness(of, "newest", FRESH_AS_OF, table=name), quality.check_stated_rows(of, table=name)]
    return quality.dq_report(checks)


@query
def dq_row_count(g: Given) -> DataFrame:
    return quality.check_row_count(g.flights, table="flights")


@query
def dq_report(g: Given) -> DataFrame:
    checks = quality.star_schema_checks(
        g.leg_facts, mart.dim_date(g.joined), mart.dim_airlines(g.joined), mart.dim_airports(g.joined)
    )
    return quality.dq_report(checks)


# ---- metric samples


@query
def gauge_latest(g: Given) -> DataFrame:
    newest = telemetry.gauge_latest(g.samples, "process_resident_memory_bytes")
    return newest.select("job", "instance", telemetry.label("status").alias("status"), "ts", "value")


@query
def gauge_max(g: Given) -> DataFrame:
    return telemetry.gauge_max(g.samples, "process_resident_memory_bytes")


@query
def gauge_diff(g: Given) -> DataFrame:
    out = telemetry.gauge_diff(g.samples, "node_filesystem_size_bytes", "node_filesystem_free_bytes")
    return out.select("job", "instance", telemetry.label("status").alias("status"), F.round("value", 6).alias("value"))


@query
def gauge_ratio(g: Given) -> DataFrame:
    out = telemetry.gauge_ratio(g.samples, "node_filesystem_free_bytes", "node_filesystem_size_bytes")
    return _round6(out, "numerator", "denominator", "percent")


RATE_WINDOW, RATE_STEP = 6 * 3600, 2 * 3600


@query
def counter_rate(g: Given) -> DataFrame:
    rates = telemetry.counter_rate(g.samples, "http_requests_total", RATE_WINDOW, RATE_STEP, ["job", "status"])
    return _round6(rates, "rate")


@query
def counter_increase(g: Given) -> DataFrame:
    rows = telemetry.counter_increase(g.samples, "http_requests_total", RATE_WINDOW, RATE_STEP, "status", "5..")
    return _round6(rows, "increase")


@query
def down_targets(g: Given) -> DataFrame:
    out = telemetry.down_targets(g.samples)
    return out.select("job", "instance", telemetry.label("status").alias("status"), "ts")


@query
def counter_rate_total(g: Given) -> DataFrame:
    """The rate over all series of one status, at every evaluation time, also where there is none."""
    chosen = telemetry.label("status") == "503"
    return _round6(telemetry.counter_rate(g.samples, "http_requests_total", 600, 300, where=chosen), "rate")


@query
def busy_percent(g: Given) -> DataFrame:
    return _round6(telemetry.busy_percent(g.service_samples), "value")


@query
def free_space(g: Given) -> DataFrame:
    signal = telemetry.free_space_signal(
        g.service_samples, "ServerDiskSpaceLow", "node_filesystem_free_bytes", "node_filesystem_size_bytes"
    )
    return _round6(signal, "value")


@query
def sustained_alerts(g: Given) -> DataFrame:
    """The seven rules over the signals they are about."""
    signals = telemetry.service_signals(g.service_samples)
    return telemetry.sustained_alerts(signals, telemetry.rules_table(g.spark))


# ---- streaming


def _events_stream(g: Given) -> DataFrame:
    return observability.enrich_events(fixtures.event_payloads(fixtures.given_stream(g.spark, g.dir, "events")))


@query
def stream_ingest_(g: Given) -> DataFrame:
    """Drain landed pages into raw tables: every flight with the number of its legs and delays."""
    house = jobs.Warehouse(scratch_path(g.spark, "stream-house"), by="year")
    state = scratch_path(g.spark, "stream-state")
    stream_ingest(g.spark, _landed(g), house, state, datetime(2002, 1, 1)).awaitTermination()
    raw = jobs.read_raw(g.spark, house)
    legs_ = raw.legs.groupBy("flight_id").agg(F.count(F.lit(1)).alias("legs"))
    delays = raw.delays.groupBy("flight_id").agg(F.count(F.lit(1)).alias("delays"))
    joined = raw.flights.withColumnRenamed("id", "flight_id").join(legs_, "flight_id", "left").join(delays, "flight_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return joined.select("flight_id", "flight_schedule_date", zero("legs"), zero("delays"))


def _in_waves(g: Given, rows: DataFrame, key: str, drain: Callable[[str], StreamingQuery], first: Column | None = None) -> None:
    """Land thirds of the rows out of order, the first one twice, each drained as a batch of its own."""
    path = scratch_path(g.spark, "waves")
    third = F.pmod(F.xxhash64(key), F.lit(3))
    third = third if first is None else F.when(first, 2).otherwise(third)
    for n in (2, 0, 1, 2):
        rows.filter(third == n).write.mode("append").parquet(path)
        drain(path).awaitTermination()


@query
def stream_runs_(g: Given) -> DataFrame:
    target, state = scratch_path(g.spark, "stream-runs"), scratch_path(g.spark, "stream-state")
    given = fixtures.given(g.spark, g.dir, "events")

    def drain(path: str) -> StreamingQuery:
        events = g.spark.readStream.schema(given.schema).parquet(path)
        return stream_runs(observability.enrich_events(fixtures.event_payloads(events)), target, state)

    _in_waves(g, given, "event_id", drain)
    return g.spark.read.schema(g.runs.schema).parquet(f"{target}/runs")


@query
def stream_event_rates_(g: Given) -> DataFrame:
    target = scratch_path(g.spark, "stream-rates")
    state = scratch_path(g.spark, "stream-state")
    stream_event_rates(_events_stream(g), "6 hours", "2 hours", "1 hour", target, state).awaitTermination()
    return _round6(g.spark.read.schema(event_rates(g.events, "1 hour").schema).parquet(target), "error_rate")


@query
def corrected_event_rates(g: Given) -> DataFrame:
    """Rates from three waves out of order, each hour of lateness exceeded by far."""
    target, state = scratch_path(g.spark, "corrected-rates"), scratch_path(g.spark, "stream-state")
    log = g.events.select("id", "event_at", "level")

    def drain(path: str) -> StreamingQuery:
        stream = g.spark.readStream.schema(log.schema).parquet(path)
        return stream_corrected_rates(stream.dropDuplicates(["id"]), "6 hours", "2 hours", "1 hour", target, state)

    _in_waves(g, log, "id", drain)
    return _round6(corrected_rates(g.spark, target).drop("late_events"), "error_rate")


@query
def run_episodes(g: Given) -> DataFrame:
    """Episodes of runs that were silent for six hours, appended by a stream."""
    target, state = scratch_path(g.spark, "episodes"), scratch_path(g.spark, "stream-state")
    stream_run_episodes(_events_stream(g), "6 hours", "1 hour", target, state).awaitTermination()
    whole = observability.run_episodes(observability.run_events(g.events), "6 hours")
    return g.spark.read.schema(whole.schema).parquet(target)


@query
def stream_daily_counts_(g: Given) -> DataFrame:
    """Counts and shares from out-of-order batches; the first holds events ten years ahead."""
    target, state = scratch_path(g.spark, "stream-daily"), scratch_path(g.spark, "stream-state")
    ahead = F.col("flight_id").cast("long") % 100 == 7
    day = F.to_date("flight_schedule_date")
    flights = g.flights.select(F.col("id").alias("flight_id"), "flight_schedule_date")
    events = fixtures.departure_events(fixtures.given(g.spark, g.dir, "lineitem")).join(flights, "flight_id")
    dated = events.withColumn("event_day", F.when(ahead, F.date_add(day, 3650)).otherwise(day).cast("timestamp"))

    def drain(path: str) -> StreamingQuery:
        return stream_daily_counts(g.spark.readStream.schema(dated.schema).parquet(path), "airport", target, state, by="year")

    _in_waves(g, dated, "id", drain, first=ahead)
    return _round6(read_shares(g.spark, target, "airport"), shares.ENTITIES["airport"][1])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query as a function of a session and a scale folder."""

    def bound(function: Callable[[Given], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: function(Given(spark, sf_dir))

    return {name.rstrip("_"): bound(function) for name, function in QUERIES.items()}
