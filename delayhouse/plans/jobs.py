"""The three jobs over stored tables: ingest, transform, score; and their command line."""

from __future__ import annotations

import argparse
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import instant, newest_instant
from ..operators import mart, quality, scoring
from ..operators.features import chunks_for, legs_ready
from ..operators.legs import DELAYS_LEG_COLUMNS, legs_with_delays, legs_with_delays_at_flights
from ..operators.shares import SHARE_DAYS, entity_days_of
from ..session import COMPACT, Stages, configure
from ..sources import documents, schemas
from ..sources.footers import source_ages
from ..sources.keys import read_index, store_keys, stored_elsewhere
from ..sources.normalize import normalize_delays, normalize_flights, normalize_legs
from ..sources.storage import latest, pruned, replace_partitions, settle, stored_partitions, upsert_table
from ..sources.tables import materialize, read_or_none
from .build import RawTables

_DATE = "flight_schedule_date"
_PERIOD = "period"
#: Time of the fetch in microseconds, as an integer because Parquet keeps statistics of those.
_FETCHED = "fetched_us"
_PERIOD_CHARS = {"day": 10, "month": 7, "year": 4}


@dataclass(frozen=True)
class Warehouse:
    """Stored tables below one root, partitioned by the day, month or year of the flight date."""

    root: str
    by: str = "day"

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def with_period(self, df: DataFrame, column: str = _DATE) -> DataFrame:
        return df.withColumn(_PERIOD, F.substring(column, 1, _PERIOD_CHARS[self.by]))

    def period(self, day: date) -> str:
        return day.isoformat()[: _PERIOD_CHARS[self.by]]

    def first_day(self, period: str) -> date:
        return date.fromisoformat(period + "-01-01"[len(period) - 4 :] if len(period) < 10 else period)


def latest_documents(docs: DataFrame) -> DataFrame:
    """One document per flight id; of several, the last landed when ``arrival`` is known."""
    if "arrival" in docs.columns:
        return latest(docs, ["id"], ["arrival"]).drop("arrival")
    return latest(docs, ["id"])


def _superseded(stages: Stages, docs: DataFrame) -> DataFrame | None:
    """Id and place of the documents of which a later one has landed; None if no flight comes twice.

    Only identifiers are shuffled to see which repeat, and only the places of those that do.
    """
    again = stages.add(docs.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id"), "repeated-ids")
    if again.isEmpty():
        return None
    places = docs.select("id", "arrival").join(again, "id", "left_semi")
    newest = places.groupBy("id").agg(F.max("arrival").alias("newest"))
    older = places.join(newest, "id").filter(F.col("arrival") < F.col("newest"))
    return stages.add(older.select("id", "arrival.line", "arrival.position"), "superseded")


def _current(stages: Stages, docs: DataFrame) -> DataFrame:
    """As :func:`latest_documents`. Documents that a line and a position tell apart are moved only if some flight comes twice."""
    placed = "arrival" in docs.columns and {"line", "position"} <= set(docs.schema["arrival"].dataType.names)
    if not placed:
        return stages.add(latest_documents(docs), "documents")
    older = _superseded(stages, docs)
    if older is None:
        return docs.drop("arrival")
    places = docs.select("*", "arrival.line", "arrival.position")
    return stages.add(places.join(older, ["id", "line", "position"], "left_anti").drop("line", "position", "arrival"), "documents")


def store_documents(spark: SparkSession, docs: DataFrame, house: Warehouse, fetched_at: datetime) -> dict:
    """Normalise documents and merge them into the three raw tables; returns counts and touched dates.

    A flight's legs and delays are replaced as a whole, so entries that vanished do not stay behind. Only the flights'
    keys are searched for flights that change their date; legs and delays lie where their flight lies. The touched dates
    include those that such flights leave. Documents without id or date are left out (``documents.usable``). ``docs`` is read
    several times, so it must be a written table.
    """
    seen = Observation()
    with Stages(spark, **COMPACT) as stages:
        batch = _current(stages, docs.filter(documents.usable(docs)))
        ids = stages.add(documents.observed_ingest(batch, seen).select("id", "flightScheduleDate"), "ids")
        parents = ids.select(F.col("id").alias("flight_id"))
        dates = _texts(ids.select("flightScheduleDate"))
        settle(spark, house.path("flights"), _PERIOD)
        if stored_partitions(spark, house.path("flights"), _PERIOD):
            stored = read_raw_table(spark, house, "flights").select("id", _DATE)
            dates |= _texts(stored.join(ids.select("id"), "id", "left_semi").select(_DATE))
        periods = {d[: _PERIOD_CHARS[house.by]] for d in dates}
        tables = {
            "flights": (normalize_flights(batch, fetched_at), ids.select("id")),
            "legs": (normalize_legs(batch, with_date=True), parents),
            "delays": (normalize_delays(batch, with_parent=True), parents),
        }
        moment = F.unix_micros(instant(fetched_at)).alias(_FETCHED)
        for name, (rows, scope) in tables.items():
            upsert_table(
                spark, house.path(name), house.with_period(rows).withColumn(_FETCHED, moment), keys=["id"], partition_by=_PERIOD, replace_scope=scope,
                unique=True, within=periods,
            )
        counts = {name: seen.get[name] or 0 for name in tables}
    return counts | {"dates": sorted(dates)}


def _texts(column: DataFrame) -> set[str]:
    """Distinct dates; as many as there are days, so small enough for the driver."""
    return {row[0] for row in column.distinct().collect() if row[0] is not None}


def run_ingest(
    spark: SparkSession,
    source: str,
    house: Warehouse,
    start: str | None = None,
    end: str | None = None,
    incremental: bool = True,
    now: datetime | None = None,
) -> dict:
    """Ingest what was landed, and check that every day of the window arrived completely.

    An incremental run reads the files landed since the newest arrival of the last complete window, and merges all their
    flights, those of earlier dates too. Cut pages and unusable flights go to the table ``rejects``. A day without any page, or with
    fewer pages than its pages announce, makes the run PARTIAL; then nothing is recorded, and the next run reads the same
    files again and asks for the same days. A run that raises is reported as FAILED. Reports are kept in ``ingestions``.
    """
    now = now or datetime.now(timezone.utc)
    state, report = house.path("checkpoint"), {"status": "FAILED", "started_at": now}
    try:
        done = documents.read_checkpoint(spark, state) if incremental else None
        since = documents.read_arrival(spark, state) if incremental else None
        first, last = documents.resolve_window(done, start, now, end)
        report |= {"window_start": first, "window_end": last}
        with Stages(spark, **COMPACT) as stages:
            # Parsed and written once; everything below reads the columns that it needs.
            landed = stages.add(documents.landed_rows(documents.read_pages(spark, source, since)), "landed")
            pages, flights = documents.pages_of(landed), documents.flights_of(landed)
            counts = store_documents(spark, flights, house, now)
            refused = documents.rejects(pages, flights).withColumn("batch", F.lit(now.strftime("%Y%m%dT%H%M%S")))
            replace_partitions(spark, house.path("rejects"), refused, "batch", set())
            counted = {r["kind"]: r["n"] for r in refused.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
            arrived = house.with_period(documents.page_rows(pages), "day")
            upsert_table(spark, house.path("pages"), arrived, keys=["day", "page"], partition_by=_PERIOD, keys_may_move=False)
            newest = newest_instant(pages, "landed_at")
        missing = missing_days(spark, house, first, last)
        partial = bool(missing) or counted.get("page", 0) > 0
        report |= counts | {
            "status": "PARTIAL" if partial else "SUCCESS",
            "pages_skipped": counted.get("page", 0), "flights_rejected": counted.get("flight", 0), "days_missing": missing,
        }
        if not missing:
            documents.write_checkpoint(spark, state, last, max(filter(None, (newest, since)), default=None))
        return report
    finally:
        _write_report(spark, house, report)


def missing_days(spark: SparkSession, house: Warehouse, first: datetime, last: datetime) -> list[str]:
    """Days of the window that have no page yet, or fewer than announced."""
    stored = read_or_none(spark, house.path("pages"), _PAGES)
    wanted = spark.range(1).select(
        F.explode(F.sequence(F.lit(first.date()), F.lit(last.date()))).alias("day")
    ).select(F.col("day").cast("string").alias("day"))
    if stored is None:
        complete = wanted.limit(0)
    else:
        bounded = stored.filter(F.col(_PERIOD).between(house.period(first.date()), house.period(last.date())))
        complete = documents.day_completeness(bounded).filter("pages_read >= pages_expected").select("day")
    return sorted(_texts(wanted.join(complete, "day", "left_anti")))


_PAGES = T.StructType().add("day", "string").add("page", "string").add("total_pages", "integer").add(_PERIOD, "string")
_REPORT = (
    "status string, started_at timestamp, window_start timestamp, window_end timestamp, flights long, legs long, delays long,"
    " pages_skipped long, flights_rejected long, days_missing array<string>"
)


def _write_report(spark: SparkSession, house: Warehouse, report: dict) -> None:
    names = [f.split()[0] for f in _REPORT.split(", ")]
    row = spark.createDataFrame([tuple(report.get(n) for n in names)], _REPORT)
    row.write.mode("append").parquet(house.path("ingestions"))


def read_raw_table(spark: SparkSession, house: Warehouse, name: str) -> DataFrame:
    """A raw table with the columns it is partitioned and replaced by."""
    schema, extra = {
        "flights": (schemas.FLIGHTS, ()), "legs": (schemas.LEGS, (_DATE,)), "delays": (schemas.DELAYS, ("flight_id", _DATE)),
    }[name]
    fields = [*schema.fields, *(T.StructField(c, T.StringType()) for c in (*extra, _PERIOD))]
    return spark.read.schema(T.StructType(fields)).parquet(house.path(name))


def read_raw(spark: SparkSession, house: Warehouse) -> RawTables:
    """The raw tables with the columns they are partitioned and replaced by."""
    return RawTables(*(read_raw_table(spark, house, name) for name in ("flights", "legs", "delays")))


def _influenced(house: Warehouse, dates: Iterable[str]) -> tuple[set[str], set[str]]:
    """(periods to rebuild, periods to read) of changed dates: a day reaches the shares of the seven after it."""
    step = [timedelta(days=i) for i in range(SHARE_DAYS + 1)]
    rebuilt = {house.period(date.fromisoformat(d) + s) for d in dates for s in step}
    return rebuilt, rebuilt | {house.period(house.first_day(p) - s) for p in rebuilt for s in step}


def run_transform(
    spark: SparkSession, house: Warehouse, dates: Iterable[str] | None = None, as_of: datetime | None = None
) -> list[str]:
    """Rebuild shares, fact and dimensions; with the touched dates, only what they influence.

    Raw tables, fact and dimension parts are partitioned alike, so a refresh reads and writes the influenced periods only.
    Whether another period holds one of the new keys is told by an index of the stored ones; only where it may is the period read. The quality gate judges the new
    rows before anything is published; it raises on an error and returns warnings. With ``as_of`` it also judges the age and
    size of the raw tables.
    """
    dates = None if dates is None else set(dates)
    raw = read_raw(spark, house)
    rebuilt, read = (None, None) if dates is None else _influenced(house, dates)
    if rebuilt is not None:
        if not rebuilt:
            return []
        raw = RawTables(*(pruned(t, _PERIOD, read) for t in (raw.flights, raw.legs, raw.delays)))

    def wanted(df: DataFrame) -> DataFrame:
        dated = house.with_period(df)
        return dated if rebuilt is None else pruned(dated, _PERIOD, rebuilt)

    with Stages(spark, **COMPACT) as stages:
        base = stages.add(legs_with_delays_at_flights(raw.legs, raw.flights, raw.delays), "leg-delays")
        days = stages.add(wanted(entity_days_of(base)), "entity-days")
        ready = legs_ready(wanted(base).select(*DELAYS_LEG_COLUMNS), days, chunks_for(base, days))
        ready = stages.add(house.with_period(ready), "ready")
        fact = house.with_period(mart.fct_flight_legs(ready), "date_key")
        parts = stages.add(mart.dimension_parts(ready, _PERIOD), "parts")

        stored = {name: stored_partitions(spark, house.path(name), _PERIOD) for name in (*_MART, "entity_days")}
        touched = {name: found if rebuilt is None else rebuilt for name, found in stored.items()}
        keys, all_parts = fact.select("leg_id", "flight_id"), parts
        others = stored["fct_flight_legs"] - rebuilt if rebuilt is not None else set()
        if others:
            index = fact_index(spark, house, others)
            elsewhere = stored_elsewhere(index, keys.select(F.col("leg_id").alias("key")), read_fact(spark, house), "leg_id")
            repeated = elsewhere.select(F.col("key").alias("leg_id"), F.col("key").alias("flight_id"))
            keys = keys.unionByName(repeated)
        if rebuilt is not None and stored["dim_parts"] - rebuilt:
            old = spark.read.schema(parts.schema).parquet(house.path("dim_parts"))
            all_parts = parts.unionByName(old.filter(~F.col(_PERIOD).isin(sorted(rebuilt))).select(*parts.columns))
        all_parts = stages.add(all_parts, "all-parts")
        dims = mart.dimensions(all_parts)
        checks = quality.star_schema_checks(keys, dims["dim_date"], dims["dim_airlines"], dims["dim_airports"])
        warnings = quality.run_quality_gate(checks + (source_checks(spark, house, as_of) if as_of else []))

        for name, rows in (("entity_days", days), ("fct_flight_legs", fact), ("dim_parts", parts)):
            replace_partitions(spark, house.path(name), rows, _PERIOD, touched[name])
        # The index of a full build is rebuilt as a whole; no period is left that the fact has not.
        store_keys(spark, house.path("fact_keys"), fact.select(F.col("leg_id").alias("key"), _PERIOD))
        for name, rows in dims.items():
            materialize(rows, name, "table", path=house.path(name))
    return warnings


def fact_index(spark: SparkSession, house: Warehouse, periods: set[str]) -> DataFrame:
    """The index of the fact's keys in the given periods; those that have none yet are read once and added."""
    path = house.path("fact_keys")
    missing = periods - stored_partitions(spark, path, _PERIOD)
    if missing:
        unread = pruned(read_fact(spark, house), _PERIOD, missing)
        store_keys(spark, path, unread.select(F.col("leg_id").alias("key"), _PERIOD))
    return pruned(read_index(spark, path), _PERIOD, periods)


_MART = ("fct_flight_legs", "dim_parts")


def source_checks(spark: SparkSession, house: Warehouse, as_of: datetime) -> list[DataFrame]:
    """Age and row count of the three raw tables, from file footers: every row carries the time of the fetch that brought it."""
    names = ("flights", "legs", "delays")
    ages = source_ages(spark, {name: house.path(name) for name in names}, _FETCHED).withColumnRenamed("newest", "fetched_at")
    of = lambda name: ages.filter(F.col("source") == name)
    checks = [quality.check_freshness(of(name), "fetched_at", as_of, table=name) for name in names]
    return checks + [quality.check_stated_rows(of(name), table=name) for name in names]


def fact_schema(spark: SparkSession):
    """Columns of the fact, from analysing its plan over empty raw tables; runs no job."""
    flights, legs, delays = (
        spark.createDataFrame([], s) for s in (schemas.FLIGHTS, schemas.LEGS, schemas.DELAYS)
    )
    base = legs_with_delays(legs, flights, delays)
    return mart.fct_flight_legs(legs_ready(base.select(*DELAYS_LEG_COLUMNS), entity_days_of(base))).schema


def read_fact(spark: SparkSession, house: Warehouse) -> DataFrame:
    schema = T.StructType([*fact_schema(spark).fields, T.StructField(_PERIOD, T.StringType())])
    return spark.read.schema(schema).parquet(house.path("fct_flight_legs"))


def read_predictions(spark: SparkSession, house: Warehouse) -> DataFrame | None:
    schema = T.StructType([*schemas.PREDICTIONS.fields, T.StructField(_PERIOD, T.StringType())])
    return read_or_none(spark, house.path("predictions"), schema)


def run_scoring(
    spark: SparkSession, house: Warehouse, model: scoring.DelayModel, now: datetime | None = None, rescore: bool = False,
    dates: Iterable[str] | None = None,
) -> int:
    """Score the legs that have no prediction and merge the results; returns how many.

    With the touched dates, only the legs of their periods are compared; without, the whole fact.
    """
    fact, known = read_fact(spark, house), read_predictions(spark, house)
    if dates is not None:
        periods = {d[: _PERIOD_CHARS[house.by]] for d in dates}
        fact = pruned(fact, _PERIOD, periods)
        known = None if known is None else pruned(known, _PERIOD, periods)
    todo = scoring.unscored_legs(fact, known, rescore)
    with Stages(spark, **COMPACT) as stages:
        # Written once: the merge reads it several times and must not score again.
        fresh = stages.add(scoring.score(todo, model, now or datetime.now(timezone.utc), (_PERIOD,)), "scored")
        count = fresh.count()
        if count:
            upsert_predictions(spark, house.path("predictions"), fresh, _PERIOD)
    return count


def upsert_predictions(spark: SparkSession, path: str, predictions: DataFrame, partition_by: str) -> None:
    """Merge predictions by leg, creating the table when it is missing."""
    upsert_table(spark, path, predictions, keys=["leg_id"], partition_by=partition_by, order_by=["timestamp"])


def _span(start: str | None, end: str | None) -> list[str] | None:
    """All dates from start to end; None without a start."""
    if not start:
        return None
    first, last = date.fromisoformat(start), date.fromisoformat(end or start)
    return [(first + timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Flight-delay jobs")
    parser.add_argument("job", choices=["ingest", "transform", "fit", "score"])
    parser.add_argument("--root", required=True)
    parser.add_argument("--source", help="folder of landed pages (ingest)")
    parser.add_argument("--model", help="folder of the fitted model (fit, score)")
    parser.add_argument("--start", help="first date, yyyy-mm-dd")
    parser.add_argument("--end", help="last date, yyyy-mm-dd")
    parser.add_argument("--full", action="store_true", help="ignore the ingest checkpoint")
    args = parser.parse_args(argv)
    spark = configure(SparkSession.builder.getOrCreate())
    house = Warehouse(args.root)
    if args.job == "ingest":
        print(run_ingest(spark, args.source, house, args.start, args.end, not args.full))
    elif args.job == "transform":
        print(run_transform(spark, house, _span(args.start, args.end), datetime.now(timezone.utc)))
    elif args.job == "fit":
        scoring.fit_delay_model(read_fact(spark, house)).save(spark, args.model)
    else:
        model = scoring.DelayModel.load(spark, args.model)
        print(run_scoring(spark, house, model, dates=_span(args.start, args.end)))


if __name__ == "__main__":
    main()
