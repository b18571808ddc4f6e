"""Delay analytics, prediction quality, log and run statistics."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import instant, percent_half_up, ratio_half_up

# Dimension -> (fact column, smallest volume a group must have to be reported).
DIMENSIONS = {
    "airport": ("departure_airport_name", 50),
    "city": ("departure_city_name", 50),
    "date": ("date_key", 10),
    "airline": ("airline_name", 10),
}
TRAILING_DAYS = 7

# Class labels by (predicted, actual), label of everything else, label of "no run yet".
CONFUSION_LABELS = {
    (1, True): "Vrais Positifs (VP)",
    (1, False): "Faux Positifs (FP)",
    (0, False): "Vrais Négatifs (VN)",
    (0, True): "Faux Négatifs (FN)",
}
UNKNOWN_LABEL = "Inconnu"
NO_RUN_LABEL = "Aucun Run"


def dimension_column(name: str) -> str:
    """Fact column of a dimension; anything else is rejected."""
    if name not in DIMENSIONS:
        raise ValueError(f"unknown dimension {name!r}; choose one of {sorted(DIMENSIONS)}")
    return DIMENSIONS[name][0]


def recent(df: DataFrame, as_of: date, days: int = TRAILING_DAYS, column: str = "date_key") -> DataFrame:
    """Rows dated at or after ``as_of`` minus ``days``, later ones included.

    Dates are ISO text, which orders like the date, so the bound reaches the scan without a cast.
    """
    return df.filter(F.col(column) >= (as_of - timedelta(days=days)).isoformat())


def time_filter(df: DataFrame, column: str, lo: datetime, hi: datetime) -> DataFrame:
    """Rows whose timestamp lies in the closed range."""
    return df.filter(F.col(column).between(instant(lo), instant(hi)))


def delay_metrics(
    fact: DataFrame, dimension: str, as_of: date, days: int = TRAILING_DAYS, min_volume: int | None = None
) -> DataFrame:
    """Delayed legs, legs and delay rate per label of a dimension, small groups left out."""
    column = dimension_column(dimension)
    floor = DIMENSIONS[dimension][1] if min_volume is None else min_volume
    per_leg = (
        recent(fact, as_of, days)
        .filter(F.col(column).isNotNull() & F.col("is_delayed").isNotNull())
        .groupBy("leg_id")
        .agg(F.max(column).alias("label"), F.max(F.col("is_delayed").cast("int")).alias("delayed"))
    )
    return (
        per_leg.groupBy("label")
        .agg(F.sum("delayed").alias("total_retards"), F.count(F.lit(1)).alias("total_vols"))
        .filter(F.col("total_vols") >= floor)
        .withColumn("delayed_share", percent_half_up(F.col("total_retards"), F.col("total_vols"), 2))
    )


def delay_kpis(metrics: DataFrame) -> DataFrame:
    """Totals and overall rate over the reported groups; zeros when there are none."""
    sums = metrics.agg(
        F.coalesce(F.sum("total_vols"), F.lit(0)).alias("total_vols"),
        F.coalesce(F.sum("total_retards"), F.lit(0)).alias("total_retards"),
    )
    rate = F.coalesce(percent_half_up(F.col("total_retards"), F.col("total_vols"), 2), F.lit(0.0))
    return sums.select(rate.alias("global_rate"), "total_vols", "total_retards")


def ranked_metrics(metrics: DataFrame) -> DataFrame:
    """Highest delay rate first, label as tie-break."""
    return metrics.orderBy(F.desc("delayed_share"), "label")


def top_delayed(metrics: DataFrame, n: int | None = 10) -> DataFrame:
    """The ``n`` worst groups, or all of them."""
    ordered = ranked_metrics(metrics)
    return ordered if n is None else ordered.limit(n)


def worst_label(metrics: DataFrame) -> DataFrame:
    """The worst group beside the overall rate, from one aggregation of the groups."""
    worst = F.min(F.struct((-F.col("delayed_share")).alias("rank"), "label", "delayed_share"))
    overall = F.coalesce(percent_half_up(F.sum("total_retards"), F.sum("total_vols"), 2), F.lit(0.0))
    return (
        metrics.agg(worst.alias("worst"), overall.alias("global_rate"))
        .filter(F.col("worst").isNotNull())
        .select("worst.label", "worst.delayed_share", "global_rate")
    )


def _scored(predictions: DataFrame, fact: DataFrame) -> DataFrame:
    return predictions.select("leg_id", F.col("flight_id").alias("scored_flight_id"), "delay_predicted").join(
        fact, "leg_id", "inner"
    )


def confusion_matrix(predictions: DataFrame, fact: DataFrame) -> DataFrame:
    """Scored legs per class of predicted against actual delay."""
    label = F.lit(UNKNOWN_LABEL)
    for (predicted, actual), name in CONFUSION_LABELS.items():
        matches = (F.col("delay_predicted") == predicted) & (F.col("is_delayed") == actual)
        label = F.when(matches, name).otherwise(label)
    return _scored(predictions, fact).groupBy(label.alias("prediction_type")).agg(F.count(F.lit(1)).alias("total"))


def scored_days(predictions: DataFrame, fact: DataFrame) -> DataFrame:
    """Dates that have at least one scored leg."""
    return _scored(predictions, fact).select(F.col("date_key").alias("day")).distinct()


def future_days(days: DataFrame, now: datetime) -> DataFrame:
    """Scored days from today on, by the local date in Paris."""
    today = F.to_date(F.from_utc_timestamp(instant(now), "Europe/Paris"))
    return days.filter(F.to_date("day") >= today)


def day_predictions(predictions: DataFrame, fact: DataFrame, day: str) -> DataFrame:
    """Flights of one day with their strongest prediction; an unscored day is an error."""
    joined = _scored(predictions, fact.filter(F.col("date_key") == day))
    if joined.isEmpty():
        raise ValueError(f"no predictions for {day}")
    keys = ("flight_number", "airline_name", "departure_airport_name", "arrival_airport_name", "date_key")
    return joined.groupBy(F.col("scored_flight_id").alias("flight_id"), *keys).agg(
        F.max("delay_predicted").alias("delay_predicted")
    )


def flight_label(df: DataFrame) -> DataFrame:
    """Add the display text ``number - airline - departure --> arrival``; a missing part shows as None."""

    def part(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("None"))

    text = F.concat(
        part("flight_number"),
        F.lit(" - "),
        part("airline_name"),
        F.lit(" - "),
        part("departure_airport_name"),
        F.lit(" --> "),
        part("arrival_airport_name"),
    )
    return df.withColumn("combined_field", text)


def covered_traffic(fact: DataFrame, lo: datetime, hi: datetime, approximate: bool = False) -> DataFrame:
    """Distinct legs scheduled to depart in the range."""
    count = F.approx_count_distinct if approximate else F.countDistinct
    return time_filter(fact, "scheduled_departure", lo, hi).agg(count("leg_id").alias("legs"))


def predicted_delay_rate(predictions: DataFrame, fact: DataFrame, lo: datetime, hi: datetime) -> DataFrame:
    """Percentage of scored legs in the range that are predicted late; null when there are none."""
    joined = _scored(predictions, time_filter(fact, "scheduled_departure", lo, hi))
    late = F.sum(F.when(F.col("delay_predicted") == 1, 1).otherwise(0))
    return joined.agg(percent_half_up(late, F.count(F.lit(1)), 1).alias("predicted_rate"))


def log_metrics(events: DataFrame) -> DataFrame:
    """Log size, error percentage and days covered; 0, 0.0 and 1 for an empty log."""
    span = F.floor((F.unix_micros(F.max("event_at")) - F.unix_micros(F.min("event_at"))) / 86_400_000_000)
    total = F.count(F.lit(1))
    return events.agg(
        total.alias("total_events"),
        F.coalesce(percent_half_up(F.count_if(F.col("level") == "ERROR"), total, 1), F.lit(0.0)).alias("error_rate"),
        F.coalesce(span + 1, F.lit(1)).cast("int").alias("days_covered"),
    )


def row_count(spark: SparkSession, table: DataFrame | None) -> DataFrame:
    """Rows of a table, 0 when it does not exist."""
    if table is None:
        return spark.range(1).select(F.lit(0).cast("long").alias("rows"))
    return table.agg(F.count(F.lit(1)).alias("rows"))


_LOG_COLUMNS = ("id", "event_at", "level", "layer", "dag_id", "task_id", "event_type", "message")


def recent_logs(events: DataFrame, n: int = 50) -> DataFrame:
    """The newest log events."""
    return events.select(*_LOG_COLUMNS).orderBy(F.desc("event_at"), F.desc("id")).limit(n)


def error_logs(events: DataFrame) -> DataFrame:
    """Error rows as shown to operators."""
    return events.filter(F.col("level") == "ERROR").select(
        "id", "event_at", "layer", "dag_id", "task_id", "message"
    )


def successful_ingestions(events: DataFrame, lo: datetime, hi: datetime) -> DataFrame:
    """Successful ingestion events in the range."""
    hits = time_filter(events.filter(F.col("event_type") == "ingestion_success"), "event_at", lo, hi)
    return hits.agg(F.count(F.lit(1)).alias("runs"))


def _succeeded(runs: DataFrame) -> DataFrame:
    return runs.filter(F.col("status") == "SUCCESS")


def ingestion_freshness(runs: DataFrame, fallback: str = NO_RUN_LABEL) -> DataFrame:
    """Newest business date that finished, as text."""
    newest = F.date_format(F.max("date_metier"), "yyyy-MM-dd")
    return _succeeded(runs).agg(F.coalesce(newest, F.lit(fallback)).alias("value"))


def mean_run_minutes(runs: DataFrame, lo: datetime, hi: datetime) -> DataFrame:
    """Mean duration of successful runs in minutes, one decimal; 0.0 without any."""
    mean = ratio_half_up(F.sum("duration_sec"), F.count("duration_sec") * 60, 1)
    return time_filter(_succeeded(runs), "started_at", lo, hi).agg(F.coalesce(mean, F.lit(0.0)).alias("value"))


def throughput(runs: DataFrame, lo: datetime, hi: datetime) -> DataFrame:
    """Rows transformed per second over the successful runs that took time."""
    timed = time_filter(_succeeded(runs), "started_at", lo, hi).filter(F.col("duration_sec") > 0)
    rate = ratio_half_up(F.sum("transformation_rows"), F.sum("duration_sec"), 1)
    return timed.agg(F.coalesce(rate, F.lit(0.0)).alias("value"))


_AUDIT_COLUMNS = (
    "run_id", "dag_id", "date_metier", "started_at", "status", "vols_ingested", "transformation_rows", "finished_at", "duration_sec",
)


def run_audit(runs: DataFrame, lo: datetime, hi: datetime, n: int = 50) -> DataFrame:
    """The newest runs of the range."""
    return (
        time_filter(runs, "started_at", lo, hi)
        .select(*_AUDIT_COLUMNS)
        .orderBy(F.desc("started_at"), F.desc("run_id"))
        .limit(n)
    )
