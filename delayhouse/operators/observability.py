"""Pipeline events and the run table folded from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import business_date, event_status, event_volumes
from ..sources.tables import event_extra

TERMINAL = ("SUCCESS", "FAILED")
# Names used when an event does not say where it came from.
DEFAULT_APP = "airflow"
UNKNOWN_DAG, UNKNOWN_TASK = "unknown_dag", "unknown_task"

_CONTEXT = (
    "conf_start_date", "conf_business_date", "param_start_date", "logical_date", "interval_start",
    "payload_run_id", "context_run_id",
)


def enrich_events(raw: DataFrame) -> DataFrame:
    """Log rows from raw payloads: level upper case, layer lower case, business date, run id, extras."""
    nothing = F.lit(None).cast("string")

    def maybe(name: str) -> Column:
        return F.col(name) if name in raw.columns else nothing

    core = ("id", "event_at", "app", "level", "layer", "dag_id", "task_id", "run_id", "event_type", "message")
    extras = [c for c in raw.columns if c not in core and c not in _CONTEXT]
    # An explicit business date is kept in the extras under both names.
    named = raw.withColumn("business_date", F.col("explicit_business_date")) if "explicit_business_date" in extras else raw
    kept = [*extras, "business_date"] if named is not raw and "business_date" not in extras else extras
    date = business_date(
        maybe("explicit_business_date"),
        maybe("conf_start_date"),
        maybe("conf_business_date"),
        maybe("param_start_date"),
        maybe("logical_date").cast("timestamp"),
        maybe("interval_start").cast("timestamp"),
        F.col("event_at"),
    )
    run = F.coalesce(*(F.nullif(maybe(c), F.lit("")) for c in ("run_id", "payload_run_id", "context_run_id")))
    return named.select(
        "id",
        "event_at",
        F.coalesce(maybe("app"), F.lit(DEFAULT_APP)).alias("app"),
        F.upper("level").alias("level"),
        F.lower("layer").alias("layer"),
        "dag_id",
        "task_id",
        run.alias("run_id"),
        "event_type",
        "message",
        event_extra(named, kept).alias("extra"),
        date.alias("business_date"),
        *extras,
    )


def run_events(events: DataFrame) -> DataFrame:
    """What each event says about its run: status, volumes, error and context."""

    def number(name: str) -> Column:
        return F.col(name) if name in events.columns else F.lit(None).cast("long")

    status = event_status(F.col("level"), F.col("event_type"))
    ingested, transformed = event_volumes(
        F.coalesce("dag_id", F.lit(UNKNOWN_DAG)),
        F.coalesce("task_id", F.lit(UNKNOWN_TASK)),
        F.col("event_type"),
        number("vols_ingested"),
        number("rows_inserted"),
        number("transformation_rows"),
        number("records_processed"),
        number("row_count"),
    )
    exception = F.col("exception") if "exception" in events.columns else F.lit(None).cast("string")
    error = F.coalesce(F.nullif(exception, F.lit("")), F.col("message"))
    return events.filter(F.col("run_id").isNotNull()).select(
        "id",
        "event_at",
        "run_id",
        F.coalesce("dag_id", F.lit(UNKNOWN_DAG)).alias("dag_id"),
        F.col("business_date").alias("date_metier"),
        status.alias("status"),
        ingested.alias("vols_ingested"),
        transformed.alias("transformation_rows"),
        F.when(status == "FAILED", error).alias("error_message"),
        F.col("extra").alias("execution_context"),
    )


def fold_runs(run_rows: DataFrame) -> DataFrame:
    """One row per run from :func:`run_events` rows.

    First event gives the DAG, date and start, the last one the status. The end is the last terminal
    event unless that is also the first. Volumes, error and context keep their last known value. Every
    aggregate is an extremum over (time, id), so rows combine before the shuffle, a run with very many
    events is no hot group, and the same fold works on a stream.
    """
    order = F.struct("event_at", "id")

    def last(value: Column, when: Column) -> Column:
        return F.max(F.when(when, F.struct(order.alias("o"), value.alias("v"))))["v"]

    always = F.lit(True)
    terminal = F.col("status").isin(*TERMINAL)
    first = F.min(F.struct(order.alias("o"), "dag_id", "date_metier"))
    folded = run_rows.groupBy("run_id").agg(
        first.alias("first"),
        F.max(F.when(terminal, order)).alias("end"),
        last(F.col("status"), always).alias("status"),
        F.coalesce(last(F.col("vols_ingested"), F.col("vols_ingested") > 0), F.lit(0).cast("long")).alias(
            "vols_ingested"
        ),
        F.coalesce(last(F.col("transformation_rows"), F.col("transformation_rows") > 0), F.lit(0).cast("long")).alias(
            "transformation_rows"
        ),
        last(F.col("error_message"), F.col("error_message").isNotNull()).alias("error_message"),
        last(F.col("execution_context"), F.col("execution_context").isNotNull()).alias("execution_context"),
    )
    finished = F.when(F.col("end") != F.col("first.o"), F.col("end.event_at"))
    seconds = (F.unix_micros(finished) - F.unix_micros("first.o.event_at")) / 1e6
    return folded.select(
        "run_id",
        F.col("first.dag_id").alias("dag_id"),
        F.col("first.date_metier").alias("date_metier"),
        F.col("first.o.event_at").alias("started_at"),
        "status",
        "vols_ingested",
        "transformation_rows",
        finished.alias("finished_at"),
        F.round(seconds).cast("long").alias("duration_sec"),
        "error_message",
        "execution_context",
    )


def run_episodes(run_rows: DataFrame, silence: str) -> DataFrame:
    """Stretches of a run between silences of the given length, from :func:`run_events` rows; the same on a batch or a stream.

    ``abandoned`` tells an episode whose last event is no end: the run started, or went on, and was never heard of again. A
    run that speaks up later has another episode.
    """
    last = F.max(F.struct("event_at", "id", "status"))
    folded = run_rows.groupBy("run_id", F.session_window("event_at", silence).alias("span")).agg(
        F.min("event_at").alias("started_at"), last.alias("last"), F.count(F.lit(1)).alias("events")
    )
    return folded.select(
        "run_id", "started_at", F.col("last.event_at").alias("last_at"), F.col("last.status").alias("status"), "events",
        (~F.col("last.status").isin(*TERMINAL)).alias("abandoned"),
    )


def task_outcome_events(outcomes: DataFrame, layer: str, success_type: str, failure_type: str = "task_failure") -> DataFrame:
    """Log payloads of finished tasks.

    Input: ``dag_id, task_id, run_id, event_at, logical_date, exception, metrics`` (a map),
    ``returned`` (a map, when the task returned one) and ``row_count`` (when it returned a number).
    Returned members override pushed metrics; a plain count is kept unless one was pushed.
    """
    failed = F.col("exception").isNotNull()
    kind = "map<string,string>"
    empty = F.create_map().cast(kind)
    pushed = F.coalesce(F.col("metrics").cast(kind), empty)
    returned = F.col("returned").cast(kind)
    counted = F.map_from_arrays(F.array(F.lit("row_count")), F.array(F.col("row_count").cast("string")))

    def without(base: Column, other: Column) -> Column:
        return F.map_filter(base, lambda k, _: ~F.map_contains_key(other, k))

    merged = (
        F.when(returned.isNotNull(), F.map_concat(without(pushed, returned), returned))
        .when(F.col("row_count").isNotNull() & ~F.map_contains_key(pushed, "row_count"), F.map_concat(pushed, counted))
        .otherwise(pushed)
    )
    error = F.map_from_arrays(F.array(F.lit("exception")), F.array("exception"))
    return outcomes.select(
        "event_at",
        F.lit(DEFAULT_APP).alias("app"),
        F.when(failed, "ERROR").otherwise("INFO").alias("level"),
        F.lit(layer.lower()).alias("layer"),
        "dag_id",
        "task_id",
        "run_id",
        F.when(failed, failure_type).otherwise(success_type).alias("event_type"),
        F.concat(F.when(failed, "task failed for ").otherwise("task success for "), "task_id").alias("message"),
        F.to_date("logical_date").alias("business_date"),
        F.when(failed, error).otherwise(merged).alias("extra"),
    )
