"""Flags, labels and event classification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: duration text of the sentinel "no delay" event.
NO_DELAY = "00"
# Fixed value: minutes from which a leg counts as delayed.
DELAY_THRESHOLD_MINUTES = 15


def delay_flag(duration: Column) -> Column:
    """1 when the event declares a delay; the sentinel and null give 0."""
    return F.when(duration != NO_DELAY, 1).otherwise(0)


def is_delayed(
    departure: Column, arrival: Column, declared: Column, threshold: int = DELAY_THRESHOLD_MINUTES
) -> Column:
    """True when any of the three delays, null counting as 0, reaches the threshold."""
    worst = F.greatest(*(F.coalesce(c, F.lit(0)) for c in (departure, arrival, declared)))
    return worst >= threshold


def _has(text: Column, word: str) -> Column:
    return F.coalesce(F.contains(text, F.lit(word)), F.lit(False))


def event_status(level: Column, event_type: Column) -> Column:
    """FAILED for errors and failure types, SUCCESS for success and reload types, else RUNNING."""
    kind = F.lower(event_type)
    failed = F.coalesce(level == "ERROR", F.lit(False)) | _has(kind, "fail")
    done = _has(kind, "success") | _has(kind, "reload")
    return F.when(failed, "FAILED").when(done, "SUCCESS").otherwise("RUNNING")


def _first_nonzero(*values: Column) -> Column:
    return F.coalesce(*(F.nullif(v.cast("long"), F.lit(0).cast("long")) for v in values), F.lit(0).cast("long"))


def event_volumes(
    dag: Column,
    task: Column,
    event_type: Column,
    vols_ingested: Column,
    rows_inserted: Column,
    transformation_rows: Column,
    records_processed: Column,
    row_count: Column,
) -> tuple[Column, Column]:
    """(flights ingested, rows transformed) claimed by one event.

    Zero counts as missing. The name of the DAG or task decides which volume an event may claim; when
    neither specific measure gives one, the generic record counts are credited to the matching side.
    """
    ingest = _has(dag, "ingest") | _has(task, "ingest")
    transform = _has(dag, "transform") | _has(task, "transform")
    dbt_task = _has(task, "dbt")

    direct_in = F.when(ingest, _first_nonzero(vols_ingested, rows_inserted)).otherwise(0)
    direct_out = F.when(
        transform | dbt_task,
        _first_nonzero(rows_inserted, transformation_rows, records_processed, row_count),
    ).otherwise(0)

    generic = _first_nonzero(records_processed, row_count)
    generic_out = dbt_task | _has(task, "transform") | _has(event_type, "dbt")
    neither = (direct_in == 0) & (direct_out == 0)
    ingested = F.when(neither & ~generic_out & ingest, generic).otherwise(direct_in)
    transformed = F.when(neither & generic_out, generic).otherwise(direct_out)
    return ingested, transformed
