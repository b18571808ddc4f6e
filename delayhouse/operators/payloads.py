"""Typed access to the open part of event payloads, as a VARIANT instead of JSON text.

The text is parsed once, when an event is stored; members are then read by path and type without parsing again, members of any
name stay, and a payload that is no JSON is told instead of being read as nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import event_volumes

_NUMBERS = ("vols_ingested", "rows_inserted", "transformation_rows", "records_processed", "row_count")


def with_payload(events: DataFrame, column: str = "extra") -> DataFrame:
    """Add ``payload``, null for a null or broken text, and ``broken``."""
    parsed = events.withColumn("payload", F.try_parse_json(column))
    return parsed.withColumn("broken", F.col(column).isNotNull() & F.col("payload").isNull())


def member(name: str, kind: str, payload: str = "payload") -> Column:
    """A member as a type; null if it is not there or no value of that type."""
    return F.try_variant_get(F.col(payload), f"$.{name}", kind)


def payload_volumes(events: DataFrame) -> list[Column]:
    """Volumes that an event claims, from its payload: the same as from columns of their own."""
    return event_volumes(F.col("dag_id"), F.col("task_id"), F.col("event_type"), *(member(n, "bigint") for n in _NUMBERS))


def broken_payloads(events: DataFrame) -> DataFrame:
    """Number of events, of those with a payload, and of broken ones."""
    return events.agg(
        F.count(F.lit(1)).alias("events"), F.count("payload").alias("payloads"), F.count_if("broken").alias("broken")
    )
