"""Raw-layer projections, materialisation modes and the event log sink."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas
from .storage import path_exists, pruned, stored_partitions, upsert_table


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*(F.col(f.name).cast(f.dataType) for f in schema.fields))


def stage_flights(df: DataFrame) -> DataFrame:
    """The fixed flight columns; ``route`` is left out."""
    return _conform(df, schemas.FLIGHTS)


def stage_legs(df: DataFrame) -> DataFrame:
    """The fixed leg columns."""
    return _conform(df, schemas.LEGS)


def stage_delays(df: DataFrame) -> DataFrame:
    """The fixed delay columns; ``delay_reason`` is left out."""
    return _conform(df, schemas.DELAYS)


def materialize(
    df: DataFrame,
    name: str,
    mode: str,
    keys: list[str] | None = None,
    path: str | None = None,
    partition_by: str | None = None,
    order_by: list[str] | None = None,
) -> DataFrame:
    """Publish ``df`` as a view, a full table, or an incremental table that replaces rows by key."""
    spark = df.sparkSession
    if mode == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if path is None:
        raise ValueError("table and incremental modes need a path")
    if mode == "table":
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    elif mode == "incremental":
        if not keys or not partition_by:
            raise ValueError("incremental mode needs keys and a partition column")
        upsert_table(spark, path, df, keys=keys, partition_by=partition_by, order_by=order_by)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return spark.read.schema(df.schema).parquet(path)


def json_safe(column: Column, kind: T.DataType) -> Column:
    """A value as the event log stores it: ISO text for dates and times, seconds for intervals,
    doubles for decimals, everything else unchanged."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
        micros = F.date_format(column, "SSSSSS")
        text = F.when(micros == "000000", whole).otherwise(F.concat_ws(".", whole, micros))
        return F.concat(text, F.lit("+00:00")) if isinstance(kind, T.TimestampType) else text
    if isinstance(kind, T.DateType):
        return F.date_format(column, "yyyy-MM-dd")
    if isinstance(kind, T.DayTimeIntervalType):
        # Through text only where the interval type offers no numeric cast below a second.
        return (
            F.extract(F.lit("DAY"), column) * 86400
            + F.extract(F.lit("HOUR"), column) * 3600
            + F.extract(F.lit("MINUTE"), column) * 60
            + F.extract(F.lit("SECOND"), column)
        ).cast("double")
    if isinstance(kind, T.DecimalType):
        return column.cast("double")
    return column


# Payload keys with a log column of their own; all others go to ``extra``.
CORE_KEYS = ("app", "level", "layer", "dag_id", "task_id", "run_id", "event_type", "message", "timestamp")


def event_extra(df: DataFrame, columns: list[str]) -> Column:
    """JSON text of the leftover payload columns, null members left out; null when nothing is left."""
    left = [c for c in columns if c not in CORE_KEYS]
    if not left:
        return F.lit(None).cast("string")
    members = [json_safe(F.col(c), df.schema[c].dataType).alias(c) for c in left]
    return F.nullif(F.to_json(F.struct(*members)), F.lit("{}"))


def append_events(events: DataFrame, path: str, batch: str | None = None) -> str:
    """Append rows to the event log, partitioned by day, so that time ranges prune, and by batch; returns the batch id.

    Appending a batch again under its id replaces it, so a run that was broken off is repeated without doubling events.
    """
    batch = batch or uuid.uuid4().hex
    (
        events.withColumn("event_day", F.to_date("event_at"))
        .withColumn("batch", F.lit(batch))
        .hint("rebalance", "event_day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_day", "batch")
        .parquet(path)
    )
    return batch


def newest_days(spark: SparkSession, path: str, schema: T.StructType, n: int) -> DataFrame:
    """The newest days of an event log that have ``n`` rows together, all of it if there are fewer.

    Walks the day partitions from the newest, one, then two, then four at a time, and stops once they hold enough; their rows are counted
    from file footers. The newest ``n`` events are among these days, however long the log.
    """
    log = spark.read.schema(schema).parquet(path)
    days = sorted(d for d in stored_partitions(spark, path, "event_day") if not d.startswith("__"))[::-1]
    taken, step, rows = 0, 1, 0
    while rows < n and taken < len(days):
        rows += pruned(log, "event_day", set(days[taken : taken + step])).count()
        taken, step = taken + step, step * 2
    # Events without a time come after all others.
    return pruned(log, "event_day", set(days[:taken])) if rows >= n else log


_RESULT = T.StructType().add("adapter_response", T.StructType().add("rows_affected", T.DoubleType()))
_RESULTS = T.StructType().add("results", T.ArrayType(_RESULT))


def rows_processed(documents: DataFrame, column: str = "body") -> DataFrame:
    """Rows affected over all model results of a run document; missing or non-numeric counts as 0."""
    parsed = F.from_json(F.col(column), _RESULTS)["results"]
    total = F.aggregate(
        F.coalesce(parsed, F.array().cast(_RESULTS["results"].dataType)),
        F.lit(0).cast("long"),
        lambda acc, r: acc + F.coalesce(r["adapter_response"]["rows_affected"].cast("long"), F.lit(0)),
    )
    return documents.withColumn("rows_processed", total)


def read_or_none(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The table at ``path``, or None while it does not exist yet."""
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else None
