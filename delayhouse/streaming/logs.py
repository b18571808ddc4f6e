"""Run status and event rates from the event stream."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import instant, newest_instant
from ..operators.observability import fold_runs, run_episodes, run_events
from ..session import COMPACT, Stages
from ..sources.keys import candidates, read_index, store_keys
from ..sources.storage import path_exists, pruned, upsert_table


def stream_runs(events: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Keep the run table up to date from enriched events; the fold is the batch one.

    No run is held as streaming state. Every batch is added to the stored log, which is partitioned by day; an index of run ids names the days that
    hold earlier events of the batch's runs, and these runs are folded anew from those days alone. A batch that is repeated replaces
    its own part of log and index, and runs are merged by id, so it changes nothing. Below ``target``: ``log``, ``keys`` and ``runs``.
    """
    places = {name: f"{target.rstrip('/')}/{name}" for name in ("log", "keys", "runs")}

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        with Stages(spark, **COMPACT) as stages:
            day = F.coalesce(F.date_format("event_at", "yyyy-MM-dd"), F.lit("none"))
            fresh = stages.add(run_events(batch).withColumns({"day": day, "batch": F.lit(number).cast("long")}), "said")
            names = stages.add(fresh.select(F.col("run_id").alias("key"), F.col("day").alias("period")).distinct(), "names")
            days = {r[0] for r in names.select("period").distinct().collect()}  # as many as there are days
            if not days:
                return
            known = read_index(spark, places["keys"])
            if known is not None:
                days |= {r[0] for r in candidates(known, names).select("period").distinct().collect()}
            # Before the log, so that a run is in the index whenever it is stored.
            store_keys(spark, places["keys"], names, part=str(number))
            (
                fresh.hint("rebalance", "day")
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(places["log"])
            )
            stored = pruned(spark.read.schema(fresh.schema).parquet(places["log"]), "day", days)
            mine = stages.add(stored.join(names.select(F.col("key").alias("run_id")).distinct(), "run_id", "left_semi"), "mine")
            # A late first event moves a run to another date; the one it had follows from the log without this batch.
            before = fold_runs(mine.filter(F.col("batch") != number).drop("day", "batch"))
            dates = {r[0] for r in before.select(F.col("date_metier").cast("string")).distinct().collect()} - {None}
            folded = fold_runs(mine.drop("day", "batch"))
            upsert_table(
                spark, places["runs"], folded, keys=["run_id"], partition_by="date_metier", unique=True, keys_may_move=False, also=dates
            )

    return (
        events.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def event_rates(events: DataFrame, size: str, slide: str | None = None) -> DataFrame:
    """Events, errors and error percentage per time window; the same on a batch or a stream."""
    span: Column = F.window("event_at", size, slide) if slide else F.window("event_at", size)
    counted = events.groupBy(span.alias("span")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("level") == "ERROR").alias("errors")
    )
    return counted.select(
        F.col("span.start").alias("window_start"),
        F.col("span.end").alias("window_end"),
        "events",
        "errors",
        (F.col("errors") * 100.0 / F.col("events")).alias("error_rate"),
    )


def stream_event_rates(
    events: DataFrame, size: str, slide: str | None, lateness: str, target: str, checkpoint: str
) -> StreamingQuery:
    """Append every window once it can no longer change; windows younger than the lateness are kept back."""
    return (
        event_rates(events.withWatermark("event_at", lateness), size, slide)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


_PARTS = "window_start timestamp, window_end timestamp, events long, errors long, late boolean, batch long"
_PROGRESS = "newest timestamp, batch long"


def stream_corrected_rates(
    events: DataFrame, size: str, slide: str | None, lateness: str, target: str, checkpoint: str
) -> StreamingQuery:
    """Rates that late events correct: what a watermark would drop is kept, marked, and counted into its window.

    Each batch appends its own counts per window, which add up to the window's; a window is closed once the newest event of
    earlier batches is ``lateness`` past its end, and counts that reach a closed one are marked late. So nothing is held as
    state, and a batch that is repeated replaces its part. Below ``target``: ``parts`` and ``progress``.
    """
    parts, progress = f"{target.rstrip('/')}/parts", f"{target.rstrip('/')}/progress"

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        with Stages(spark, **COMPACT) as stages:
            rows = stages.add(batch.select("event_at", "level").filter("event_at is not null"), "rated")
            earlier = _newest(spark, progress, number)
            closed = F.lit(False) if earlier is None else F.col("window_end") <= instant(earlier) - F.expr(f"INTERVAL {lateness}")
            counted = event_rates(rows, size, slide).drop("error_rate").withColumns({"late": closed, "batch": F.lit(number).cast("long")})
            newest = rows.agg(F.max("event_at").alias("newest")).withColumn("batch", F.lit(number).cast("long"))
            for part, path in ((counted, parts), (newest, progress)):
                # One file by a shuffle of the few counts; the events are counted by many tasks before.
                part.repartition(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    return (
        events.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _newest(spark: SparkSession, progress: str, before: int) -> datetime | None:
    """Newest event of the batches before one; one small row per batch."""
    if not path_exists(spark, progress):
        return None
    known = spark.read.schema(_PROGRESS).parquet(progress).filter(F.col("batch") < before)
    return newest_instant(known, "newest")


def corrected_rates(spark: SparkSession, target: str) -> DataFrame:
    """Every window with all its events, and how many of them came after it was closed."""
    parts = spark.read.schema(_PARTS).parquet(f"{target.rstrip('/')}/parts")
    late = F.sum(F.when(F.col("late"), F.col("events")).otherwise(0)).alias("late_events")
    summed = parts.groupBy("window_start", "window_end").agg(F.sum("events").alias("events"), F.sum("errors").alias("errors"), late)
    return summed.withColumn("error_rate", F.col("errors") * 100.0 / F.col("events"))


def stream_run_episodes(events: DataFrame, silence: str, lateness: str, target: str, checkpoint: str) -> StreamingQuery:
    """Append every episode of a run once it has been silent for so long; state holds only runs that are still heard of."""
    return (
        run_episodes(run_events(events).withWatermark("event_at", lateness), silence)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
