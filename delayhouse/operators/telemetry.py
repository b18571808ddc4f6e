"""Metric samples: gauges, counter rates and sustained alerts.

Input: ``job, instance, metric, labels, ts, value``. Per-series ordering work is split by time chunk, so
a series that holds a large part of all samples is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Alert rules as (rule, severity, threshold, comparison, seconds it must hold).
ALERT_RULES = (
    ("ServiceDown", "critical", 0.0, "==", 10),
    ("PostgresRAMUsageWarning", "warning", 67108864.0, ">=", 120),
    ("PostgresRAMUsageCritical", "critical", 134217728.0, ">=", 30),
    ("FastAPIRAMUsageWarning", "warning", 268435456.0, ">=", 120),
    ("FastAPIRAMUsageCritical", "critical", 402653184.0, ">=", 30),
    ("ServerCPUUsageCritical", "critical", 90.0, ">=", 300),
    ("ServerDiskSpaceLow", "warning", 10.0, "<=", 600),
)
RULE_SCHEMA = "rule string, severity string, threshold double, comparison string, hold_seconds long"
CHUNK_SECONDS = 3600
_SERIES = ("job", "instance", "metric", "label_key")


def with_series(samples: DataFrame) -> DataFrame:
    """Add a comparable form of the label map, which together with the names identifies a series."""
    return samples.withColumn("label_key", F.array_sort(F.map_entries("labels")))


def _seconds(ts: str) -> Column:
    return F.unix_micros(ts) / 1e6


def gauge_latest(samples: DataFrame, metric: str) -> DataFrame:
    """Newest value of every series of a gauge."""
    newest = F.max(F.struct("ts", "value"))
    return (
        with_series(samples.filter(F.col("metric") == metric))
        .groupBy(*_SERIES)
        .agg(newest.alias("newest"))
        .select("job", "instance", "metric", "label_key", F.col("newest.ts").alias("ts"), F.col("newest.value").alias("value"))
    )


def gauge_max(samples: DataFrame, metric: str) -> DataFrame:
    """Largest newest value per job."""
    return gauge_latest(samples, metric).groupBy("job").agg(F.max("value").alias("value"))


def gauge_diff(samples: DataFrame, minuend: str, subtrahend: str) -> DataFrame:
    """Newest value of one gauge minus that of another, per job and instance."""
    newest = (
        with_series(samples.filter(F.col("metric").isin(minuend, subtrahend)))
        .groupBy(*_SERIES)
        .agg(F.max(F.struct("ts", "value"))["value"].alias("value"))
    )

    def of(metric: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col("value")))

    return (
        newest.groupBy("job", "instance", "label_key")
        .agg((of(minuend) - of(subtrahend)).alias("value"))
        .filter(F.col("value").isNotNull())
    )


def gauge_ratio(samples: DataFrame, numerator: str, denominator: str) -> DataFrame:
    """Sum of the newest values of one gauge over that of another, in percent, with both sums."""
    newest = (
        with_series(samples.filter(F.col("metric").isin(numerator, denominator)))
        .groupBy(*_SERIES)
        .agg(F.max(F.struct("ts", "value"))["value"].alias("value"))
    )

    def total(metric: str) -> Column:
        return F.sum(F.when(F.col("metric") == metric, F.col("value")))

    return newest.agg(total(numerator).alias("numerator"), total(denominator).alias("denominator")).withColumn(
        "percent", F.col("numerator") / F.nullif("denominator", F.lit(0.0)) * 100
    )


def down_targets(samples: DataFrame) -> DataFrame:
    """Targets whose newest ``up`` sample is 0."""
    return gauge_latest(samples, "up").filter(F.col("value") == 0).select("job", "instance", "label_key", "ts")


def with_previous(
    df: DataFrame, series: list[str], ts: str, carried: list[str], chunk_seconds: int = CHUNK_SECONDS
) -> DataFrame:
    """Add ``prev_<column>`` of the preceding row of the series for the time and the carried columns.

    Rows are ordered within (series, time chunk) only. Each chunk's first row takes its predecessor from
    a small table of chunk ends, which has one row per series and chunk. Times must be unique per series.
    """
    chunked = df.withColumn("chunk", F.floor(_seconds(ts) / chunk_seconds))
    columns = [ts, *carried]
    inside = Window.partitionBy(*series, "chunk").orderBy(ts)
    whole = F.lag(F.struct(*columns)).over(inside)
    ends = chunked.groupBy(*series, "chunk").agg(F.max(F.struct(*columns)).alias("end"))
    before = ends.select(
        *series, "chunk", F.lag("end").over(Window.partitionBy(*series).orderBy("chunk")).alias("carry")
    )
    lagged = chunked.withColumn("prev", whole).join(before, [*series, "chunk"], "left")
    prev = F.coalesce("prev", "carry")
    return lagged.select(*df.columns, "chunk", *(prev[c].alias(f"prev_{c}") for c in columns))


def running_totals(samples: DataFrame, series: list[str], chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """Each sample (ts, value) of a counter with ``at`` (seconds), its number ``r`` and total growth ``cum`` in the series, and the next sample.

    Growth across a reset is the value after it. Rows are ordered within (series, time chunk) only; what lies before and
    behind a chunk comes from a table with one row per series and chunk.
    """
    steps = with_previous(samples.select(*series, "ts", "value"), series, "ts", ["value"], chunk_seconds)
    growth = lambda now, before: F.when(now < before, now).otherwise(now - before)
    steps = steps.withColumn("grown", F.coalesce(growth(F.col("value"), F.col("prev_value")), F.lit(0.0)))
    steps = steps.select(*series, "chunk", _seconds("ts").alias("at"), "value", "grown")
    inside = Window.partitionBy(*series, "chunk").orderBy("at")
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    point = F.struct("at", "value")
    numbered = steps.withColumns({
        "r": F.row_number().over(inside), "cum": F.sum("grown").over(so_far), "next": F.lead(point).over(inside),
    })
    chunks = steps.groupBy(*series, "chunk").agg(
        F.count(F.lit(1)).alias("n"), F.sum("grown").alias("growth"), F.min(point).alias("head")
    )
    order = Window.partitionBy(*series).orderBy("chunk")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    borders = chunks.select(
        *series, "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("growth").over(earlier), F.lit(0.0)).alias("growth_before"), F.lead("head").over(order).alias("next_head"),
    )
    after = F.coalesce("next", "next_head")
    total = F.col("cum") + F.col("growth_before")
    return numbered.join(borders, [*series, "chunk"]).select(
        *series, "at", "value", (F.col("r") + F.col("n_before")).alias("r"), total.alias("cum"),
        after["at"].alias("next_at"), after["value"].alias("next_value"),
        (total + growth(after["value"], F.col("value"))).alias("next_cum"),
    )


_STATE = ("at", "value", "r", "cum", "next_at", "next_value", "next_cum")


def last_known(states: DataFrame, edges: DataFrame, series: list[str], chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """Each edge with the newest state at or before its time ``t``; states have a time ``at``, one row per series and time.

    One pass over states and edges together, in (series, time chunk); a chunk starts from the last state of those before it.
    """
    kept = [c for c in edges.columns if c not in series]
    nothing = [F.lit(None).cast(edges.schema[c].dataType).alias(c) for c in kept if c != "t"]
    state = F.struct(*_STATE).alias("state")
    empty = F.lit(None).cast(states.select(state).schema["state"].dataType).alias("state")
    rows = states.select(*series, F.col("at").alias("t"), *nothing, state, F.lit(0).alias("kind")).unionByName(
        edges.select(*series, *kept, empty, F.lit(1).alias("kind"))
    ).withColumn("chunk", F.floor(F.col("t") / chunk_seconds))
    so_far = Window.partitionBy(*series, "chunk").orderBy("t", "kind").rowsBetween(Window.unboundedPreceding, 0)
    seen = rows.withColumn("here", F.last("state", ignorenulls=True).over(so_far)).filter("kind = 1")
    ends = rows.groupBy(*series, "chunk").agg(F.max("state").alias("end"))
    earlier = Window.partitionBy(*series).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*series, "chunk", F.last("end", ignorenulls=True).over(earlier).alias("carry"))
    return seen.join(carried, [*series, "chunk"]).select(*series, *kept, F.coalesce("here", "carry").alias("state"))


def counter_windows(
    samples: DataFrame, metric: str, window_seconds: int, step_seconds: int, chunk_seconds: int = CHUNK_SECONDS
) -> DataFrame:
    """Per series and evaluation time: reset-aware increase over the trailing window, extrapolated.

    Evaluation times are multiples of the step, and a window is open on the left and closed on the right.
    The increase between the first and last sample is extended to the window's edges, by at most half a
    mean sample distance where the edge is further than 1.1 of them, and never below a zero counter.
    Windows with fewer than two samples have no result. A window is the difference of two running totals, looked up at
    its edges, so a sample is one row however many windows overlap.
    """
    if window_seconds % step_seconds:
        raise ValueError("the window must be a multiple of the step")
    series = list(_SERIES)
    totals = running_totals(with_series(samples.filter(F.col("metric") == metric)), series, chunk_seconds)
    bounds = totals.groupBy(*series).agg(F.min(F.struct("at", "value")).alias("first"), F.max("at").alias("last"))
    first, last = (F.ceil(c / step_seconds) * step_seconds for c in (F.col("first.at"), F.col("last")))
    evals = F.sequence(first, last + (window_seconds - step_seconds), F.lit(step_seconds).cast("long"))
    times = bounds.select(*series, "first", F.explode(evals).alias("eval_at"))
    edge_of = lambda seconds, end: F.struct((F.col("eval_at") - seconds).cast("double").alias("t"), F.lit(end).alias("is_end"))
    both = F.explode(F.array(edge_of(0, True), edge_of(window_seconds, False))).alias("edge")
    edges = times.select(*series, "first", "eval_at", both).select(*series, "first", "eval_at", "edge.*")
    found = last_known(totals, edges, series, chunk_seconds)
    pairs = found.groupBy(*series, "eval_at").agg(
        F.max("first").alias("first"),
        F.max(F.when(F.col("is_end"), F.col("state"))).alias("end"),
        F.max(F.when(~F.col("is_end"), F.col("state"))).alias("before"),
    )
    # Without a sample before the window, the series begins in it.
    begun = F.col("before").isNotNull()
    opening = F.when(begun, F.struct(F.col("before.next_at").alias("at"), F.col("before.next_value").alias("value"))).otherwise(F.col("first"))
    grouped = pairs.select(
        *series, "eval_at", F.col("end.at").alias("last_at"), opening.alias("first"),
        (F.col("end.r") - F.coalesce("before.r", F.lit(0))).alias("n"),
        (F.col("end.cum") - F.when(begun, F.col("before.next_cum")).otherwise(0.0)).alias("raw"),
    ).filter("n > 1")
    sampled = F.col("last_at") - F.col("first.at")
    distance = sampled / (F.col("n") - 1)

    def edge(gap: Column) -> Column:
        return F.when(gap >= distance * 1.1, distance / 2).otherwise(gap)

    start = edge(F.col("first.at") - (F.col("eval_at") - window_seconds))
    to_zero = F.when(
        (F.col("raw") > 0) & (F.col("first.value") >= 0), sampled * F.col("first.value") / F.nullif("raw", F.lit(0.0))
    )
    start = F.least(start, to_zero)
    end = edge(F.col("eval_at") - F.col("last_at"))
    increase = F.col("raw") * (sampled + start + end) / sampled
    return (
        grouped.filter(sampled > 0)
        .select(*series, F.timestamp_seconds("eval_at").alias("eval_ts"), increase.alias("increase"))
        .withColumn("rate", F.col("increase") / window_seconds)
    )


def label(name: str) -> Column:
    """Value of one label of a series."""
    return F.map_from_entries("label_key")[name]


def counter_rate(
    samples: DataFrame,
    metric: str,
    window_seconds: int = 300,
    step_seconds: int = 60,
    by: list[str] | None = None,
    how: str = "sum",
    where: Column | None = None,
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Per-second rate over the trailing window, summed or averaged per group and evaluation time.

    ``by`` holds series columns or label names; ``where`` filters series, for example by a label. Without ``by`` there
    is a row, 0 without any series, for every evaluation time. ``chunk_seconds`` bounds how much of a dense series
    one task orders.
    """
    rates = counter_windows(samples, metric, window_seconds, step_seconds, chunk_seconds)
    if where is not None:
        rates = rates.filter(where)
    keys = [F.col(k) if k in ("job", "instance") else label(k).alias(k) for k in by or []]
    combined = rates.groupBy(*keys, "eval_ts").agg({"sum": F.sum, "avg": F.avg}[how]("rate").alias("rate"))
    return combined if keys else _or_zero(combined, samples, "rate", window_seconds, step_seconds)


def evaluation_times(samples: DataFrame, window_seconds: int, step_seconds: int) -> DataFrame:
    """All evaluation times, from the first sample of any metric to the end of the last one's last window."""
    first, last = (F.ceil(f(_seconds("ts")) / step_seconds) * step_seconds for f in (F.min, F.max))
    ends = samples.agg(first.alias("first"), (last + (window_seconds - step_seconds)).alias("last"))
    every = F.explode(F.sequence(F.col("first"), F.col("last"), F.lit(step_seconds).cast("long")))
    return ends.filter("first is not null").select(every.alias("at")).select(F.timestamp_seconds("at").alias("eval_ts"))


def _or_zero(df: DataFrame, samples: DataFrame, measure: str, window_seconds: int, step_seconds: int) -> DataFrame:
    times = evaluation_times(samples, window_seconds, step_seconds)
    return times.join(df, "eval_ts", "left").select("eval_ts", F.coalesce(measure, F.lit(0.0)).alias(measure))


def counter_increase(
    samples: DataFrame,
    metric: str,
    window_seconds: int = 300,
    step_seconds: int = 60,
    label_name: str | None = None,
    pattern: str | None = None,
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Total increase per evaluation time over the series whose label matches a whole-text pattern; 0 without a series."""
    rates = counter_windows(samples, metric, window_seconds, step_seconds, chunk_seconds)
    if label_name is not None:
        rates = rates.filter(F.coalesce(F.rlike(label(label_name), F.lit(f"^(?:{pattern})$")), F.lit(False)))
    total = rates.groupBy("eval_ts").agg(F.sum("increase").alias("increase"))
    return _or_zero(total, samples, "increase", window_seconds, step_seconds)


def busy_percent(samples: DataFrame, metric: str = "node_cpu_seconds_total", window_seconds: int = 300, step_seconds: int = 60) -> DataFrame:
    """100 minus the mean idle rate in percent, per instance."""
    idle = counter_rate(samples, metric, window_seconds, step_seconds, ["instance"], "avg", label("mode") == "idle")
    return idle.select("instance", "eval_ts", (100 - F.col("rate") * 100).alias("value"))


def gauge_signal(samples: DataFrame, rule: str, metric: str, by: list[str], step_seconds: int = 15, where: Column | None = None) -> DataFrame:
    """Largest value per group at every step that has a sample: rows ``rule, grp, ts, value``."""
    chosen = with_series(samples.filter(F.col("metric") == metric))
    if where is not None:
        chosen = chosen.filter(where)
    at = F.ceil(_seconds("ts") / step_seconds) * step_seconds
    newest = (
        chosen.groupBy(*_SERIES, at.alias("at")).agg(F.max(F.struct("ts", "value"))["value"].alias("value"))
    )
    group = F.concat_ws("/", *by) if by else F.lit("all")
    return (
        newest.groupBy(group.alias("grp"), "at")
        .agg(F.max("value").alias("value"))
        .select(F.lit(rule).alias("rule"), "grp", F.timestamp_seconds("at").alias("ts"), "value")
    )


def free_space_signal(samples: DataFrame, rule: str, free: str, size: str, step_seconds: int = 15) -> DataFrame:
    """Free space in percent of the total at every step that has both."""
    at = F.ceil(_seconds("ts") / step_seconds) * step_seconds
    newest = (
        with_series(samples.filter(F.col("metric").isin(free, size)))
        .groupBy(*_SERIES, at.alias("at"))
        .agg(F.max(F.struct("ts", "value"))["value"].alias("value"))
    )

    def total(metric: str) -> Column:
        return F.sum(F.when(F.col("metric") == metric, F.col("value")))

    return (
        newest.groupBy("at")
        .agg((total(free) / F.nullif(total(size), F.lit(0.0)) * 100).alias("value"))
        .filter(F.col("value").isNotNull())
        .select(F.lit(rule).alias("rule"), F.lit("all").alias("grp"), F.timestamp_seconds("at").alias("ts"), "value")
    )


def service_signals(samples: DataFrame, step_seconds: int = 15) -> DataFrame:
    """The signals that :data:`ALERT_RULES` are about."""
    memory = "process_resident_memory_bytes"

    def resident(rule: str, job: str) -> DataFrame:
        return gauge_signal(samples, rule, memory, [], step_seconds, F.col("job") == job)

    # Job names of the two watched services.
    database, api = "postgres-analytics", "fastapi-service"
    cpu = busy_percent(samples).select(
        F.lit("ServerCPUUsageCritical").alias("rule"), F.col("instance").alias("grp"), F.col("eval_ts").alias("ts"), "value"
    )
    signals = [
        gauge_signal(samples, "ServiceDown", "up", ["job", "instance"], step_seconds),
        resident("PostgresRAMUsageWarning", database),
        resident("PostgresRAMUsageCritical", database),
        resident("FastAPIRAMUsageWarning", api),
        resident("FastAPIRAMUsageCritical", api),
        cpu,
        free_space_signal(
            samples, "ServerDiskSpaceLow", "node_filesystem_free_bytes", "node_filesystem_size_bytes", step_seconds
        ),
    ]
    out = signals[0]
    for signal in signals[1:]:
        out = out.unionByName(signal)
    return out


def rules_table(spark, rules=ALERT_RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), RULE_SCHEMA)


def sustained_alerts(
    signals: DataFrame, rules: DataFrame, max_gap_seconds: int | None = None, chunk_seconds: int = CHUNK_SECONDS
) -> DataFrame:
    """Spans over which a rule's condition held at least as long as the rule demands.

    ``signals`` has unique ``(rule, grp, ts)``. Samples further apart than ``max_gap_seconds`` do not
    count as continuous. Spans are found inside time chunks; only the pieces that touch a chunk's edge,
    at most two per chunk, are chained across chunks.
    """
    series = ["rule", "grp"]
    judged = signals.join(rules, "rule")
    value, limit = F.col("value"), F.col("threshold")
    holds = (
        F.when(F.col("comparison") == ">=", value >= limit)
        .when(F.col("comparison") == "<=", value <= limit)
        .when(F.col("comparison") == "==", value == limit)
    )
    keep = ["severity", "hold_seconds"]
    judged = judged.select(*series, "ts", *keep, F.coalesce(holds, F.lit(False)).alias("holds"))
    stepped = with_previous(judged, series, "ts", ["holds"], chunk_seconds)
    joined = F.coalesce(F.col("prev_holds"), F.lit(False))
    if max_gap_seconds is not None:
        joined = joined & (_seconds("ts") - _seconds("prev_ts") <= max_gap_seconds)
    inside = Window.partitionBy(*series, "chunk").orderBy("ts")
    marked = stepped.select(
        *series, "chunk", "ts", *keep, "holds",
        (F.col("holds") & joined).alias("continues"),
        F.lead("ts").over(inside).isNull().alias("closes_chunk"),
    )
    numbered = marked.withColumn("piece", F.sum((~F.col("continues")).cast("int")).over(inside))
    pieces = (
        numbered.filter("holds")
        .groupBy(*series, *keep, "chunk", "piece")
        .agg(
            F.min("ts").alias("started_at"),
            F.max("ts").alias("ended_at"),
            F.bool_and("continues").alias("continues"),
            F.bool_or("closes_chunk").alias("closes_chunk"),
        )
    )
    # A piece that goes on from the chunk before has no row that opens a span.
    at_edge = F.col("continues") | F.col("closes_chunk")
    spans_inside = pieces.filter(~at_edge).select(*series, *keep, "started_at", "ended_at")
    along = Window.partitionBy(*series).orderBy("started_at")
    chained = (
        pieces.filter(at_edge)
        .withColumn("span", F.sum((~F.col("continues")).cast("int")).over(along))
        .groupBy(*series, *keep, "span")
        .agg(F.min("started_at").alias("started_at"), F.max("ended_at").alias("ended_at"))
        .drop("span")
    )
    held = _seconds("ended_at") - _seconds("started_at")
    spans = spans_inside.unionByName(chained).filter(held >= F.col("hold_seconds"))
    fires = F.timestamp_micros(F.unix_micros("started_at") + F.col("hold_seconds") * 1_000_000)
    return spans.select(*series, "severity", "started_at", fires.alias("fires_at"), "ended_at")
