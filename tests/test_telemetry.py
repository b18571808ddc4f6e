import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from delayhouse.operators import telemetry
from delayhouse.sources import schemas

from .conftest import values

T0 = datetime(2024, 1, 5)


def samples(spark, rows):
    full = [("j", i, m, labels, T0 + timedelta(seconds=s), float(v)) for i, m, labels, s, v in rows]
    return spark.createDataFrame(full, schemas.SAMPLES)


def signals(spark, points, rule="R", grp="g"):
    rows = [(rule, grp, T0 + timedelta(seconds=s), float(v)) for s, v in points]
    return spark.createDataFrame(rows, "rule string, grp string, ts timestamp, value double")


def seconds(when):
    return int((when - T0).total_seconds())


def alerts(spark, points, hold, chunk=3600, gap=None):
    rules = telemetry.rules_table(spark, [("R", "critical", 1.0, ">=", hold)])
    out = telemetry.sustained_alerts(signals(spark, points), rules, gap, chunk).collect()
    return sorted((seconds(r.started_at), seconds(r.fires_at), seconds(r.ended_at)) for r in out)


def test_alert_needs_the_whole_hold_time(spark):
    assert alerts(spark, [(s, 1) for s in range(0, 10)] + [(10, 0)], 10) == []
    assert alerts(spark, [(s, 1) for s in range(0, 11)] + [(11, 0)], 10) == [(0, 10, 10)]


def test_alert_spans_do_not_depend_on_chunks(spark):
    rng = random.Random(3)
    points, level = [], 1
    for s in range(0, 1200, 2):
        level = level if rng.random() < 0.9 else 1 - level
        if not 400 < s < 460:
            points.append((s, level))
    spans, run = [], []
    for (s, v), prev in zip(points, [None, *points]):
        if run and (not v or s - prev[0] > 20):
            spans.append(run)
            run = []
        if v:
            run.append(s)
    spans.append(run)
    expected = sorted((r[0], r[0] + 6, r[-1]) for r in spans if r and r[-1] - r[0] >= 6)
    assert len(expected) > 5
    for chunk in (7, 60, 100000):
        assert alerts(spark, points, 6, chunk, 20) == expected


def test_previous_sample_crosses_chunks(spark):
    df = signals(spark, [(s, s) for s in (0, 3, 9, 50, 51, 400)])
    got = telemetry.with_previous(df, ["rule", "grp"], "ts", ["value"], 10).orderBy("ts").collect()
    assert [r.prev_value for r in got] == [None, 0, 3, 9, 50, 51]


def test_counter_rate_survives_a_reset_and_extrapolates(spark):
    rows = [("i", "c", {"status": "500"}, s, v) for s, v in zip(range(15, 301, 15), [*range(10, 110, 10), *range(0, 100, 10)])]
    out = telemetry.counter_windows(samples(spark, rows), "c", 300, 300).collect()
    # 20 samples over 285 s: +90 before the reset, then 0 (fresh count 0) and +90; the start reaches 0 at 15 s before.
    assert [(seconds(r.eval_ts), round(r.increase, 6)) for r in out] == [(300, round(180 * 300 / 285, 6))]


def test_overlapping_windows_do_not_copy_samples(spark):
    """Rows are samples and edges, and windows equal sums over each window's own samples, with resets, gaps and chunks."""
    rng = random.Random(7)
    rows, at, value = [], 0, 0
    for _ in range(400):
        at += rng.choice([1, 5, 15, 15, 15, 200])
        value = rng.randrange(5) if rng.random() < 0.05 else value + rng.randrange(20)
        rows.append((at, value))
    given = samples(spark, [("i", "c", {}, s, v) for s, v in rows])
    series = ["job", "instance", "metric", "label_key"]
    totals = telemetry.running_totals(telemetry.with_series(given), series, 60)
    assert totals.count() == len(rows)
    grown = [0.0]
    for (_, a), (_, b) in zip(rows, rows[1:]):
        grown.append(grown[-1] + (b if b < a else b - a))
    assert [(r.r, r.cum) for r in totals.orderBy("at").collect()] == [(i + 1, g) for i, g in enumerate(grown)]
    base = T0.replace(tzinfo=timezone.utc).timestamp()
    for chunk in (30, 10_000):
        out = {seconds(r.eval_ts): r.increase for r in telemetry.counter_windows(given, "c", 300, 30, chunk).collect()}
        want = {}
        for e in range(0, rows[-1][0] + 300, 30):
            here = [(s, v, g) for (s, v), g in zip(rows, grown) if e - 300 < s <= e]
            if len(here) > 1:
                raw, sampled = here[-1][2] - here[0][2], here[-1][0] - here[0][0]
                distance = sampled / (len(here) - 1)
                edge = lambda gap: distance / 2 if gap >= distance * 1.1 else gap
                start = edge(here[0][0] - (e - 300))
                if raw > 0:
                    start = min(start, sampled * here[0][1] / raw)
                want[e] = raw * (sampled + start + edge(e - here[-1][0])) / sampled
        assert base % 30 == 0 and out.keys() == want.keys()
        assert all(abs(out[e] - want[e]) < 1e-6 for e in want)


def test_counter_series_filters_and_groups(spark):
    rows = [("i", "c", {"status": code}, s, v * s) for code, v in (("500", 1), ("503", 2), ("200", 4)) for s in range(0, 601, 15)]
    df = samples(spark, rows)
    rate = telemetry.counter_rate(df, "c", 300, 300, ["status"]).filter(F.col("eval_ts") == T0 + timedelta(seconds=600))
    assert {r.status: round(r.rate, 6) for r in rate.collect()} == {"500": 1.0, "503": 2.0, "200": 4.0}
    errors = telemetry.counter_increase(df, "c", 300, 300, "status", "5..").filter(F.col("eval_ts") == T0 + timedelta(seconds=600))
    assert round(errors.first().increase, 6) == 900.0
    none = telemetry.counter_increase(df, "c", 300, 300, "status", "4..").filter(F.col("increase") != 0)
    assert none.isEmpty()


def test_gauges(spark):
    df = samples(spark, [("a", "m", {}, 0, 9), ("a", "m", {}, 5, 3), ("b", "m", {}, 1, 4), ("a", "n", {}, 1, 1), ("b", "n", {}, 1, 1), ("a", "up", {}, 0, 1), ("a", "up", {}, 9, 0)])
    assert values(telemetry.gauge_max(df, "m")) == [("j", 4.0)]
    assert values(telemetry.gauge_diff(df, "m", "n").select("instance", "value")) == [("a", 2.0), ("b", 3.0)]
    assert telemetry.gauge_ratio(df, "n", "m").first().percent == 2 / 7 * 100
    assert [r.instance for r in telemetry.down_targets(df).collect()] == ["a"]


def test_fixed_rules_run_on_service_signals(spark):
    rows = [("a", "up", {}, s, 0) for s in range(0, 61, 15)]
    rows += [("d", "node_filesystem_free_bytes", {}, s, 5) for s in range(0, 901, 15)]
    rows += [("d", "node_filesystem_size_bytes", {}, s, 100) for s in range(0, 901, 15)]
    out = telemetry.sustained_alerts(telemetry.service_signals(samples(spark, rows)), telemetry.rules_table(spark))
    assert sorted((r.rule, r.severity, seconds(r.fires_at)) for r in out.collect()) == [
        ("ServerDiskSpaceLow", "warning", 600),
        ("ServiceDown", "critical", 10),
    ]
