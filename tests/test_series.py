"""Ranks and rates against brute force, with hot groups and awkward gaps."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tideline.operators import timeseries as series
from tideline.operators.ranks import p50_index, p95_index, pick_by_index, picked_columns
from tideline.operators.runs import (
    bottleneck_stage,
    first_bottleneck,
    latency_percentiles,
    max_passing,
    sustained_target,
)
from tideline.sources.metrics_text import parse_metric_lines

def indexes():
    return {"p50": p50_index(F.col("n")), "p95": p95_index(F.col("n"))}


def shapes(seed):
    rng = random.Random(seed)
    return {
        "hot": [round(rng.expovariate(1 / 50), 2) for _ in range(4000)],
        "outlier": [1e12, -1e12] + [rng.random() for _ in range(900)],
        "same": [7.5] * 500,
        "two": [1.0] * 300 + [2.0] * 20,
        "one": [3.25],
        "tight": [1.0 + rng.random() * 1e-9 for _ in range(600)],
        None: [float(v) for v in range(40)],
    }


@pytest.mark.parametrize("window_rows", [5, 200, 1_000_000])
def test_ranks_at_every_depth(spark, window_rows):
    data = shapes(window_rows)
    rows = [(name, v) for name, values in data.items() for v in values] + [("hot", None), ("empty", None)]
    df = spark.createDataFrame(rows, "name string, v double").repartition(8)
    picked = picked_columns(pick_by_index(df, ["name"], "v", indexes(), window_rows), ["name"], ["p50", "p95"])
    got = {r.name: (r.p50, r.p95) for r in picked.collect()}
    want = {}
    for name, values in data.items():
        ordered, n = sorted(values), len(values)
        want[name] = (ordered[n // 2], ordered[min(n * 95 // 100, n - 1)])
    assert got == want


def brute_rate(points, seconds):
    points = sorted(points)
    rises, out = [], {}
    for i, (ts, key, v) in enumerate(points):
        prev = points[i - 1][2] if i else None
        rises.append(0 if prev is None else (v if v < prev else v - prev))
        start = ts - timedelta(seconds=seconds)
        out[key] = sum(r for r, p in zip(rises, points) if p[0] >= start) / seconds
    return out


@pytest.mark.parametrize("chunk_seconds", [7, 30, 100, 3600])
def test_rates_over_chunk_borders(spark, chunk_seconds):
    rng = random.Random(chunk_seconds)
    begin, rows, key = datetime(2024, 1, 1), [], 0
    for name, n, gap in (("hot", 600, 3), ("sparse", 40, 200), ("single", 1, 1)):
        at, value = begin, 0
        for _ in range(n):
            at += timedelta(milliseconds=rng.randint(1, gap * 1000))
            value = 0 if rng.random() < 0.05 else value + rng.randint(0, 9)
            rows.append((key, name, at, value))
            key += 1
    df = spark.createDataFrame(rows, "k int, name string, ts timestamp_ntz, value bigint").repartition(8)
    got = {r.k: r.rate for r in series.trailing_rate(df, 30, tie="k", chunk_seconds=chunk_seconds).collect()}
    want = {}
    for name in ("hot", "sparse", "single"):
        want |= brute_rate([(ts, k, v) for k, n, ts, v in rows if n == name], 30)
    assert set(got) == set(want)
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_chunks_shrink_with_the_busiest_series(spark, monkeypatch):
    at = F.timestamp_millis(F.col("id") * 100)
    df = spark.range(0, 6000, 1, 8).select(F.lit("a").alias("name"), at.alias("ts"), F.col("id").alias("value"))
    monkeypatch.setattr(series, "CHUNK_ROWS", 1000)
    assert series.chunk_for(df) == 100
    monkeypatch.setattr(series, "CHUNK_ROWS", 10)
    assert series.chunk_for(df) == 10
    rates = series.trailing_rate(df, 30).where("value >= 400").select("rate").distinct().collect()
    assert [r.rate for r in rates] == [pytest.approx(301 / 30)]


def test_last_reading_skips_missing_values(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", t, 1.0), ("a", t + timedelta(1), None)], "name string, ts timestamp_ntz, value double")
    assert [tuple(r) for r in series.last_reading(df).collect()] == [("a", 1.0, t)]


def test_stats_of_nothing_positive(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", -3.0), ("b", 4.0)], "name string, value double")
    got = {r.name: (r.mean_value, r.min_value, r.max_value, r.n) for r in series.sample_stats(df, ["name"]).collect()}
    assert got == {"a": (0.0, 0.0, 0.0, 0), "b": (4.0, 4.0, 4.0, 1)}


def test_bands_of_an_unknown_metric(spark):
    df = spark.createDataFrame([("latency_p50_s", 3.0), ("latency_p50_s", 2.9), ("in_sync", 1.0), ("else", 1.0)], "name string, value double")
    got = {(r.name, r.value): r.band for r in series.in_bands(df, series.bands(spark)).collect()}
    assert got == {("latency_p50_s", 3.0): "yellow", ("latency_p50_s", 2.9): "green", ("in_sync", 1.0): "green", ("else", 1.0): None}


def test_metric_lines(spark):
    lines = ["# HELP x", "a 1.5", "b NaN-ish", "c 1 2", "", "  d\t7  ", "lonely", "e 1e3"]
    got = parse_metric_lines(spark.createDataFrame([(l,) for l in lines], "value string")).collect()
    assert {tuple(r) for r in got} == {("a", 1.5), ("d", 7.0), ("e", 1000.0)}


def test_configuration_where_all_runs_timed_out(spark):
    df = spark.createDataFrame([("a", 100), ("a", 300), ("a", 200), ("a", None), ("b", None)], "c string, e2e_ms bigint")
    got = {r.c: (r.p50_ms, r.p95_ms, r.avg_ms, r.tps_p50, r.runs, r.timeouts) for r in latency_percentiles(df, ["c"], 100).collect()}
    assert got == {"a": (200, 300, 200, 500.0, 3, 1), "b": (None, None, None, None, 0, 1)}


LEVELS = "run_id string, level int, target_tps double, inject_tps double, e2e_tps double, kafka_rate_avg double, lag_remaining bigint, synced boolean"


def test_ramp_stops_at_the_first_failing_level(spark):
    rows = [
        ("r", 1, 100.0, 99.0, 80.0, 0.0, 0, True),
        ("r", 2, 200.0, 190.0, 150.0, 0.0, 0, True),
        ("r", 3, 500.0, 480.0, 120.0, 200.0, 9, False),
        ("r", 4, 900.0, 880.0, 700.0, 0.0, 0, True),
        ("ok", 1, 100.0, 99.0, 60.0, 0.0, 0, True),
    ]
    levels = spark.createDataFrame(rows, LEVELS)
    assert [tuple(r) for r in first_bottleneck(levels).collect()] == [("r", 3, 500.0, 120.0, "debezium_or_kafka", 9)]
    got = {r.run_id: (r.max_e2e_tps, r.last_level, r.sustained_tps) for r in max_passing(levels).collect()}
    assert got == {"r": (150.0, 3, 120), "ok": (60.0, 1, 50)}


@pytest.mark.parametrize(
    "target, injected, log_rate, stage",
    [(100, 69, 0, "mysql_inject"), (100, 90, 50, "debezium_or_kafka"), (100, 90, 0, "spark_or_mongo"), (100, 90, 80, "spark_or_mongo")],
)
def test_stages(spark, target, injected, log_rate, stage):
    column = bottleneck_stage(F.lit(float(target)), F.lit(float(injected)), F.lit(float(log_rate)))
    assert spark.range(1).select(column.alias("s")).first().s == stage


def test_sustained_floor(spark):
    row = spark.range(1).select(sustained_target(F.lit(None).cast("double")).alias("a"), sustained_target(F.lit(99.9)).alias("b")).first()
    assert (row.a, row.b) == (50, 79)


def test_rates_forget_infinite_and_wide_readings(spark):
    """What has left the window leaves no trace: nothing is subtracted from a running sum."""
    begin = datetime(2024, 1, 1)
    inf, nan = float("inf"), float("nan")
    values = {"inf": [1.0, 2.0, inf, 3.0, 4.0, inf, inf, 5.0, 6.0, 7.0, 8.0], "nan": [1.0, nan, 3.0, 4.0, 5.0, 6.0], "wide": [1e17, 2e17, 1.0, 2.0, 3.0, 4.0, 5.0]}
    rows = [(f"{n}{i}", n, begin + timedelta(seconds=6 * i), v) for n, vs in values.items() for i, v in enumerate(vs)]
    rows += [(f"none{i}", None, begin + timedelta(seconds=i), float(i)) for i in range(4)]
    df = spark.createDataFrame(rows, "k string, name string, ts timestamp_ntz, v double").repartition(4)
    for chunk_seconds in (3, 10, 1000):
        got = {r.k: r.rate for r in series.trailing_rate(df, 10, value="v", tie="k", chunk_seconds=chunk_seconds).collect()}
        assert len(got) == len(rows)
        assert got["inf2"] == inf and got["inf6"] == inf
        assert got["inf4"] == pytest.approx((3 + 1) / 10) and got["inf9"] == got["inf10"] == pytest.approx(2 / 10)
        assert got["nan1"] != got["nan1"] and got["nan5"] == pytest.approx(2 / 10)
        assert got["wide6"] == pytest.approx(2 / 10)
        assert got["none3"] == pytest.approx(3 / 10)


def brute_extrapolated(points, seconds):
    """The published rule, reading by reading."""
    points, out = sorted(points), {}
    for i, (ts, key, _) in enumerate(points):
        inside = [p for p in points if ts - timedelta(seconds=seconds) <= p[0] <= ts]
        rise = sum(b[2] if b[2] < a[2] else b[2] - a[2] for a, b in zip(inside, inside[1:]))
        sampled = (inside[-1][0] - inside[0][0]).total_seconds()
        if len(inside) < 2 or not sampled:
            out[key] = None
            continue
        gap = sampled / (len(inside) - 1)
        to_start = (inside[0][0] - (ts - timedelta(seconds=seconds))).total_seconds()
        fill = gap / 2 if to_start >= gap * 1.1 else to_start
        if rise > 0 and inside[0][2] >= 0:
            fill = min(fill, sampled * inside[0][2] / rise)
        out[key] = rise * (sampled + fill) / sampled / seconds
    return out


@pytest.mark.parametrize("chunk_seconds", [7, 30, 100])
def test_extrapolated_rates(spark, chunk_seconds):
    rng = random.Random(chunk_seconds + 1)
    begin, rows, key = datetime(2024, 1, 1), [], 0
    for name, n, gap in (("hot", 300, 3), ("sparse", 60, 40), ("single", 1, 1)):
        at, value = begin, rng.randint(0, 3)
        for _ in range(n):
            at += timedelta(milliseconds=rng.randint(1, gap * 1000))
            value = 0 if rng.random() < 0.05 else value + rng.randint(0, 9)
            rows.append((key, name, at, value))
            key += 1
    df = spark.createDataFrame(rows, "k int, name string, ts timestamp_ntz, value bigint").repartition(8)
    got = {r.k: r.rate for r in series.extrapolated_rate(df, 30, tie="k", chunk_seconds=chunk_seconds).collect()}
    want = {}
    for name in ("hot", "sparse", "single"):
        want |= brute_extrapolated([(ts, k, v) for k, n, ts, v in rows if n == name], 30)
    assert set(got) == set(want)
    assert all((got[k] is None) == (want[k] is None) and (want[k] is None or abs(got[k] - want[k]) < 1e-9) for k in want)


def test_rates_shuffle_readings_once(spark, capsys):
    df = spark.createDataFrame([("a", datetime(2024, 1, 1), 1)], "name string, ts timestamp_ntz, value bigint")
    series.trailing_rate(df, 30, chunk_seconds=30).explain()
    plan = capsys.readouterr().out
    # The readings and, far smaller, the last value of each chunk and what it carries over.
    assert plan.count("REPARTITION_BY_COL") == 1 and plan.count("Exchange") <= 4


@pytest.mark.parametrize("slack", [0.0, 0.01])
def test_sketches_close_to_exact_ranks(spark, slack):
    """Sketches of batches merge, and what they bound is exact, also where a bound misses."""
    from tideline.operators.ranks import close_exactly, merged_sketches, sketched, sketched_bounds

    data = shapes(3) | {"odd": [float("nan")] * 5 + [float("inf"), float("-inf")] + [float(v) for v in range(60)]}
    rows = [(name, v) for name, values in data.items() for v in values] + [("hot", None), ("empty", None)]
    df = spark.createDataFrame(rows, "name string, v double").repartition(8)
    parts = [sketched(df.where(F.pmod(F.xxhash64("v"), F.lit(3)) == k), ["name"], "v") for k in range(3)]
    sketches = merged_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["name"])
    picked = picked_columns(close_exactly(df, sketches, ["name"], "v", indexes(), slack), ["name"], ["p50", "p95"])
    got = {r.name: repr((r.p50, r.p95)) for r in picked.collect()}
    want = {}
    for name, values in data.items():
        ordered, n = sorted(values, key=lambda v: (v != v, v)), len(values)
        want[name] = repr((ordered[n // 2], ordered[min(n * 95 // 100, n - 1)]))
    assert got == want
    # The published error of such a sketch, and a grid step to either side.
    hot = sorted(data["hot"])
    for r in sketched_bounds(sketches, ["name"], indexes(), 0.01).where("name = 'hot'").collect():
        inside = sum(r["low"] <= v <= r["high"] for v in hot)
        assert r["low"] <= hot[r["rank"]] <= r["high"] and inside < 0.06 * len(hot)


def test_rates_deal_readings_to_as_many_tasks_as_their_number_asks(spark, monkeypatch):
    monkeypatch.setattr(series, "TASK_ROWS", 200, raising=False)
    start = datetime(2024, 1, 1)
    rows = [("a", start + timedelta(seconds=k), float(k % 50), k) for k in range(2000)]
    df = spark.createDataFrame(rows, "name string, ts timestamp, value double, k int")
    rated = series.extrapolated_rate(df, 30, tie="k", chunk_seconds=10)
    tasks = [r.n for r in rated.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()]
    assert sum(tasks) == 2000 and len(tasks) > 8
