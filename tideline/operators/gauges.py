"""One reading of every pipeline gauge, as ``(name, value)`` rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.counters import top_members
from tideline.operators.reconcile import all_in_sync, both_readable, reconcile_counts
from tideline.operators.state import live_rows
from tideline.schema import (
    CUSTOMERS,
    KEY_CUSTOMERS_TOTAL,
    KEY_ORDERS_REVENUE,
    KEY_ORDERS_TOTAL,
    ORDERS,
    topic_of,
)

# ---- fixed values: gauge names ----
SOURCE_GAUGES = {CUSTOMERS: "cdc_mysql_customers_total", ORDERS: "cdc_mysql_orders_total"}
TARGET_GAUGES = {CUSTOMERS: "cdc_mongo_customers_total", ORDERS: "cdc_mongo_orders_total"}
COUNTER_GAUGES = {
    KEY_ORDERS_REVENUE: "cdc_redis_orders_revenue",
    KEY_ORDERS_TOTAL: "cdc_redis_orders_total",
    KEY_CUSTOMERS_TOTAL: "cdc_redis_customers_total",
}
TOP_SCORE_GAUGE = "cdc_redis_top_customer_score"
OFFSET_GAUGES = {topic_of(CUSTOMERS): "cdc_kafka_customers_offset", topic_of(ORDERS): "cdc_kafka_orders_offset"}
UP_GAUGE = "cdc_pipeline_up"
IN_SYNC_GAUGE = "cdc_mysql_mongo_in_sync"
REPORT_GAUGES = {
    "latency_p50": "cdc_benchmark_latency_p50",
    "latency_p95": "cdc_benchmark_latency_p95",
    "latency_p99": "cdc_benchmark_latency_p99",
    "latency_avg": "cdc_benchmark_latency_avg",
    "throughput_e2e": "cdc_benchmark_throughput_e2e",
    "throughput_mysql": "cdc_benchmark_throughput_mysql",
    "sync_rate_pct": "cdc_benchmark_sync_rate_pct",
    "redis_p50": "cdc_benchmark_redis_p50_ms",
    "redis_p99": "cdc_benchmark_redis_p99_ms",
    "kafka_partitions": "cdc_benchmark_kafka_partitions",
    "spark_workers": "cdc_benchmark_spark_workers",
    "trigger_interval": "cdc_benchmark_trigger_interval_s",
    "baseline_tps": "cdc_scale_baseline_tps",
    "scaled_tps": "cdc_scale_scaled_tps",
    "throughput_improvement_pct": "cdc_scale_improvement_pct",
    "baseline_p95_s": "cdc_scale_baseline_p95",
    "scaled_p95_s": "cdc_scale_scaled_p95",
}
# ---- end of fixed values ----


def _named(rows: DataFrame, key: str, value: str, names: dict[str, str]) -> DataFrame:
    label = F.coalesce(*[F.when(F.col(key) == k, name) for k, name in names.items()])
    return rows.select(label.alias("name"), F.col(value).cast("double").alias("value")).where("name is not null")


def _every(rows: DataFrame, key: str, value: str, names: list[str]) -> DataFrame:
    """Rows of all ``names``: one that was read but has no row is zero, one whose value is NULL could not be read."""
    expected = rows.sparkSession.createDataFrame([(n,) for n in names], f"{key} string")
    known = rows.select(key, value, F.lit(True).alias("_read"))
    return expected.join(known, key, "left").select(key, F.when(F.col("_read"), F.col(value)).otherwise(0).alias(value))


def _single(rows: DataFrame, name: str, value: Column) -> DataFrame:
    return rows.select(F.lit(name).alias("name"), value.cast("double").alias("value"))


def gauges(
    source_counts: DataFrame, target_counts: DataFrame, counter_table: DataFrame, scores: DataFrame, offsets: DataFrame
) -> DataFrame:
    """Counts of both sides, serving counters, best score, log ends, health and sync flags."""
    source_counts = _every(source_counts, "table", "source_rows", list(SOURCE_GAUGES))
    target_counts = _every(target_counts, "table", "target_rows", list(TARGET_GAUGES))
    counter_table = _every(counter_table, "key", "value", list(COUNTER_GAUGES))
    offsets = _every(offsets, "topic", "end_offset", list(OFFSET_GAUGES))
    both = source_counts.join(target_counts, ["table"], "full")
    up = both.agg(F.min(both_readable(F.col("source_rows"), F.col("target_rows"))).alias("up"))
    parts = [
        _named(source_counts, "table", "source_rows", SOURCE_GAUGES),
        _named(target_counts, "table", "target_rows", TARGET_GAUGES),
        _named(counter_table, "key", "value", COUNTER_GAUGES),
        _single(top_members(scores, 1).agg(F.coalesce(F.max("score"), F.lit(0)).alias("score")), TOP_SCORE_GAUGE, F.col("score")),
        _named(offsets, "topic", "end_offset", OFFSET_GAUGES),
        _single(up, UP_GAUGE, F.col("up")),
        _single(all_in_sync(reconcile_counts(source_counts, target_counts)), IN_SYNC_GAUGE, F.col("in_sync")),
    ]
    return reduce(DataFrame.unionByName, parts)


def report_gauges(readings: DataFrame, at: Column) -> DataFrame:
    """Report readings, one column each, as gauges ``(ts, name, value)`` taken at a time of their own."""
    named = [F.struct(F.lit(gauge).alias("name"), F.col(column).alias("value")) for column, gauge in REPORT_GAUGES.items()]
    return readings.select(at.alias("ts"), F.inline(F.array(*named)))


def taken(gauge_rows: DataFrame, at: Column) -> DataFrame:
    """Gauges with the time of their reading: rows of the history that rates and last values run over."""
    return gauge_rows.select(at.alias("ts"), "name", "value")


def table_gauges(source_counts: DataFrame, tables, offsets: DataFrame) -> DataFrame:
    """Every gauge from the state tables of a running stream: one version of all of them, and no parse of the log."""
    view = tables.pinned()
    live = live_rows(view.current().select("table", "op"))
    target = live.groupBy("table").agg(F.count(F.lit(1)).cast("bigint").alias("target_rows"))
    return gauges(source_counts, target, view.counters(), view.scores(), offsets)
