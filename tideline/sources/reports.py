"""JSON benchmark reports with parts missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The fields a report may carry.
REPORT_SCHEMA = """
    run_id string,
    latency struct<p50_s: double, p95_s: double, p99_s: double, avg_s: double>,
    throughput_baseline struct<e2e_tps: double, mysql_tps: double, sync_rate_pct: double>,
    redis_latency map<string, struct<p50_ms: double, p99_ms: double>>,
    config struct<kafka_partitions_orders: bigint, spark_workers: bigint>,
    comparison struct<baseline_tps: double, scaled_tps: double, throughput_improvement_pct: double,
                      baseline_p95_s: double, scaled_p95_s: double>
"""
_READINGS = {
    "latency_p50": "latency.p50_s",
    "latency_p95": "latency.p95_s",
    "latency_p99": "latency.p99_s",
    "latency_avg": "latency.avg_s",
    "throughput_e2e": "throughput_baseline.e2e_tps",
    "throughput_mysql": "throughput_baseline.mysql_tps",
    "sync_rate_pct": "throughput_baseline.sync_rate_pct",
    "kafka_partitions": "config.kafka_partitions_orders",
    "spark_workers": "config.spark_workers",
    "baseline_tps": "comparison.baseline_tps",
    "scaled_tps": "comparison.scaled_tps",
    "throughput_improvement_pct": "comparison.throughput_improvement_pct",
    "baseline_p95_s": "comparison.baseline_p95_s",
    "scaled_p95_s": "comparison.scaled_p95_s",
}


def read_reports(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(REPORT_SCHEMA).option("multiLine", multi_line).json(path)


# Fixed value: the published trigger, which no report carries.
TRIGGER_INTERVAL_S = 2.0


def _worst(field: str):
    """The largest reading over the named groups of a report; a missing reading counts as 0. The groups sit in one map."""
    return F.array_max(F.transform(F.map_values("redis_latency"), lambda v: F.coalesce(v[field], F.lit(0.0))))


def report_readings(reports: DataFrame, trigger_interval: float = TRIGGER_INTERVAL_S) -> DataFrame:
    """One column per reading, 0 where the report lacks it."""
    return reports.select(
        "run_id",
        *[F.coalesce(F.col(path).cast("double"), F.lit(0.0)).alias(name) for name, path in _READINGS.items()],
        F.coalesce(_worst("p50_ms"), F.lit(0.0)).alias("redis_p50"),
        F.coalesce(_worst("p99_ms"), F.lit(0.0)).alias("redis_p99"),
        F.lit(trigger_interval).alias("trigger_interval"),
    )


def worst_group_latency(reports: DataFrame) -> DataFrame:
    """Largest p50 and p99 over the named groups of each report that has any; a missing reading counts as 0."""
    return reports.where(F.size("redis_latency") > 0).select("run_id", _worst("p50_ms").alias("p50_ms"), _worst("p99_ms").alias("p99_ms"))
