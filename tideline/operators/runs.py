"""Load-test analysis: runs, ramp levels, bottlenecks, latency percentiles, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tideline.functions import percent, per_second
from tideline.operators.joins import match_keys
from tideline.operators.ranks import p50_index, p95_index, pick_by_index, picked_columns

# ---- fixed values of the load analysis ----
KEEPS_UP = 0.7
SUSTAIN_SHARE = 0.8
SUSTAIN_LEAST = 50
SAFE_TRIGGER_FACTOR = 1.5
# ---- end of fixed values ----

LEVEL = ["run_id", "level"]


def bottleneck_stage(target: Column, injected: Column, log_rate: Column) -> Column:
    """Which stage fell behind: the load itself, the log, or the processing after it."""
    return (
        F.when(injected < target * KEEPS_UP, "mysql_inject")
        .when((log_rate > 0) & (log_rate < injected * KEEPS_UP), "debezium_or_kafka")
        .otherwise("spark_or_mongo")
    )


def sustained_target(max_passing: Column) -> Column:
    share = F.floor(F.coalesce(max_passing, F.lit(0.0)) * SUSTAIN_SHARE).cast("bigint")
    return F.greatest(F.lit(SUSTAIN_LEAST).cast("bigint"), share)


def failed() -> Column:
    return (F.col("lag_remaining") > 0) | ~F.col("synced")


def first_bottleneck(levels: DataFrame) -> DataFrame:
    """First failing level of each run; a ramp stops there."""
    worst = levels.where(failed())
    first = F.struct("level", "target_tps", "e2e_tps", "lag_remaining", "inject_tps", "kafka_rate_avg")
    picked = worst.groupBy("run_id").agg(F.min_by(first, "level").alias("f"))
    return picked.select(
        "run_id",
        F.col("f.level").alias("level"),
        F.col("f.target_tps").alias("at_tps"),
        F.col("f.e2e_tps").alias("e2e_tps"),
        bottleneck_stage(F.col("f.target_tps"), F.col("f.inject_tps"), F.col("f.kafka_rate_avg")).alias("stage"),
        F.col("f.lag_remaining").alias("lag"),
    )


def ramp_levels(levels: DataFrame) -> DataFrame:
    """Levels up to and with the first failing one. Runs have few levels each."""
    upto = Window.partitionBy("run_id").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    failures = F.coalesce(F.sum(failed().cast("int")).over(upto), F.lit(0))
    return levels.withColumn("failures_before", failures).where("failures_before = 0").drop("failures_before")


def max_passing(levels: DataFrame) -> DataFrame:
    """Best end-to-end rate before the first failing level, and the load to hold it at."""
    passing = F.when(~failed(), F.col("e2e_tps"))
    best = F.coalesce(F.max(passing), F.lit(0.0))
    return (
        ramp_levels(levels)
        .groupBy("run_id")
        .agg(best.alias("max_e2e_tps"), F.max("level").alias("last_level"))
        .withColumn("sustained_tps", sustained_target(F.col("max_e2e_tps")))
    )


def best_run(levels: DataFrame) -> DataFrame:
    """Fastest level of each run (the earlier one on a tie) and the slowest rate."""
    fastest = F.max_by(F.struct("level", "e2e_tps"), F.struct(F.col("e2e_tps"), -F.col("level")))
    return (
        levels.groupBy("run_id")
        .agg(fastest.alias("b"), F.min("e2e_tps").alias("worst_tps"))
        .select("run_id", F.col("b.level").alias("best_level"), F.col("b.e2e_tps").alias("best_tps"), "worst_tps")
    )


def latency_percentiles(runs: DataFrame, groups: list[str], records: int) -> DataFrame:
    """p50, p95 and whole-number mean of finished runs per configuration; NULL time is a timeout.

    ``runs`` has ``e2e_ms``. A configuration where every run timed out keeps its row.
    """
    counts = runs.groupBy(*groups).agg(
        F.count("e2e_ms").cast("bigint").alias("runs"),
        F.count_if(F.col("e2e_ms").isNull()).cast("bigint").alias("timeouts"),
        F.sum("e2e_ms").cast("bigint").alias("total_ms"),
    )
    picked = pick_by_index(
        runs, groups, "e2e_ms", {"p50_ms": p50_index(F.col("n")), "p95_ms": p95_index(F.col("n"))}
    )
    wide = picked_columns(picked, groups, ["p50_ms", "p95_ms"])
    avg = F.expr("total_ms div nullif(runs, 0)").cast("bigint")
    per_run = F.lit(records * 1000).cast("double")
    return match_keys(counts, wide, groups, "left").select(
        *groups,
        "p50_ms",
        "p95_ms",
        avg.alias("avg_ms"),
        (F.col("p50_ms") / 1000).cast("double").alias("p50_s"),
        F.round(per_run / F.nullif(F.col("p50_ms"), F.lit(0)), 2).alias("tps_p50"),
        "runs",
        "timeouts",
    )


def batch_p95(batches: DataFrame, groups: list[str], value: str) -> DataFrame:
    picked = pick_by_index(batches.where(F.col(value) > 0), groups, value, {"p95": p95_index(F.col("n"))})
    return picked.select(*groups, F.col("picked").alias("p95"))


def min_safe_trigger(batches: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Shortest trigger that a batch of p95 length leaves some room in."""
    factor = F.lit(SAFE_TRIGGER_FACTOR)
    return batch_p95(batches, groups, value).select(
        *groups, "p95", (F.col("p95").cast("double") * factor).alias("min_trigger_ms")
    )


def level_results(samples: DataFrame, readings: DataFrame) -> DataFrame:
    """One row per ramp level from its rate samples and its batch readings.

    ``samples``: run_id, level, kafka_rate, mongo_rate per sampling step.
    ``readings``: run_id, level, target_tps, ts_us, spark_ms, stored (is the record in the
    source), arrived (did it reach the target in time), drain_s. Rates are per second.
    """

    def mean_positive(c: str) -> Column:
        positive = F.when(F.col(c) > 0, F.col(c))
        mean = F.sum(positive).cast("double") / F.nullif(F.count(positive), F.lit(0))
        return F.coalesce(F.round(mean, 1), F.lit(0.0))

    rates = samples.groupBy(*LEVEL).agg(
        mean_positive("kafka_rate").alias("kafka_rate_avg"),
        mean_positive("mongo_rate").alias("mongo_rate_avg"),
        F.count(F.lit(1)).cast("bigint").alias("samples_count"),
    )
    span_s = (F.max("ts_us") - F.min("ts_us")).cast("double") / 1_000_000
    totals = readings.groupBy(*LEVEL).agg(
        F.max("target_tps").alias("target_tps"),
        F.count(F.lit(1)).cast("bigint").alias("records_inserted"),
        F.count_if("stored").cast("bigint").alias("mysql_delta"),
        F.count_if("arrived").cast("bigint").alias("mongo_delta"),
        span_s.alias("inject_s"),
        F.max("drain_s").cast("double").alias("drain_s"),
        mean_positive("spark_ms").alias("spark_batch_avg_ms"),
    )
    p95 = batch_p95(readings, LEVEL, "spark_ms").withColumnRenamed("p95", "spark_batch_p95_ms")
    joined = totals.join(rates, LEVEL, "left").join(p95, LEVEL, "left")
    return joined.select(
        *LEVEL,
        "target_tps",
        "records_inserted",
        "mysql_delta",
        "mongo_delta",
        lag_remaining(F.col("mysql_delta"), F.col("mongo_delta")).alias("lag_remaining"),
        (F.col("mongo_delta") >= F.col("mysql_delta")).alias("synced"),
        F.round("inject_s", 1).alias("inject_elapsed_s"),
        F.round("drain_s", 1).alias("drain_elapsed_s"),
        F.round(F.col("inject_s") + F.col("drain_s"), 1).alias("total_elapsed_s"),
        per_second(F.col("records_inserted"), F.col("inject_s")).alias("inject_tps"),
        per_second(F.col("mongo_delta"), F.col("inject_s") + F.col("drain_s")).alias("e2e_tps"),
        "spark_batch_avg_ms",
        F.coalesce(F.col("spark_batch_p95_ms").cast("double"), F.lit(0.0)).alias("spark_batch_p95_ms"),
        "kafka_rate_avg",
        "mongo_rate_avg",
        "samples_count",
    )


def lag_remaining(source_delta: Column, target_delta: Column) -> Column:
    return source_delta - target_delta


def sync_rate(synced: Column, sent: Column) -> Column:
    return percent(synced, sent)


def run_report(levels: DataFrame, sustained: DataFrame) -> DataFrame:
    """Nested report per run: configured levels, the ramp in level order, the test at a held rate and the summary.

    ``sustained`` has the columns of ``levels`` and at most one row per run.
    """
    ramp = ramp_levels(levels)
    entry = F.struct("level", *[c for c in ramp.columns if c not in LEVEL])
    # A run has as many entries as its configuration has levels.
    ramps = ramp.groupBy("run_id").agg(F.array_sort(F.collect_list(entry)).alias("ramp_up"))
    planned = levels.groupBy("run_id").agg(F.array_sort(F.collect_list("target_tps")).alias("tps_levels"))
    held = sustained.select("run_id", F.struct(*[c for c in sustained.columns if c not in LEVEL]).alias("sustained"))
    summary = max_passing(levels)
    broken = first_bottleneck(levels).select(
        "run_id", F.struct("at_tps", "e2e_tps", "stage", "lag").alias("bottleneck")
    )
    joined = ramps.join(summary, ["run_id"]).join(planned, ["run_id"]).join(held, ["run_id"], "left").join(broken, ["run_id"], "left")
    return joined.select(
        "run_id",
        F.struct("tps_levels", F.col("sustained_tps").alias("sustained_target_tps")).alias("config"),
        "ramp_up",
        "sustained",
        F.struct(
            "max_e2e_tps", F.col("bottleneck").isNotNull().alias("bottleneck_detected"), "bottleneck"
        ).alias("summary"),
    )


def purge(rows: DataFrame, doomed: Column) -> DataFrame:
    """Rows left after deleting those the predicate is true for; NULL deletes nothing."""
    return rows.where(~F.coalesce(doomed, F.lit(False)))
