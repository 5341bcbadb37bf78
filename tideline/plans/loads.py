"""Load-test analysis: a week of events is a run, a weekday a ramp level.

Recorded time is played faster, so that a day of events is a test of some seconds.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.operators import runs
from tideline.operators.timeseries import to_millis
from tideline.plans import logs
from tideline.plans.metrics import READINGS_CTE
from tideline.session import new_folder

TARGET_STEP = 30.0
FASTER = 36_000
# What one event of a sampling step, an hour of recorded time, adds to a rate per second.
SAMPLE_RATE = FASTER / 3600
LEAST_STORED = 0.1
IN_TIME = 300
TIMEOUT = 200
RECORDS = 100


def _placed(spark, sf_dir):
    readings = logs.readings(spark, sf_dir)
    week = F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd")
    return readings.select(
        week.alias("run_id"),
        (F.weekday("ts") + 1).cast("bigint").alias("level"),
        # The first levels of most weeks are easy: whatever is stored arrives.
        (F.weekday("ts") + 1 <= F.weekofyear("ts") % 4).alias("easy"),
        "name",
        "ts",
        "value",
        F.expr(f"unix_micros(cast(ts as timestamp)) div {FASTER}").alias("ts_us"),
    )


def _levels(spark, sf_dir):
    placed = _placed(spark, sf_dir)
    # On every second level the log falls behind.
    logged = F.when(F.col("level") % 2 == 0, F.col("name") == "click").otherwise(F.col("name") != "signup")
    samples = placed.groupBy("run_id", "level", F.window("ts", "1 hour").alias("w")).agg(
        (F.count_if(logged) * SAMPLE_RATE).cast("double").alias("kafka_rate"),
        (F.count_if(F.col("name") != "error") * SAMPLE_RATE).cast("double").alias("mongo_rate"),
    )
    readings = placed.select(
        "run_id",
        "level",
        (F.col("level") * TARGET_STEP).alias("target_tps"),
        "ts_us",
        F.col("value").alias("spark_ms"),
        (F.col("value") >= LEAST_STORED).alias("stored"),
        ((F.col("value") >= LEAST_STORED) & (F.col("easy") | (F.col("value") <= IN_TIME))).alias("arrived"),
        (F.col("value") / 1000).alias("drain_s"),
    )
    return runs.level_results(samples, readings)


def bench_levels(spark, sf_dir):
    return _levels(spark, sf_dir)


def throughput(spark, sf_dir):
    return _levels(spark, sf_dir).select("run_id", "level", "inject_tps", "e2e_tps")


def sync_rate(spark, sf_dir):
    levels = _levels(spark, sf_dir)
    return levels.select(
        "run_id", "level", runs.sync_rate(F.col("mongo_delta"), F.col("mysql_delta")).alias("sync_rate_pct")
    )


def lag_remaining(spark, sf_dir):
    return _levels(spark, sf_dir).select("run_id", "level", "mysql_delta", "mongo_delta", "lag_remaining", "synced")


def classify_bottleneck(spark, sf_dir):
    levels = _levels(spark, sf_dir)
    stage = runs.bottleneck_stage(F.col("target_tps"), F.col("inject_tps"), F.col("kafka_rate_avg"))
    return levels.where(runs.failed()).select("run_id", "level", stage.alias("stage"))


def first_bottleneck(spark, sf_dir):
    return runs.first_bottleneck(_levels(spark, sf_dir))


def max_passing_tps(spark, sf_dir):
    return runs.max_passing(_levels(spark, sf_dir)).select("run_id", "max_e2e_tps", "last_level")


def sustained_target(spark, sf_dir):
    return runs.max_passing(_levels(spark, sf_dir)).select("run_id", "sustained_tps")


def best_run(spark, sf_dir):
    return runs.best_run(_levels(spark, sf_dir))


def latency_percentiles(spark, sf_dir):
    """Per event type; readings above the time limit are timeouts."""
    readings = logs.readings(spark, sf_dir)
    e2e = F.when(F.col("value") <= TIMEOUT, (F.col("value") * 100).cast("bigint"))
    return runs.latency_percentiles(readings.select("name", e2e.alias("e2e_ms")), ["name"], RECORDS)


def latency_millis(spark, sf_dir):
    """Seconds shown as milliseconds."""
    readings = logs.readings(spark, sf_dir)
    return readings.select("event_id", to_millis(F.col("value")).cast("decimal(38,2)").alias("ms"))


def min_safe_trigger(spark, sf_dir):
    return runs.min_safe_trigger(logs.readings(spark, sf_dir), ["name"], "value")


def bench_report(spark, sf_dir):
    """Nested reports through JSON files and back, one row per ramp entry."""
    levels = _levels(spark, sf_dir)
    report = runs.run_report(levels, levels.where("level = 1"))
    path = new_folder(spark, "report")
    report.write.json(path)
    back = spark.read.schema(report.schema).json(path)
    return back.select(
        "run_id",
        F.col("config.sustained_target_tps").alias("sustained_tps"),
        F.col("summary.max_e2e_tps").alias("max_e2e_tps"),
        F.col("summary.bottleneck_detected").alias("bottleneck_detected"),
        F.col("summary.bottleneck.stage").alias("stage"),
        F.array_max("config.tps_levels").alias("top_level_tps"),
        F.col("sustained.e2e_tps").alias("held_tps"),
        F.explode("ramp_up").alias("r"),
    ).select(
        "run_id", "sustained_tps", "max_e2e_tps", "bottleneck_detected", "stage", "top_level_tps", "held_tps",
        F.col("r.level").alias("level"), F.col("r.e2e_tps").alias("e2e_tps"),
        F.col("r.spark_batch_p95_ms").alias("spark_batch_p95_ms"), F.col("r.samples_count").alias("samples_count"),
    )


QUERIES = {
    "bench_levels": bench_levels,
    "throughput": throughput,
    "sync_rate": sync_rate,
    "lag_remaining": lag_remaining,
    "classify_bottleneck": classify_bottleneck,
    "first_bottleneck": first_bottleneck,
    "max_passing_tps": max_passing_tps,
    "sustained_target": sustained_target,
    "best_run": best_run,
    "latency_percentiles": latency_percentiles,
    "latency_millis": latency_millis,
    "min_safe_trigger": min_safe_trigger,
    "bench_report": bench_report,
}

_LEVELS = f"""
{READINGS_CTE},
p as (select strftime(date_trunc('week', ts), '%Y-%m-%d') run_id, isodow(ts) as level,
             isodow(ts) <= week(ts) % 4 as easy, name, ts, value from r),
h as (select run_id, level, date_trunc('hour', ts) hr,
             count(*) filter (case when level % 2 = 0 then name = 'click' else name <> 'signup' end) * {SAMPLE_RATE}::double k,
             count(*) filter (name <> 'error') * {SAMPLE_RATE}::double m from p group by 1, 2, 3),
s as (select run_id, level, coalesce(round(sum(k) filter (k > 0) / count(*) filter (k > 0), 1), 0) ka,
             coalesce(round(sum(m) filter (m > 0) / count(*) filter (m > 0), 1), 0) ma, count(*) sc from h group by 1, 2),
q as (select run_id, level, value, row_number() over (partition by run_id, level order by value) - 1 i,
             count(*) over (partition by run_id, level) n from p where value > 0),
q95 as (select run_id, level, cast(max(value) as double) p95 from q where i = least(n * 95 // 100, n - 1) group by 1, 2),
t as (select run_id, level, count(*) ins, count(*) filter (value >= {LEAST_STORED}) sto,
             count(*) filter (value >= {LEAST_STORED} and (easy or value <= {IN_TIME})) del,
             cast(epoch_us(max(ts)) // {FASTER} - epoch_us(min(ts)) // {FASTER} as double) / 1000000 inj,
             cast(max(value) / 1000 as double) dr,
             coalesce(round(cast(sum(value) filter (value > 0) as double) / count(*) filter (value > 0), 1), 0) av
      from p group by 1, 2),
l as (select t.run_id, t.level, cast(t.level * {TARGET_STEP} as double) as target_tps, ins as records_inserted, sto as mysql_delta,
        del as mongo_delta, sto - del as lag_remaining, del >= sto as synced,
        round(inj, 1) as inject_elapsed_s, round(dr, 1) as drain_elapsed_s, round(inj + dr, 1) as total_elapsed_s,
        case when inj > 0 then round(ins / inj, 1) else 0 end as inject_tps,
        case when inj + dr > 0 then round(del / (inj + dr), 1) else 0 end as e2e_tps,
        av as spark_batch_avg_ms, coalesce(p95, 0) as spark_batch_p95_ms, ka as kafka_rate_avg,
        ma as mongo_rate_avg, sc as samples_count
      from t join s using (run_id, level) left join q95 using (run_id, level))
"""
_STAGE = """case when inject_tps < target_tps * 0.7 then 'mysql_inject'
  when kafka_rate_avg > 0 and kafka_rate_avg < inject_tps * 0.7 then 'debezium_or_kafka' else 'spark_or_mongo' end"""
_RAMP = f"""
{_LEVELS},
f as (select run_id, min(level) fl from l where lag_remaining > 0 or not synced group by 1),
ramp as (select l.*, fl from l left join f using (run_id) where fl is null or level <= fl),
mx as (select run_id, coalesce(max(e2e_tps) filter (fl is null or level < fl), 0) as max_e2e_tps,
              max(level) as last_level from ramp group by 1)
"""

ORACLE = {
    "bench_levels": f"with {_LEVELS} select * from l",
    "throughput": f"with {_LEVELS} select run_id, level, inject_tps, e2e_tps from l",
    "sync_rate": f"""
with {_LEVELS}
select run_id, level, round(cast(mongo_delta as double) / mysql_delta * 100, 1) as sync_rate_pct from l""",
    "lag_remaining": f"with {_LEVELS} select run_id, level, mysql_delta, mongo_delta, lag_remaining, synced from l",
    "classify_bottleneck": f"""
with {_LEVELS} select run_id, level, {_STAGE} as stage from l where lag_remaining > 0 or not synced""",
    "first_bottleneck": f"""
with {_RAMP}
select run_id, level, target_tps as at_tps, e2e_tps, {_STAGE} as stage, lag_remaining as lag from ramp where level = fl""",
    "max_passing_tps": f"with {_RAMP} select run_id, max_e2e_tps, last_level from mx",
    "sustained_target": f"""
with {_RAMP} select run_id, greatest(50, cast(floor(max_e2e_tps * 0.8) as bigint)) as sustained_tps from mx""",
    "best_run": f"""
with {_LEVELS}, o as (select *, row_number() over (partition by run_id order by e2e_tps desc, level) rn from l)
select run_id, max(level) filter (rn = 1) as best_level, max(e2e_tps) as best_tps, min(e2e_tps) as worst_tps
from o group by 1""",
    "latency_percentiles": f"""
with {READINGS_CTE},
e as (select name, case when value <= {TIMEOUT} then cast(value * 100 as bigint) end ms from r),
o as (select name, ms, row_number() over (partition by name order by ms) - 1 i, count(*) over (partition by name) n
      from e where ms is not null),
k as (select name, max(ms) filter (i = n // 2) p50, max(ms) filter (i = least(n * 95 // 100, n - 1)) p95,
             cast(sum(ms) as bigint) // count(*) a, count(*) n from o group by 1),
z as (select name, count(*) filter (ms is null) z from e group by 1)
select name, p50 as p50_ms, p95 as p95_ms, cast(a as bigint) as avg_ms, cast(p50 as double) / 1000 as p50_s,
       round(cast({RECORDS * 1000} as double) / p50, 2) as tps_p50, coalesce(n, 0) as runs, z as timeouts
from z left join k using (name)""",
    "latency_millis": f"""
with {READINGS_CTE} select event_id, cast(value * 1000 as decimal(38,2)) as ms from r""",
    "min_safe_trigger": f"""
with {READINGS_CTE},
o as (select name, value, row_number() over (partition by name order by value) - 1 i,
             count(*) over (partition by name) n from r where value > 0)
select name, value as p95, cast(value as double) * 1.5 as min_trigger_ms from o where i = least(n * 95 // 100, n - 1)""",
    "bench_report": f"""
with {_RAMP}, b as (select run_id, {_STAGE} as stage from ramp where level = fl)
select run_id, greatest(50, cast(floor(max_e2e_tps * 0.8) as bigint)) as sustained_tps, max_e2e_tps,
       b.stage is not null as bottleneck_detected, b.stage, level, ramp.e2e_tps, spark_batch_p95_ms, samples_count,
       top_level_tps, held_tps
from ramp join mx using (run_id) left join b using (run_id)
join (select run_id, max(target_tps) as top_level_tps from l group by 1) using (run_id)
left join (select run_id, e2e_tps as held_tps from l where level = 1) using (run_id)""",
}
