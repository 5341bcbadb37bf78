"""Metric readings over time, taken from the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.operators import timeseries as series
from tideline.operators.ranks import p50_index, p95_index, pick_by_index, picked_columns
from tideline.plans import logs

_RATE_COLUMNS = ("event_id", "name", "rate")


def _rate(spark, sf_dir, seconds):
    rated = series.trailing_rate(logs.readings(spark, sf_dir), seconds, tie="event_id")
    return rated.select(*_RATE_COLUMNS)


def rate_30s(spark, sf_dir):
    return _rate(spark, sf_dir, 30)


def rate_1h(spark, sf_dir):
    return _rate(spark, sf_dir, 3600)


def rate_extrapolated(spark, sf_dir):
    """Rates of an hour carried on to the edges of the window, as the dashboards' engine does."""
    rated = series.extrapolated_rate(logs.readings(spark, sf_dir), 3600, tie="event_id")
    return rated.select(*_RATE_COLUMNS)


def last_reading(spark, sf_dir):
    return series.last_reading(logs.readings(spark, sf_dir))


def recent_range(spark, sf_dir):
    return series.recent(logs.readings(spark, sf_dir), "15 minutes").select("event_id", "name", "value")


def recent_day(spark, sf_dir):
    return series.recent(logs.readings(spark, sf_dir), "1 day").select("event_id", "name", "value")


def resample(spark, sf_dir):
    return series.resample(logs.readings(spark, sf_dir), "1 hour")


def resample_5s(spark, sf_dir):
    return series.resample(logs.readings(spark, sf_dir), "5 seconds")


def sample_stats(spark, sf_dir):
    return series.sample_stats(logs.readings(spark, sf_dir), ["name"])


def p95_by_index(spark, sf_dir):
    picked = pick_by_index(
        logs.readings(spark, sf_dir),
        ["name"],
        "value",
        {"p50": p50_index(F.col("n")), "p95": p95_index(F.col("n"))},
    )
    return picked_columns(picked, ["name"], ["p50", "p95"])


# Which metric each event type stands for.
METRIC_OF = {
    "click": "latency_p50_s",
    "view": "latency_p99_s",
    "purchase": "throughput_tps",
    "signup": "read_p99_ms",
    "error": "sync_rate_pct",
}


def health_bands(spark, sf_dir):
    readings = logs.readings(spark, sf_dir)
    metric = F.coalesce(*[F.when(F.col("name") == e, m) for e, m in METRIC_OF.items()])
    named = readings.withColumn("name", metric)
    return series.in_bands(named, series.bands(spark)).select("event_id", "name", "value", "band")


QUERIES = {
    "rate_30s": rate_30s,
    "rate_1h": rate_1h,
    "rate_extrapolated": rate_extrapolated,
    "last_reading": last_reading,
    "recent_range": recent_range,
    "recent_day": recent_day,
    "resample": resample,
    "resample_5s": resample_5s,
    "sample_stats": sample_stats,
    "p95_index": p95_by_index,
    "health_bands": health_bands,
}

READINGS_CTE = """
r as (select event_id, event_type as name, ts, cast(value as decimal(18,2)) as value from events)
"""


def _rate_sql(seconds: int) -> str:
    return f"""
with {READINGS_CTE},
p as (select *, lag(value) over (partition by name order by ts, event_id) prev from r),
i as (select *, case when prev is null then 0 when value < prev then value else value - prev end inc from p)
select event_id, name, cast(sum(inc) over (partition by name order by ts
  range between interval {seconds} seconds preceding and current row) as double) / {seconds} as rate from i"""


def _extrapolated_sql(seconds: int) -> str:
    return f"""
with {READINGS_CTE},
p as (select *, lag(value) over (partition by name order by ts, event_id) prev from r),
i as (select *, epoch_us(ts) as us, case when prev is null then 0 when value < prev then value else value - prev end inc from p),
w as (select event_id, name, count(*) over w as n, sum(inc) over w - first_value(inc) over w as up, first_value(value) over w as v0,
             us, first_value(us) over w as us0 from i
      window w as (partition by name order by ts range between interval {seconds} seconds preceding and current row)),
d as (select event_id, name, n, cast(up as double) as up, cast(v0 as double) as v0, (us - us0) / 1e6::double as sampled,
             (us0 - (us - {seconds * 1_000_000})) / 1e6::double as gap0 from w),
e as (select *, case when gap0 >= sampled / (n - 1) * 1.1::double then sampled / (n - 1) * 0.5::double else gap0 end as filled,
             case when up > 0 and v0 >= 0 then sampled * (v0 / up) end as to_zero from d where n >= 2 and sampled > 0)
select d.event_id, d.name, e.up * ((e.sampled + least(e.filled, e.to_zero)) / e.sampled / {seconds}::double) as rate
from d left join e using (event_id)"""


def _resample_sql(step: str) -> str:
    return f"""
with {READINGS_CTE}
select name, time_bucket(interval {step}, ts) as step_start, arg_max(value, ts) as value from r group by 1, 2"""


ORACLE = {
    "rate_30s": _rate_sql(30),
    "rate_1h": _rate_sql(3600),
    "rate_extrapolated": _extrapolated_sql(3600),
    "last_reading": f"with {READINGS_CTE} select name, arg_max(value, ts) as value, max(ts) as ts from r group by name",
    "recent_range": f"""
with {READINGS_CTE}
select event_id, name, value from r where ts >= (select max(ts) from r) - interval 15 minutes""",
    "recent_day": f"""
with {READINGS_CTE} select event_id, name, value from r where ts >= (select max(ts) from r) - interval 1 day""",
    "resample": _resample_sql("1 hour"),
    "resample_5s": _resample_sql("5 seconds"),
    "sample_stats": f"""
with {READINGS_CTE}
select name, round(cast(sum(value) as double) / count(*), 3) as mean_value, cast(min(value) as double) as min_value,
       cast(max(value) as double) as max_value, count(*) as n from r where value > 0 group by name""",
    "p95_index": f"""
with {READINGS_CTE},
o as (select name, value, row_number() over (partition by name order by value) - 1 i,
             count(*) over (partition by name) n from r)
select name, max(value) filter (i = n // 2) as p50, max(value) filter (i = least(n * 95 // 100, n - 1)) as p95
from o group by name""",
    "health_bands": f"""
with {READINGS_CTE}
select event_id,
  case name when 'click' then 'latency_p50_s' when 'view' then 'latency_p99_s' when 'purchase' then 'throughput_tps'
            when 'signup' then 'read_p99_ms' else 'sync_rate_pct' end as name, value,
  case name
    when 'click' then case when value >= 6 then 'red' when value >= 3 then 'yellow' else 'green' end
    when 'view' then case when value >= 8 then 'red' when value >= 5 then 'yellow' else 'green' end
    when 'purchase' then case when value >= 40 then 'green' when value >= 20 then 'yellow' else 'red' end
    when 'signup' then case when value >= 3 then 'red' when value >= 1 then 'yellow' else 'green' end
    else case when value >= 100 then 'green' when value >= 90 then 'yellow' else 'red' end end as band
from r""",
}
