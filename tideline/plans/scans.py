"""Sources: offsets, snapshots, allow-lists, counts, texts, reports, seeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.operators.envelope import changes, parse_events
from tideline.operators.gauges import REPORT_GAUGES, report_gauges
from tideline.operators.reconcile import table_counts
from tideline.operators.state import ORDER_VALUES, latest_of, latest_per_key, live_rows, order_documents
from tideline.operators.timeseries import last_reading
from tideline.plans import logs
from tideline.plans.logs import CUSTOMER_CTE, CUSTOMER_LATEST_CTE, ORDER_CTE, ORDER_LATEST_CTE
from tideline.schema import CUSTOMERS, ORDERS
from tideline.session import new_folder
from tideline.sources import feed
from tideline.sources.log import end_offsets, from_offsets, subscribe, topic_end_offsets
from tideline.sources.metrics_text import scan_metric_text
from tideline.sources.reports import read_reports, report_readings, worst_group_latency
from tideline.sources.seed import replace_rows, seed_customers, seed_orders


def src_from_offset(spark, sf_dir):
    """Skip the older half of each partition's offsets."""
    log = logs.orders_log(spark, sf_dir)
    starts = end_offsets(log).select(
        "topic", "partition", F.expr("end_offset div 2").alias("start_offset")
    )
    later = from_offsets(log, starts)
    return parse_events(later, keep=("topic", "partition", "offset")).select("topic", "partition", "offset", "op")


def src_snapshot_plus_changes(spark, sf_dir):
    """Snapshot reads of the whole table, then its updates and deletes."""
    table = logs.order_table(spark, sf_dir)
    later = logs.order_events(spark, sf_dir).where(F.col("op") != "c")
    events = feed.to_log(later).unionByName(feed.to_log(feed.snapshot_changes(table, ORDERS)))
    return order_documents(latest_of(changes(events), ORDERS, ORDER_VALUES))


def src_table_allowlist(spark, sf_dir):
    followed = subscribe(logs.every_topic_log(spark, sf_dir), [CUSTOMERS, ORDERS])
    return followed.groupBy("topic").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def union_topics(spark, sf_dir):
    """Several topics as one relation."""
    return logs.both_changes(spark, sf_dir, with_order=False).select("table", "op", "id")


def count_source(spark, sf_dir):
    return table_counts(
        {CUSTOMERS: logs.customer_table(spark, sf_dir), ORDERS: logs.order_table(spark, sf_dir)}, "n"
    )


def count_state(spark, sf_dir):
    latest = latest_per_key(logs.both_changes(spark, sf_dir), ["op"])
    return live_rows(latest).groupBy("table").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def offsets_by_topic(spark, sf_dir):
    return topic_end_offsets(logs.both_log(spark, sf_dir))


def written_reports(spark, sf_dir):
    """One JSON report per day of events, with whatever that day lacks left out."""
    events = logs.readings(spark, sf_dir).withColumn("run_id", F.date_format("ts", "yyyy-MM-dd"))
    value = F.col("value").cast("double")
    per_name = events.groupBy("run_id", "name").agg(
        F.min(value).alias("p50_ms"), F.max(F.when(value > 250, value)).alias("p99_ms")
    )
    # Groups of a report are metric names, already one row each.
    groups = per_name.groupBy("run_id").agg(
        F.map_from_entries(F.collect_list(F.struct("name", F.struct("p50_ms", "p99_ms")))).alias("redis_latency")
    )
    in_time = F.count_if(value <= 300)
    whole = events.groupBy("run_id").agg(
        F.struct(
            F.min(F.when(F.col("name") == "view", value)).alias("p50_s"),
            F.max(F.when(F.col("name") == "view", value)).alias("p95_s"),
            F.max(F.when(value > 400, value)).alias("p99_s"),
            F.round(F.sum("value").cast("double") / F.count(F.lit(1)), 3).alias("avg_s"),
        ).alias("latency"),
        F.struct(
            F.count(F.lit(1)).cast("double").alias("e2e_tps"),
            in_time.cast("double").alias("mysql_tps"),
        ).alias("throughput_baseline"),
        F.struct(F.count_if(F.col("name") == "click").cast("bigint").alias("spark_workers")).alias("config"),
        F.when(
            F.count_if(F.col("name") == "view") > F.count_if(F.col("name") == "click"),
            F.struct(
                F.count_if(F.col("name") == "click").cast("double").alias("baseline_tps"),
                F.count_if(F.col("name") == "view").cast("double").alias("scaled_tps"),
                F.max(F.when(F.col("name") == "click", value)).alias("baseline_p95_s"),
            ),
        ).alias("comparison"),
    )
    path = new_folder(spark, "reports")
    whole.join(groups, ["run_id"]).write.json(path)
    return read_reports(spark, path)


def report_scan(spark, sf_dir):
    return report_readings(written_reports(spark, sf_dir))


def gauge_history(spark, sf_dir):
    """Benchmark and scaling gauges of every day's report, each taken at the start of its day."""
    readings = report_readings(written_reports(spark, sf_dir))
    return report_gauges(readings, F.to_timestamp_ntz("run_id", F.lit("yyyy-MM-dd")))


def gauge_last(spark, sf_dir):
    """The newest value of each of these gauges."""
    return last_reading(gauge_history(spark, sf_dir)).select("name", "value")


def worst_latency(spark, sf_dir):
    return worst_group_latency(written_reports(spark, sf_dir))


def metrics_text_scan(spark, sf_dir):
    """Readings written as exposition text, with comments and broken lines among those of every name."""
    events = logs.readings(spark, sf_dir)
    spoilt = F.col("event_id") % 7
    line = (
        F.when(spoilt == 0, F.concat(F.lit("# TYPE cdc_"), F.col("name"), F.lit(" gauge "), F.col("value").cast("string")))
        .when(spoilt == 1, F.concat(F.lit("cdc_"), F.col("name"), F.lit(" n/a")))
        .when(spoilt == 2, F.concat(F.lit("cdc_"), F.col("name"), F.lit(" {k} "), F.col("value").cast("string")))
        .otherwise(F.concat(F.lit("cdc_"), F.col("name"), F.lit(" "), F.col("value").cast("string")))
    )
    path = new_folder(spark, "metrics")
    events.select(line.alias("value")).write.text(path)
    return scan_metric_text(spark, path)


def seed_rows(spark, sf_dir):
    """Seed customers take the place of table rows with their keys."""
    table = logs.customer_table(spark, sf_dir)
    return replace_rows(table, seed_customers(spark)).select("id", "name", "email", "phone")


def seed_order_rows(spark, sf_dir):
    table = logs.order_table(spark, sf_dir).drop("order_date")
    return replace_rows(table, seed_orders(spark))


QUERIES = {
    "src_from_offset": src_from_offset,
    "src_snapshot_plus_changes": src_snapshot_plus_changes,
    "src_table_allowlist": src_table_allowlist,
    "union_topics": union_topics,
    "count_source": count_source,
    "count_state": count_state,
    "topic_end_offsets": offsets_by_topic,
    "report_scan": report_scan,
    "gauge_history": gauge_history,
    "gauge_last": gauge_last,
    "worst_group_latency": worst_latency,
    "metrics_text_scan": metrics_text_scan,
    "seed_rows": seed_rows,
    "seed_order_rows": seed_order_rows,
}

_DAY = "strftime(ts, '%Y-%m-%d')"
_WORST = f"""
select run_id, max(a) as p50_ms, max(b) as p99_ms from (
  select {_DAY} as run_id, event_type, min(value) a, coalesce(max(value) filter (value > 250), 0) b from events group by 1, 2) group by 1"""

ORACLE = {
    "src_from_offset": f"""
with {ORDER_CTE}, ends as (select id%3 p, max(off)+1 e from oe group by 1)
select 'inventory.inventory.orders' as topic, cast(p as integer) as partition, off as offset, op
from oe join ends on oe.id%3 = ends.p where off >= e//2""",
    "src_snapshot_plus_changes": f"""
with {ORDER_LATEST_CTE}
select id as _id, cid as customer_id, amt as total_amount, st as status from ol where op <> 'd'""",
    "src_table_allowlist": f"""
with {ORDER_CTE}, {CUSTOMER_CTE}
select 'inventory.inventory.orders' as topic, count(*) as n from oe
union all select 'inventory.inventory.customers', count(*) from ce""",
    "union_topics": f"""
with {ORDER_CTE}, {CUSTOMER_CTE}
select 'orders' as "table", op, id from oe union all select 'customers', op, id from ce""",
    "count_source": """
select 'customers' as "table", count(*) as n from customer union all select 'orders', count(*) from orders""",
    "count_state": f"""
with {ORDER_LATEST_CTE}, {CUSTOMER_LATEST_CTE}
select 'customers' as "table", count(*) as n from cl where op <> 'd'
union all select 'orders', count(*) from ol where op <> 'd'""",
    "topic_end_offsets": f"""
with {ORDER_CTE}, {CUSTOMER_CTE}, a as (
  select 'inventory.inventory.orders' as topic, id%3 p, max(off)+1 e from oe group by 1, 2
  union all select 'inventory.inventory.customers', id%3, max(off)+1 from ce group by 1, 2)
select topic, cast(sum(e) as bigint) as end_offset, count(*) as partitions from a group by 1""",
    "report_scan": f"""
with a as (
select {_DAY} as run_id,
  coalesce(min(value) filter (event_type='view'), 0) as latency_p50,
  coalesce(max(value) filter (event_type='view'), 0) as latency_p95,
  coalesce(max(value) filter (value > 400), 0) as latency_p99,
  round(cast(sum(cast(value as decimal(18,2))) as double) / count(*), 3) as latency_avg,
  cast(count(*) as double) as throughput_e2e,
  cast(count(*) filter (value <= 300) as double) as throughput_mysql,
  cast(0 as double) as sync_rate_pct, cast(0 as double) as kafka_partitions,
  cast(count(*) filter (event_type='click') as double) as spark_workers,
  cast(case when v > c then c else 0 end as double) as baseline_tps,
  cast(case when v > c then v else 0 end as double) as scaled_tps,
  cast(0 as double) as throughput_improvement_pct,
  case when v > c then coalesce(max(value) filter (event_type='click'), 0) else 0 end as baseline_p95_s,
  cast(0 as double) as scaled_p95_s
from (select *, count(*) filter (event_type='view') over (partition by {_DAY}) v,
             count(*) filter (event_type='click') over (partition by {_DAY}) c from events)
group by 1, v, c),
g as ({_WORST})
select a.*, g.p50_ms as redis_p50, g.p99_ms as redis_p99, cast(2 as double) as trigger_interval from a join g using (run_id)""",
    "worst_group_latency": _WORST,
    "metrics_text_scan": """
select 'cdc_' || event_type as name, cast(cast(value as decimal(18,2)) as double) as value
from events where event_id % 7 > 2""",
    "seed_rows": f"""
with {CUSTOMER_CTE},
s(id, name, email, phone) as (values
  (cast(1 as bigint), 'Nguyễn Văn An', 'an.nguyen@company.com', '0912345678'),
  (2, 'Trần Thị Bích', 'bich.tran@company.com', '0987654321'),
  (3, 'Lê Hoàng Cường', 'cuong.le@company.com', '0978123456'))
select id, nm as name, em as email, '09' || lpad(cast(id as varchar), 8, '0') as phone from cb where id not in (1,2,3)
union all select * from s""",
    "seed_order_rows": f"""
with {ORDER_CTE},
s(id, customer_id, total_amount, status) as (values
  (cast(1 as bigint), cast(1 as bigint), cast(1250000.00 as decimal(12,2)), 'DELIVERED'),
  (2, 1, 850000.00, 'PENDING'), (3, 2, 2450000.00, 'SHIPPED'), (4, 3, 670000.00, 'PROCESSING'))
select id, cid as customer_id, amt as total_amount, st as status from ob where id not in (1,2,3,4)
union all select * from s""",
}

_HISTORY = f"""
with r as ({ORACLE["report_scan"]})
{" union all ".join(
    f"select strptime(run_id, '%Y-%m-%d') as ts, '{gauge}' as name, {column} as value from r" for column, gauge in REPORT_GAUGES.items()
)}"""
ORACLE |= {
    "gauge_history": _HISTORY,
    "gauge_last": f"select name, arg_max(value, ts) as value from ({_HISTORY}) group by name",
}
