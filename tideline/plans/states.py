"""Documents, hashes, deletes, truncates, cascades, reconciliation, purges."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.operators.counters import COUNTER, SCORE, deltas
from tideline.operators.envelope import changes, parse_events
from tideline.operators.gauges import gauges
from tideline.operators.reconcile import (
    all_in_sync,
    both_readable,
    reconcile_counts,
    reconcile_ranges,
    reconcile_rows,
    stored_counts,
    table_counts,
)
from tideline.operators.runs import purge
from tideline.operators.state import (
    CUSTOMER_VALUES,
    ORDER_VALUES,
    cascade_deletes,
    customer_documents,
    customer_hashes,
    deleted_keys,
    latest_of,
    latest_per_key,
    live_rows,
    order_documents,
    orphans,
    survive_truncates,
)
from tideline.operators.timeseries import sync_text
from tideline.plans import logs
from tideline.plans.logs import CUSTOMER_CTE, CUSTOMER_LATEST_CTE, ORDER_CTE, ORDER_LATEST_CTE, masked
from tideline.rules import Rules
from tideline.schema import CUSTOMERS, ORDERS
from tideline.session import cut_lineage, new_folder
from tideline.sources import feed
from tideline.sources.log import topic_end_offsets
from tideline.streaming.tables import StateTables

PYTHON, SCALA = Rules.python_job(), Rules.scala_job()
PURGE_FROM_ID = 1_000
TRUNCATED_AT = "1998-01-01 00:00:00"


def doc_state_orders(spark, sf_dir):
    return order_documents(latest_of(logs.order_changes(spark, sf_dir), ORDERS, ORDER_VALUES))


def doc_state_customers(spark, sf_dir):
    return customer_documents(latest_of(logs.customer_changes(spark, sf_dir), CUSTOMERS, CUSTOMER_VALUES))


def doc_state_orders_python(spark, sf_dir):
    """Deletes leave the before-image in the store."""
    return order_documents(latest_of(logs.order_changes(spark, sf_dir), ORDERS, ORDER_VALUES), PYTHON)


def doc_state_customers_python(spark, sf_dir):
    return customer_documents(latest_of(logs.customer_changes(spark, sf_dir), CUSTOMERS, CUSTOMER_VALUES), PYTHON)


def doc_state_orders_scala(spark, sf_dir):
    """Amounts as doubles."""
    latest = latest_of(changes(logs.orders_log(spark, sf_dir), SCALA), ORDERS, ORDER_VALUES)
    return order_documents(latest, SCALA)


def doc_delete(spark, sf_dir):
    return deleted_keys(latest_per_key(logs.both_changes(spark, sf_dir), ["op"]))


def kv_customer_hash(spark, sf_dir):
    return customer_hashes(latest_of(logs.customer_changes(spark, sf_dir), CUSTOMERS, CUSTOMER_VALUES))


def latest_change(spark, sf_dir):
    latest = latest_per_key(logs.both_changes(spark, sf_dir), ["op", "ord"])
    return latest.select("table", "id", "op", F.col("ord.offset").alias("offset"))


def merged_state(spark, sf_dir):
    """Updates and deletes on top of the stored, folded state that the creates left."""
    flat = logs.both_changes(spark, sf_dir)
    tables = StateTables.at(spark, new_folder(spark, "merged"))
    for batch, part in enumerate((F.col("op") == "c", F.col("op") != "c")):
        changed = flat.where(part)
        tables.latest.write_batch(latest_per_key(changed), batch)
        tables.commit(batch, changed.count(), ("latest",))
        if batch == 0:
            tables.latest.fold()
    return tables.latest.read().select("table", "id", "op", F.col("ord.offset").alias("offset"))


def truncated_log(spark, sf_dir):
    """The order log with a truncate at an instant in its middle."""
    log = logs.orders_log(spark, sf_dir)
    # The record takes the last offset; its commit time is what places it among the changes.
    instant = F.unix_millis(F.lit(TRUNCATED_AT).cast("timestamp"))
    cut = log.agg(F.max("offset").alias("offset")).select(
        F.lit(None).cast("binary").alias("key"),
        F.to_json(F.struct(F.lit("t").alias("op"), F.struct(F.lit(ORDERS).alias("table"), instant.alias("ts_ms")).alias("source")))
        .cast("binary").alias("value"),
        F.lit("inventory.inventory.orders").alias("topic"),
        F.lit(0).alias("partition"),
        "offset",
        F.lit(TRUNCATED_AT).cast("timestamp").alias("timestamp"),
    )
    return log.unionByName(cut)


def truncate_event(spark, sf_dir):
    """Orders after their table was truncated in the middle of the log."""
    log = truncated_log(spark, sf_dir)
    kept = survive_truncates(changes(log), parse_events(log, fields=("id",)))
    return order_documents(latest_of(kept, ORDERS, ORDER_VALUES))


def cascade_delete(spark, sf_dir):
    live = live_rows(latest_of(logs.order_changes(spark, sf_dir), ORDERS, ["op", "customer_id", "ord"]))
    kept = cascade_deletes(live, logs.customer_changes(spark, sf_dir))
    return kept.select("id", "customer_id")


def fk_orphans(spark, sf_dir):
    orders = order_documents(latest_of(logs.order_changes(spark, sf_dir), ORDERS, ORDER_VALUES))
    customers = customer_documents(latest_of(logs.customer_changes(spark, sf_dir), CUSTOMERS, CUSTOMER_VALUES))
    return orphans(orders, customers).select("_id", "customer_id")


def _both_counts(spark, sf_dir):
    source = table_counts(
        {CUSTOMERS: logs.customer_table(spark, sf_dir), ORDERS: logs.order_table(spark, sf_dir)}, "source_rows"
    )
    latest = live_rows(latest_per_key(logs.both_changes(spark, sf_dir), ["op"]))
    target = latest.groupBy("table").agg(F.count(F.lit(1)).cast("bigint").alias("target_rows"))
    return source, target


def counts_reconciled(spark, sf_dir):
    """The source tables against the state of their logs, which saw deletes."""
    return reconcile_counts(*_both_counts(spark, sf_dir)).withColumn("text", sync_text(F.col("in_sync")))


def whole_in_sync(spark, sf_dir):
    return all_in_sync(reconcile_counts(*_both_counts(spark, sf_dir)))


def both_stores_up(spark, sf_dir):
    """Whether both sides can be read: with documents as they are, with the orders emptied, and with their store gone."""
    root = new_folder(spark, "stores")
    latest = latest_per_key(logs.both_changes(spark, sf_dir), CUSTOMER_VALUES + ORDER_VALUES[1:])
    customer_documents(latest).write.parquet(f"{root}/customers")
    orders = cut_lineage(order_documents(latest))
    orders.write.parquet(f"{root}/orders")
    orders.where("false").write.parquet(f"{root}/emptied")
    source = table_counts(
        {CUSTOMERS: logs.customer_table(spark, sf_dir), ORDERS: logs.order_table(spark, sf_dir)}, "source_rows"
    )
    seen = []
    for case, folder in (("stored", "orders"), ("emptied", "emptied"), ("gone", "never-written")):
        target = stored_counts(spark, {CUSTOMERS: f"{root}/customers", ORDERS: f"{root}/{folder}"}, "target_rows")
        up = both_readable(F.col("source_rows"), F.col("target_rows"))
        seen.append(source.join(target, ["table"], "full").select(F.lit(case).alias("case"), "table", "target_rows", up.alias("up")))
    return feed.union_all(seen)


def rows_reconciled(spark, sf_dir):
    """Row-level differences between the order table and the state of its log."""
    source = logs.order_table(spark, sf_dir).drop("order_date")
    target = order_documents(latest_of(logs.order_changes(spark, sf_dir), ORDERS, ORDER_VALUES)).withColumnRenamed("_id", "id")
    return reconcile_rows(source, target, "id")


def ranges_reconciled(spark, sf_dir):
    """Rows that differ between the order table and a copy that lost, gained and changed a few, found by digests of key ranges."""
    rows = cut_lineage(logs.order_table(spark, sf_dir).drop("order_date"))
    status = F.when(F.col("id") % 9_967 == 7, F.lit("CANCELLED")).otherwise(F.col("status"))
    source = rows.where(F.col("id") % 9_973 != 5)
    target = rows.where(F.col("id") % 9_949 != 3).withColumn("status", status)
    return reconcile_ranges(source, target, "id")


def purge_by_predicate(spark, sf_dir):
    rows = logs.customer_table(spark, sf_dir).select("id", "name")
    return purge(rows, F.col("id") >= PURGE_FROM_ID)


def prefix_like(spark, sf_dir):
    """In LIKE an underscore stands for any character."""
    rows = logs.customer_table(spark, sf_dir)
    return rows.where(F.col("name").like("Customer_%")).select("id", "name")


def prefix_regex(spark, sf_dir):
    rows = logs.customer_table(spark, sf_dir)
    hit = F.col("name").rlike("^Customer_")
    return rows.agg(
        F.count_if(hit).cast("bigint").alias("with_underscore"),
        F.count_if(F.col("name").rlike("^Customer#")).cast("bigint").alias("with_hash"),
    )


def id_range_count(spark, sf_dir):
    """The range reaches the scan."""
    rows = logs.order_table(spark, sf_dir)
    return rows.where((F.col("id") >= 1_000) & (F.col("id") < 9_000)).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def newest_key(spark, sf_dir):
    newest = F.max("id").alias("id")
    customers = logs.customer_table(spark, sf_dir).agg(newest).select(F.lit(CUSTOMERS).alias("table"), "id")
    return customers.unionByName(logs.order_table(spark, sf_dir).agg(newest).select(F.lit(ORDERS).alias("table"), "id"))


def gauge_snapshot(spark, sf_dir):
    """Every gauge once, from the tables and the state of their log, which is parsed once."""
    log = logs.both_log(spark, sf_dir)
    flat = cut_lineage(changes(log).drop("name", "masked_email"))
    source = table_counts(
        {CUSTOMERS: logs.customer_table(spark, sf_dir), ORDERS: logs.order_table(spark, sf_dir)}, "source_rows"
    )
    live = live_rows(latest_per_key(flat, ["op"]))
    target = live.groupBy("table").agg(F.count(F.lit(1)).cast("bigint").alias("target_rows"))
    added = cut_lineage(deltas(flat))  # a row per counter and customer
    counted = added.where(F.col("kind") == COUNTER).select("key", "value")
    scored = added.where(F.col("kind") == SCORE).select(F.col("key").alias("member"), F.col("value").alias("score"))
    return gauges(source, target, counted, scored, topic_end_offsets(log))


QUERIES = {
    "doc_state_orders": doc_state_orders,
    "doc_state_customers": doc_state_customers,
    "doc_state_orders_python": doc_state_orders_python,
    "doc_state_customers_python": doc_state_customers_python,
    "doc_state_orders_scala": doc_state_orders_scala,
    "doc_delete": doc_delete,
    "kv_customer_hash": kv_customer_hash,
    "latest_per_key": latest_change,
    "merge_latest": merged_state,
    "truncate_event": truncate_event,
    "cascade_delete": cascade_delete,
    "fk_orphans": fk_orphans,
    "reconcile_counts": counts_reconciled,
    "all_in_sync": whole_in_sync,
    "both_stores_up": both_stores_up,
    "reconcile_rows": rows_reconciled,
    "reconcile_ranges": ranges_reconciled,
    "purge_by_predicate": purge_by_predicate,
    "prefix_like": prefix_like,
    "prefix_regex": prefix_regex,
    "id_range_count": id_range_count,
    "newest_key": newest_key,
    "gauge_snapshot": gauge_snapshot,
}

_LATEST = f"""
with {ORDER_LATEST_CTE}, {CUSTOMER_LATEST_CTE}
select 'orders' as "table", id, op, off as "offset" from ol
union all select 'customers', id, op, off from cl"""
_COUNTS = f"""
with {ORDER_LATEST_CTE}, {CUSTOMER_LATEST_CTE}, c as (
  select 'customers' as t, (select count(*) from customer) s, (select count(*) from cl where op<>'d') g
  union all select 'orders', (select count(*) from orders), (select count(*) from ol where op<>'d'))"""

ORACLE = {
    "doc_state_orders": f"""
with {ORDER_LATEST_CTE}
select id as _id, cid as customer_id, amt as total_amount, st as status from ol where op <> 'd'""",
    "doc_state_customers": f"""
with {CUSTOMER_LATEST_CTE} select id as _id, nm as name, {masked('em')} as email from cl where op <> 'd'""",
    "doc_state_orders_python": f"""
with {ORDER_LATEST_CTE}
select id, cid as customer_id, amt as total_amount, st as status, id as _id from ol""",
    "doc_state_customers_python": f"""
with {CUSTOMER_LATEST_CTE} select id, nm as name, {masked('em')} as masked_email, id as _id from cl""",
    "doc_state_orders_scala": f"""
with {ORDER_LATEST_CTE}
select id as _id, cid as customer_id, cast(amt as double) as total_amount, st as status from ol where op <> 'd'""",
    "doc_delete": f"""
with {ORDER_LATEST_CTE}, {CUSTOMER_LATEST_CTE}
select 'orders' as "table", id from ol where op = 'd'
union all select 'customers', id from cl where op = 'd'""",
    "kv_customer_hash": f"""
with {CUSTOMER_LATEST_CTE}
select 'customer:' || id as key, cast(id as varchar) as id, nm as name, {masked('em')} as email from cl where op <> 'd'""",
    "latest_per_key": _LATEST,
    "merge_latest": _LATEST,
    "truncate_event": f"""
with {ORDER_CTE}, kept as (select * from oe where ts > epoch_ms(timestamp '{TRUNCATED_AT}')
                           or (ts = epoch_ms(timestamp '{TRUNCATED_AT}') and off > (select max(off) from oe))),
l as (select *, row_number() over (partition by id order by off desc) rn from kept)
select id as _id, cid as customer_id, amt as total_amount, st as status from l where rn = 1 and op <> 'd'""",
    "cascade_delete": f"""
with {ORDER_LATEST_CTE}, {CUSTOMER_CTE}, gone as (select id cid, max(ts) g from ce where op='d' group by 1)
select ol.id, ol.cid as customer_id from ol left join gone on ol.cid = gone.cid
where ol.op <> 'd' and (g is null or ol.ts > g)""",
    "fk_orphans": f"""
with {ORDER_LATEST_CTE}, {CUSTOMER_LATEST_CTE}
select ol.id as _id, cid as customer_id from ol
where op <> 'd' and not exists (select 1 from cl where cl.id = ol.cid and cl.op <> 'd')""",
    "reconcile_counts": f"""{_COUNTS}
select t as "table", s as source_rows, g as target_rows, s - g as lag, cast(s = g as bigint) as in_sync,
       case when s = g then 'IN SYNC' else 'OUT OF SYNC' end as text from c""",
    "all_in_sync": f"{_COUNTS} select cast(min(cast(s = g as integer)) as bigint) as in_sync from c",
    "both_stores_up": f"""{_COUNTS},
w as (select 'stored' as "case", t, g from c union all select 'emptied', t, case t when 'orders' then 0 else g end from c
      union all select 'gone', t, case t when 'orders' then null else g end from c)
select "case", t as "table", cast(g as bigint) as target_rows, cast(g is not null and s is not null as bigint) as up
from w join (select t, s from c) using (t)""",
    "reconcile_rows": f"""
with {ORDER_LATEST_CTE}
select ob.id, case when ol.op = 'd' then 'missing' else 'different' end as verdict
from ob join ol on ob.id = ol.id where ol.op = 'd' or ob.st <> ol.st""",
    "reconcile_ranges": f"""
with {ORDER_CTE}, s as (select id from ob where id % 9973 <> 5), t as (select id from ob where id % 9949 <> 3)
select coalesce(s.id, t.id) as id, case when t.id is null then 'missing' when s.id is null then 'extra' else 'different' end as verdict
from s full join t on s.id = t.id where s.id is null or t.id is null or s.id % 9967 = 7""",
    "purge_by_predicate": f"""
select c_custkey as id, c_name as name from customer where not c_custkey >= {PURGE_FROM_ID}""",
    "prefix_like": """select c_custkey as id, c_name as name from customer where c_name like 'Customer_%'""",
    "prefix_regex": """
select count(*) filter (regexp_matches(c_name, '^Customer_')) as with_underscore,
       count(*) filter (regexp_matches(c_name, '^Customer#')) as with_hash from customer""",
    "id_range_count": """select count(*) as n from orders where o_orderkey >= 1000 and o_orderkey < 9000""",
    "newest_key": """
select 'customers' as "table", max(c_custkey) as id from customer union all select 'orders', max(o_orderkey) from orders""",
    "gauge_snapshot": f"""{_COUNTS},
o as (select 'cdc_kafka_orders_offset' as name, sum(e) as value from (select max(off)+1 e from oe group by id%3)
      union all select 'cdc_kafka_customers_offset', sum(e) from (select max(off)+1 e from ce group by id%3)),
g as (select 'cdc_mysql_' || t || '_total' as name, s as value from c
  union all select 'cdc_mongo_' || t || '_total', g from c
  union all select 'cdc_redis_customers_total', count(*) from ce where op <> 'd'
  union all select 'cdc_redis_orders_total', sum(case op when 'd' then -1 else 1 end) from oe
  union all select 'cdc_redis_top_customer_score', max(n) from (select count(*) n from oe where op <> 'd' group by cid)
  union all select * from o
  union all select 'cdc_pipeline_up', 1
  union all select 'cdc_mysql_mongo_in_sync', min(cast(s = g as integer)) from c)
select name, cast(value as double) as value from g
union all select 'cdc_redis_orders_revenue', cast(sum(case op when 'd' then -amt else amt end) as double) from oe""",
}
