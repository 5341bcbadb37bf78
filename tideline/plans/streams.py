"""Streams over a log that arrives in three parts: creates, updates, deletes.

The parts cut across keys, so later batches change rows that earlier ones wrote, and a
returning customer arrives before the delete that it follows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions import status_key
from tideline.operators.counters import top_members
from tideline.operators.envelope import changes, route
from tideline.operators.gauges import table_gauges, taken
from tideline.operators.reconcile import table_counts
from tideline.operators.ranks import SKETCHED, close_exactly, merged_sketches, p50_index, p95_index, picked_columns, sketched
from tideline.operators.state import customer_hashes, live_rows, order_documents
from tideline.plans import envelopes, logs, metrics, states
from tideline.plans.aggregates import COUNTERS_SQL, SCORES_SQL, TOP_K
from tideline.plans.logs import CUSTOMER_CTE, CUSTOMER_LATEST_CTE, ORDER_CTE, ORDER_LATEST_CTE, masked
from tideline.schema import CUSTOMERS, ORDERS, topic_of
from tideline.session import cut_lineage, new_folder
from tideline.sources import feed
from tideline.sources.log import read_files, stream_files, subscribe, topic_end_offsets
from tideline.streaming.apply import ChangeSink, preview, rebuild, run_available, running_aggregate, start, to_parquet
from tideline.streaming.net import keep_net_totals, net_table, net_totals
from tideline.streaming.progress import ProgressLog
from tideline.streaming.tables import BatchTable, StateTables

PARTS = ("c", "u", "d")
# Between the creates and the updates of the derived customers.
CUSTOMERS_CUT_MS = 800_000_000_000


class Arriving:
    """A log folder that grows part by part, with tables and a checkpoint of its own."""

    def __init__(self, spark, sf_dir):
        self.spark, self.sf_dir = spark, sf_dir
        self.root = new_folder(spark, "stream")
        self.path = f"{self.root}/log"
        self.checkpoint = f"{self.root}/checkpoint"
        self.tables = StateTables.at(spark, f"{self.root}/tables")
        self.events = self.events_of(feed.ALL_OPS)

    def events_of(self, ops):
        return logs.order_events(self.spark, self.sf_dir, ops).unionByName(logs.customer_events(self.spark, self.sf_dir, ops))

    def arrive(self, part):
        feed.to_log(self.events_of((part,))).write.mode("append").parquet(self.path)

    def arrive_all(self):
        feed.to_log(self.events).write.mode("append").parquet(self.path)

    def stream(self):
        return stream_files(self.spark, self.path)

    def apply(self, sink=None):
        return run_available(self.stream(), sink or ChangeSink(self.tables), self.checkpoint)

    def apply_parts(self):
        return [self._arrive_and_apply(part) for part in PARTS]

    def _arrive_and_apply(self, part):
        self.arrive(part)
        return self.apply()


def src_change_stream(spark, sf_dir):
    """Both topics from the start, as a stream of flat changes into files."""
    log = Arriving(spark, sf_dir)
    log.arrive_all()
    flat = changes(subscribe(log.stream(), [CUSTOMERS, ORDERS]), with_order=False)
    to_parquet(flat, f"{log.root}/flat", log.checkpoint)
    return spark.read.parquet(f"{log.root}/flat")


def sink_preview(spark, sf_dir):
    """What the preview table shows: order changes by op."""
    log = Arriving(spark, sf_dir)
    log.arrive_all()
    name = "preview_" + log.root.rsplit("-", 1)[1]
    preview(log.stream(), name, log.checkpoint).awaitTermination()
    return spark.table(name).select("table", "op", "n")


def stream_apply(spark, sf_dir):
    """Order documents after three micro-batches."""
    log = Arriving(spark, sf_dir)
    log.apply_parts()
    return order_documents(log.tables.latest.read())


def stream_hashes(spark, sf_dir):
    """Customer hashes after three micro-batches, folded in between."""
    log = Arriving(spark, sf_dir)
    for part in PARTS:
        log.arrive(part)
        log.apply()
        log.tables.latest.fold()
    return customer_hashes(log.tables.latest.read())


def stream_top_customers(spark, sf_dir):
    log = Arriving(spark, sf_dir)
    log.apply_parts()
    return top_members(log.tables.scores(), TOP_K)


class StopOnce:
    """Fails the first time a batch has written a table."""

    def __init__(self, batch_id, table="latest"):
        self.batch_id, self.table, self.stopped = batch_id, table, False

    def __call__(self, table, batch_id):
        if (table, batch_id) == (self.table, self.batch_id) and not self.stopped:
            self.stopped = True
            raise RuntimeError("stopped half-way through the batch, as the test asks")


def _restarted(spark, sf_dir):
    """Stop in the middle of the second batch, then start again from the checkpoint."""
    log = Arriving(spark, sf_dir)
    log.arrive("c")
    log.apply()
    log.arrive("u")
    stop = StopOnce(1)
    try:
        log.apply(ChangeSink(log.tables, after_write=stop))
    except Exception:
        if not stop.stopped:
            raise
    log.apply()
    log.arrive("d")
    log.apply()
    return log


def stream_restart(spark, sf_dir):
    return order_documents(_restarted(spark, sf_dir).tables.latest.read())


def counters_exactly_once(spark, sf_dir):
    """Counters over a restart and a retry of a finished batch, with a fold in between."""
    log = _restarted(spark, sf_dir)
    log.tables.fold()
    retried = changes(feed.to_log(log.events_of(("d",))))
    ChangeSink(log.tables)(retried, 2)
    return log.tables.counters()


def replay_idempotent(spark, sf_dir):
    """The whole feed applied a second time as new batches leaves documents as they were."""
    log = Arriving(spark, sf_dir)
    log.apply_parts()
    log.arrive_all()
    log.apply()
    return order_documents(log.tables.latest.read())


def rebuild_from_log(spark, sf_dir):
    """Counters of fresh tables filled by one batch over the whole log."""
    log = Arriving(spark, sf_dir)
    log.arrive_all()
    rebuild(read_files(spark, log.path), log.tables)
    return log.tables.counters()


def stream_agg(spark, sf_dir):
    """Status totals as a streaming aggregation."""
    log = Arriving(spark, sf_dir)
    log.arrive_all()
    flat = route(changes(log.stream(), with_order=False), ORDERS)
    sign = F.when(F.col("op") == "d", F.lit(-1)).otherwise(F.lit(1))
    totals = flat.groupBy(status_key(F.col("status")).alias("key")).agg(F.sum(sign).cast("bigint").alias("value"))
    out = BatchTable(spark, f"{log.root}/totals", "key string, value bigint", lambda d: d, lambda a, b: b)
    running_aggregate(totals, out, log.checkpoint)
    return out.last_batch()


def batch_counts(spark, sf_dir):
    log = Arriving(spark, sf_dir)
    log.apply_parts()
    return log.tables.batch_rows().groupBy("batch").agg(F.sum("n").cast("bigint").alias("n"))


def batch_progress(spark, sf_dir):
    """Input rows per micro-batch as the engine reports them."""
    log = Arriving(spark, sf_dir)
    progress = ProgressLog(spark, f"{log.root}/progress", together=2)
    try:
        log.apply_parts()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        progress.close()
    return progress.rows().where(F.col("num_input_rows") > 0).select("batch_id", "num_input_rows")


def stream_new_checkpoint(spark, sf_dir):
    """Kept tables, checkpoint gone, the log replayed from the start: counters and scores as from one pass."""
    log = Arriving(spark, sf_dir)
    log.apply_parts()
    log.tables.fold()
    run_available(log.stream(), ChangeSink(log.tables), f"{log.root}/second-checkpoint")
    return log.tables.counters()


def _streamed(spark, log):
    """Tables after a stored log went through the stream."""
    root = new_folder(spark, "stored")
    log.write.parquet(f"{root}/log")
    tables = StateTables.at(spark, f"{root}/tables")
    run_available(stream_files(spark, f"{root}/log"), ChangeSink(tables), f"{root}/checkpoint")
    return tables


def stream_truncate(spark, sf_dir):
    """Order documents after a truncate went by in the stream."""
    return order_documents(_streamed(spark, states.truncated_log(spark, sf_dir)).current())


def stream_rejects(spark, sf_dir):
    """The ledger that the stream keeps of events that change no row."""
    return _streamed(spark, logs.rough_log(spark, sf_dir)).rejects.read()


def rebuild_then_stream(spark, sf_dir):
    """Tables rebuilt from the creates, then a stream that goes on with the updates and deletes."""
    log = Arriving(spark, sf_dir)
    log.arrive("c")
    rebuild(read_files(spark, log.path), log.tables)
    later = f"{log.root}/later"
    feed.to_log(log.events.where("op <> 'c'")).write.parquet(later)
    start(stream_files(spark, later), ChangeSink(log.tables), log.checkpoint, None, from_start=False).awaitTermination()
    return order_documents(log.tables.latest.read())


def stream_net_counters(spark, sf_dir):
    """True totals from a log whose updates have no before-image, over a restart, with a truncate and late changes.

    The order log comes in four parts, each to a query started anew: deletes first, updates, the truncate, creates last.
    """
    root = new_folder(spark, "net")
    table = net_table(spark, f"{root}/net")
    events = logs.order_events(spark, sf_dir).unionByName(logs.customer_events(spark, sf_dir))
    bare = events.withColumn("before", F.when(F.col("op") == "d", F.col("before")))
    truncate = states.truncated_log(spark, sf_dir).where(F.col("key").isNull())
    for part in ("d", "u", "t", "c"):
        rows = truncate if part == "t" else feed.to_log(bare.where(F.col("op") == part))
        rows.write.mode("append").parquet(f"{root}/log")
        keep_net_totals(stream_files(spark, f"{root}/log"), table, f"{root}/checkpoint", buckets=8).awaitTermination()
    return net_totals(table)


def stream_cascade(spark, sf_dir):
    """Orders left after customer deletes that went by in the stream; the orders' creates come in last."""
    log = Arriving(spark, sf_dir)
    for part in ("d", "u", "c"):
        log.arrive(part)
        log.apply()
        log.tables.fold()
    rows = route(log.tables.after_cascades(), ORDERS)
    return live_rows(rows).select("id", "customer_id")


def stream_gauges(spark, sf_dir):
    """History of every gauge: read from the state tables after each batch, at the time of its newest event."""
    log = Arriving(spark, sf_dir)
    history = BatchTable(spark, f"{log.root}/gauges", "ts timestamp, name string, value double", lambda d: d, lambda a, b: a.unionByName(b))
    source = table_counts({CUSTOMERS: logs.customer_table(spark, sf_dir), ORDERS: logs.order_table(spark, sf_dir)}, "source_rows")
    for batch, part in enumerate(PARTS):
        log.arrive(part)
        log.apply()
        stored = read_files(spark, log.path)
        newest = stored.agg(F.max("timestamp")).scalar()
        history.write_batch(taken(table_gauges(source, log.tables, topic_end_offsets(stored)), newest), batch)
    return history.read().select(F.col("ts").cast("timestamp_ntz").alias("ts"), "name", "value")


def stream_p95(spark, sf_dir):
    """Median and p95 of readings that come in three parts: sketches kept per batch, folded, and closed exactly."""
    root = new_folder(spark, "readings")
    groups, value = ["name"], "value"
    table = BatchTable(
        spark, f"{root}/sketches", f"name string, {SKETCHED}", lambda d: merged_sketches(d, groups), lambda a, b: merged_sketches(a.unionByName(b), groups)
    )
    readings = logs.readings(spark, sf_dir)
    for part in range(3):
        readings.where(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{root}/log")
        query = (
            spark.readStream.schema(readings.schema).parquet(f"{root}/log").writeStream
            .foreachBatch(lambda rows, batch: table.write_batch(sketched(rows, groups, value), batch))
            .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        table.fold()
    stored = spark.read.schema(readings.schema).parquet(f"{root}/log")
    indexes = {"p50": p50_index(F.col("n")), "p95": p95_index(F.col("n"))}
    return picked_columns(close_exactly(stored, table.read(), groups, value, indexes), groups, ["p50", "p95"])


STEPS = ("latest", "deltas", "rejects", "cuts")


def stream_atomic(spark, sf_dir):
    """What readers see after a batch failed behind each of its writes, and after it went through.

    The second batch holds updates, a truncate of the customers and events that change nothing, so it writes every table.
    """
    log = Arriving(spark, sf_dir)
    log.arrive("c")
    log.apply()
    log.arrive("u")
    truncate = F.struct(F.lit("t").alias("op"), F.struct(F.lit(CUSTOMERS).alias("table"), F.lit(CUSTOMERS_CUT_MS).alias("ts_ms")).alias("source"))
    cut = read_files(spark, log.path).agg(F.max("offset").alias("offset")).select(
        F.lit(None).cast("binary").alias("key"), F.to_json(truncate).cast("binary").alias("value"), F.lit(topic_of(CUSTOMERS)).alias("topic"),
        F.lit(0).alias("partition"), "offset", F.lit(None).cast("timestamp").alias("timestamp"),
    )
    feed.tombstones(log.events).unionByName(cut).write.mode("append").parquet(log.path)
    seen = []
    for table in (*STEPS, None):
        stop = StopOnce(1, table)
        try:
            log.apply(ChangeSink(log.tables, after_write=stop))
        except Exception:
            if not stop.stopped:
                raise
        view = log.tables.pinned()
        shipped = order_documents(view.latest.read()).where("status = 'SHIPPED'").agg(F.count("*").alias("shipped_documents"))
        counted = view.counters().agg(
            F.coalesce(F.max(F.when(F.col("key") == status_key(F.lit("SHIPPED")), F.col("value"))), F.lit(0)).cast("bigint").alias("shipped_counted")
        )
        ledger = view.rejects.read().agg(F.count("*").alias("rejected"))
        customers = route(view.current(), CUSTOMERS).agg(F.count("*").alias("customers"))
        row = shipped.join(counted).join(ledger).join(customers).withColumn("failed_after", F.lit(table or "nothing"))
        seen.append(cut_lineage(row))
    return feed.union_all(seen)


QUERIES = {
    "src_change_stream": src_change_stream,
    "sink_preview": sink_preview,
    "stream_apply": stream_apply,
    "stream_hashes": stream_hashes,
    "stream_top_customers": stream_top_customers,
    "stream_restart": stream_restart,
    "counters_exactly_once": counters_exactly_once,
    "replay_idempotent": replay_idempotent,
    "rebuild_from_log": rebuild_from_log,
    "stream_agg": stream_agg,
    "batch_counts": batch_counts,
    "batch_progress": batch_progress,
    "stream_new_checkpoint": stream_new_checkpoint,
    "rebuild_then_stream": rebuild_then_stream,
    "stream_truncate": stream_truncate,
    "stream_rejects": stream_rejects,
    "stream_atomic": stream_atomic,
    "stream_net_counters": stream_net_counters,
    "stream_cascade": stream_cascade,
    "stream_gauges": stream_gauges,
    "stream_p95": stream_p95,
}

_DOCUMENTS = f"""
with {ORDER_LATEST_CTE}
select id as _id, cid as customer_id, amt as total_amount, st as status from ol where op <> 'd'"""
_PER_PART = f"""
with {ORDER_CTE}, {CUSTOMER_CTE}, e as (select op from oe union all select op from ce)
select cast(case op when 'c' then 0 when 'u' then 1 else 2 end as bigint) as {{batch}}, count(*) as {{n}} from e group by 1"""



def _gauges_sql() -> str:
    stages = []
    for k in range(len(PARTS)):
        ops = ", ".join(f"'{p}'" for p in PARTS[: k + 1])
        stages.append(f"""
select * from (
with o as (select * from oe where op in ({ops})), u as (select * from ce where op in ({ops})),
ol as (select * from (select *, row_number() over (partition by id order by off desc) rn from o) where rn = 1 and op <> 'd'),
cl as (select * from (select *, row_number() over (partition by id order by off desc) rn from u) where rn = 1 and op <> 'd'),
c as (select 'customers' as t, (select count(*) from cb) as s, (select count(*) from cl) as g union all select 'orders', (select count(*) from ob), (select count(*) from ol)),
g as (select 'cdc_mysql_' || t || '_total' as name, s as value from c
  union all select 'cdc_mongo_' || t || '_total', g from c
  union all select 'cdc_redis_customers_total', count(*) from u where op <> 'd'
  union all select 'cdc_redis_orders_total', sum(case op when 'd' then -1 else 1 end) from o
  union all select 'cdc_redis_top_customer_score', max(n) from (select count(*) n from o where op <> 'd' group by cid)
  union all select 'cdc_kafka_orders_offset', sum(e) from (select max(off)+1 e from o group by id%3)
  union all select 'cdc_kafka_customers_offset', sum(e) from (select max(off)+1 e from u group by id%3)
  union all select 'cdc_pipeline_up', 1
  union all select 'cdc_mysql_mongo_in_sync', min(cast(s = g as integer)) from c)
select name, cast(value as double) as value from g
union all select 'cdc_redis_orders_revenue', cast(sum(case op when 'd' then -amt else amt end) as double) from o
) cross join (select make_timestamp(max(ts) * 1000) as ts from (select ts from oe where op in ({ops}) union all select ts from ce where op in ({ops})))""")
    return f"with {ORDER_CTE}, {CUSTOMER_CTE}" + " union all ".join(stages)


ORACLE = {
    "src_change_stream": f"""
with {ORDER_CTE}, {CUSTOMER_CTE}
select op, 'orders' as "table", id, cast(null as varchar) as name, cast(null as varchar) as masked_email,
       cid as customer_id, amt as total_amount, st as status from oe
union all select op, 'customers', id, nm, {masked('em')}, null, null, null from ce""",
    "sink_preview": f"""
with {ORDER_CTE}, {CUSTOMER_CTE}
select 'orders' as "table", op, count(*) as n from oe group by op
union all select 'customers', op, count(*) from ce group by op""",
    "stream_apply": _DOCUMENTS,
    "stream_hashes": f"""
with {CUSTOMER_LATEST_CTE}
select 'customer:' || id as key, cast(id as varchar) as id, nm as name, {masked('em')} as email from cl where op <> 'd'""",
    "stream_top_customers": f"select * from ({SCORES_SQL}) order by score desc, member desc limit {TOP_K}",
    "stream_restart": _DOCUMENTS,
    "counters_exactly_once": COUNTERS_SQL,
    "replay_idempotent": _DOCUMENTS,
    "rebuild_from_log": COUNTERS_SQL,
    "stream_agg": f"""
with {ORDER_CTE}
select 'orders:status:' || st as key, cast(sum(case op when 'd' then -1 else 1 end) as bigint) as value from oe group by st""",
    "stream_new_checkpoint": COUNTERS_SQL,
    "rebuild_then_stream": _DOCUMENTS,
    "stream_truncate": states.ORACLE["truncate_event"],
    "stream_rejects": envelopes.ORACLE["reject_ledger"],
    "stream_net_counters": f"""
with {ORDER_CTE}, {CUSTOMER_LATEST_CTE},
kept as (select * from oe where ts > epoch_ms(timestamp '{states.TRUNCATED_AT}')
         or (ts = epoch_ms(timestamp '{states.TRUNCATED_AT}') and off > (select max(off) from oe))),
l as (select *, row_number() over (partition by id order by off desc) rn from kept)
select 'orders' as "table", st as status, count(*) as n, cast(sum(amt) as decimal(38,2)) as amount from l where rn = 1 and op <> 'd' group by st
union all select 'customers', null, count(*), cast(0 as decimal(38,2)) from cl where op <> 'd'""",
    "stream_p95": metrics.ORACLE["p95_index"],
    "stream_gauges": _gauges_sql(),
    "stream_cascade": states.ORACLE["cascade_delete"],
    "stream_atomic": f"""
with {ORDER_CTE}, {CUSTOMER_CTE}, n as (
  select (select count(*) from oe where op = 'u') as shipped, (select count(*) from oe where op = 'd') + (select count(*) from ce where op = 'd') + 1 as rejects,
         (select count(*) from cb) as customers, (select count(*) from cb where id % 5 = 0 or id % 22 = 0) as later)
select unnest(['latest', 'deltas', 'rejects', 'cuts']) as failed_after, 0::bigint as shipped_documents, 0::bigint as shipped_counted,
       0::bigint as rejected, customers from n
union all select 'nothing', shipped, shipped, rejects, later from n""",
    "batch_counts": _PER_PART.format(batch="batch", n="n"),
    "batch_progress": _PER_PART.format(batch="batch_id", n="num_input_rows"),
}
