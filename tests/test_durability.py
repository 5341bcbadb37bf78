"""New checkpoints, rebuilds, losses, log rotation and odd readings."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.test_streams import kept, rows, whole
from tideline.operators.counters import counters, net_counters, scores
from tideline.operators.envelope import changes, parse_events
from tideline.operators.gauges import gauges
from tideline.operators.ranks import p95_index, pick_by_index
from tideline.operators.state import latest_per_key
from tideline.operators.timeseries import last_reading
from tideline.plans.streams import PARTS, Arriving
from tideline.schema import LOG_SCHEMA, topic_of
from tideline.session import new_folder
from tideline.sources.log import read_files, read_kafka, topic_end_offsets
from tideline.streaming import ChangeSink, rebuild
from tideline.streaming.apply import run_available
from tideline.streaming.progress import ProgressLog


def event(op, table, before, after, offset, **source):
    value = json.dumps({"op": op, "before": before, "after": after, "source": {"table": table, **source}})
    return (None, value.encode(), topic_of(table), 0, offset, None)


def log_of(spark, events):
    return spark.createDataFrame(events, LOG_SCHEMA)


@pytest.mark.parametrize("fold", [False, True])
def test_new_checkpoint_over_kept_tables(spark, fold):
    log = Arriving(spark, SF_SMALL)
    for part in PARTS:
        log.arrive(part)
        log.apply()
        if fold:
            log.tables.fold()
    run_available(log.stream(), ChangeSink(log.tables), f"{log.root}/second")
    assert kept(log) == whole(log)
    log.tables.fold()
    run_available(log.stream(), ChangeSink(log.tables), f"{log.root}/third")
    assert kept(log) == whole(log)


def test_old_checkpoint_keeps_its_epoch(spark):
    log = Arriving(spark, SF_SMALL)
    log.arrive("c")
    log.apply()
    log.arrive("u")
    log.apply()
    assert log.tables.epoch() == 0 and log.tables.latest.batch_ids() == [0, 1]


def test_rebuild_replaces_what_was_there(spark):
    log = Arriving(spark, SF_SMALL)
    log.apply_parts()
    rebuild(read_files(spark, log.path), log.tables)
    assert kept(log) == whole(log)
    assert log.tables.latest.batch_ids() == [0]


def test_folds_remove_what_is_covered(spark):
    log = Arriving(spark, SF_SMALL)
    flat = changes(log_of(spark, [event("c", "orders", None, {"id": 1}, 0)]))
    sink = ChangeSink(log.tables, fold_every=1)
    for batch in range(4):
        sink(flat, batch)
    assert log.tables.latest.base_id() == 3
    assert log.tables.latest.batch_ids() == [3]


def test_due_fold_runs_on_an_empty_batch(spark):
    log = Arriving(spark, SF_SMALL)
    flat = changes(log_of(spark, [event("c", "orders", None, {"id": 1}, 0)]))
    sink = ChangeSink(log.tables, fold_every=2)
    sink(flat, 0)
    sink(flat.where("false"), 1)
    assert log.tables.latest.base_id() == 0


def test_rebuild_fails_on_a_lost_file(spark):
    path = new_folder(spark, "lost")
    log = log_of(spark, [event("c", "orders", None, {"id": i}, i) for i in range(4)])
    log.repartition(2).write.parquet(path)
    spark.conf.set("spark.sql.files.ignoreMissingFiles", "true")
    try:
        read = read_files(spark, path)
        gone = next(f for f in os.listdir(path.removeprefix("file:")) if f.endswith(".parquet"))
        os.remove(os.path.join(path.removeprefix("file:"), gone))
        with pytest.raises(Exception):
            read.count()
    finally:
        spark.conf.unset("spark.sql.files.ignoreMissingFiles")


def test_kafka_rebuild_asks_for_every_record(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(type(spark.read), "options", lambda self, **o: seen.update(o) or self)
    monkeypatch.setattr(type(spark.read), "load", lambda self: None)
    read_kafka(spark, "h:9", ["orders"])
    assert seen["failOnDataLoss"] == "true"


def test_progress_outlives_the_query(spark):
    log = Arriving(spark, SF_SMALL)
    progress = ProgressLog(spark, f"{log.root}/progress", together=2)
    try:
        log.apply_parts()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        progress.close()
    batches = [r["batch_id"] for r in progress.rows().where("num_input_rows > 0").orderBy("batch_id").collect()]
    assert batches == [0, 1, 2]


def test_rotation_and_rows_of_one_event_decide(spark):
    old = event("u", "orders", None, {"id": 1, "status": "OLD"}, 1, ts_ms=1000, file="bin.000001", pos=900, row=0)
    new = event("u", "orders", None, {"id": 1, "status": "NEW"}, 2, ts_ms=1000, file="bin.000002", pos=4, row=0)
    newer = event("u", "orders", None, {"id": 1, "status": "NEWER"}, 0, ts_ms=1000, file="bin.000002", pos=4, row=1)
    assert latest_per_key(changes(log_of(spark, [new, old]))).first()["status"] == "NEW"
    assert latest_per_key(changes(log_of(spark, [newer, new, old]))).first()["status"] == "NEWER"


def test_net_counters_start_again_after_a_truncate(spark):
    events = [
        event("c", "orders", None, {"id": 1, "status": "PENDING"}, 0, ts_ms=1),
        event("t", "orders", None, None, 1, ts_ms=2),
        event("c", "orders", None, {"id": 2, "status": "PENDING"}, 2, ts_ms=3),
    ]
    assert [r["n"] for r in net_counters(parse_events(log_of(spark, events))).collect()] == [1]


def test_gauges_of_empty_and_unread_stores(spark):
    log = log_of(spark, [event("c", "customers", None, {"id": 1, "name": "a", "email": "a@b"}, 0)])
    flat = changes(log)
    source = spark.createDataFrame([("customers", 1), ("orders", 0)], "table string, source_rows bigint")
    target = flat.groupBy("table").agg(F.count("*").alias("target_rows"))
    rest = (counters(flat), scores(flat), topic_end_offsets(log))
    found = {r["name"]: r["value"] for r in gauges(source, target, *rest).collect()}
    assert found["cdc_pipeline_up"] == 1 and found["cdc_mysql_mongo_in_sync"] == 1
    assert found["cdc_mongo_orders_total"] == 0 and found["cdc_redis_orders_total"] == 0
    assert found["cdc_kafka_orders_offset"] == 0
    unread = spark.createDataFrame([("customers", 1), ("orders", None)], "table string, target_rows bigint")
    found = {r["name"]: r["value"] for r in gauges(source, unread, *rest).collect()}
    assert found["cdc_pipeline_up"] == 0 and found["cdc_mongo_orders_total"] is None


@pytest.mark.parametrize(
    "values, kind",
    [
        ([float(i) for i in range(50)] + [float("inf")], "double"),
        ([float(i) for i in range(50)] + [float("-inf"), float("nan"), float("inf")], "double"),
        ([-1.7e308, 1.7e308] + [float(i) for i in range(20)], "double"),
        ([float("nan")] * 30, "double"),
        ([2**62 + i for i in range(40)], "bigint"),
    ],
)
def test_ranks_end_for_any_values(spark, values, kind):
    df = spark.createDataFrame([("a", v) for v in values], f"g string, v {kind}")
    found = pick_by_index(df, ["g"], "v", {"p95": p95_index(F.col("n")), "last": F.col("n") - 1}, window_rows=5)
    order = sorted(values, key=lambda v: (v != v, v))
    want = {"p95": order[min(len(values) * 95 // 100, len(values) - 1)], "last": order[-1]}
    assert {r["stat"]: repr(r["picked"]) for r in found.collect()} == {k: repr(v) for k, v in want.items()}


def test_last_reading_of_equal_times_is_defined(spark):
    df = spark.createDataFrame([("a", 1, 5, 2), ("a", 1, 7, 1)], "name string, ts int, value int, seq int")
    assert last_reading(df).first()["value"] == 7
    assert last_reading(df, tie="seq").first()["value"] == 5
    assert rows(last_reading(df)) == rows(last_reading(df.orderBy("seq")))
