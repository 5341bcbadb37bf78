"""Totals kept as state, cascades, stores that cannot be read, and all gauges."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.test_commits import apply, order, tables, truncate  # noqa: F401
from tests.test_durability import event, log_of
from tests.test_streams import rows
from tideline.operators.envelope import changes, parse_events
from tideline.operators.gauges import COUNTER_GAUGES, OFFSET_GAUGES, REPORT_GAUGES, SOURCE_GAUGES, TARGET_GAUGES
from tideline.operators.reconcile import stored_counts
from tideline.operators.state import cascade_deletes, latest_of, live_rows, survive_truncates
from tideline.session import new_folder
from tideline.sources.log import stream_files
from tideline.streaming import net
from tideline.streaming.net import keep_net_totals, net_table, net_totals


def whole_totals(log):
    kept = survive_truncates(changes(log), parse_events(log, fields=("id",)))
    live = live_rows(latest_of(kept, "orders", ["op", "status", "total_amount"]))
    return live.groupBy(F.lit("orders").alias("table"), F.coalesce("status", F.lit("UNKNOWN")).alias("status")).agg(
        F.count("*").alias("n"), F.coalesce(F.sum("total_amount"), F.lit(0)).cast("decimal(38,2)").alias("amount")
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_net_totals_in_any_order(spark, seed):
    """Random changes without before-images, some of them late, deletes and truncates, over several restarts."""
    rng = random.Random(seed)
    events = []
    for offset in range(120):
        key, op = rng.randint(1, 12), rng.choice("cuuud")
        events.append(order(op, key, offset, rng.choice([None, "PENDING", "SHIPPED", "DELIVERED"])))
    for offset in (130, 131) if seed == 1 else (40,):
        events.append(truncate(offset))
    events += [order("c", 50 + k, 132 + k) for k in range(3)]
    rng.shuffle(events)
    root = new_folder(spark, "net")
    table = net_table(spark, f"{root}/net")
    for k in range(0, len(events), 45):
        log_of(spark, events[k : k + 45]).write.mode("append").parquet(f"{root}/log")
        keep_net_totals(stream_files(spark, f"{root}/log"), table, f"{root}/checkpoint", buckets=3).awaitTermination()
    assert rows(net_totals(table)) == rows(whole_totals(log_of(spark, events)))


@pytest.mark.parametrize("most", [100_000, 0])
def test_net_totals_without_a_call_per_key(spark, monkeypatch, most):
    """Images in tables rather than in Spark's state, read one by one from Python; the same over folds and with any join."""
    monkeypatch.setattr(net, "FOLD_EVERY", 2)
    monkeypatch.setattr(net, "MAX_BROADCAST_ROWS", most)
    rng = random.Random(3)
    events = [order(rng.choice("cuud"), rng.randint(1, 9), offset, rng.choice(["", "PENDING", "SHIPPED"])) for offset in range(60)]
    events.append(truncate(20))
    rng.shuffle(events)
    root = new_folder(spark, "net")
    table = net_table(spark, f"{root}/net")
    for k in range(0, len(events), 11):
        log_of(spark, events[k : k + 11]).write.mode("append").parquet(f"{root}/log")
        query = keep_net_totals(stream_files(spark, f"{root}/log"), table, f"{root}/checkpoint", buckets=2)
        query.awaitTermination()
        assert not query.lastProgress["stateOperators"]
    assert rows(net_totals(table)) == rows(whole_totals(log_of(spark, events)))


def test_a_retried_batch_of_totals_replaces_itself(spark):
    table = net_table(spark, f"{new_folder(spark, 'net')}/net")
    batch = spark.createDataFrame([("orders", "PENDING", 2, 5)], "table string, status string, n bigint, amount int")
    for _ in range(2):
        table.write_batch(batch.withColumn("amount", F.col("amount").cast("decimal(38,2)")), 0)
    assert [r["n"] for r in net_totals(table).collect()] == [2]


def test_cascades_meet_orders_that_come_late(spark, tables):  # noqa: F811
    gone = {"id": 1, "name": "a", "email": "a@b"}
    apply(spark, tables, 0, [event("d", "customers", gone, None, 1, ts_ms=100), event("d", "customers", gone, None, 2, ts_ms=300)])
    apply(spark, tables, 1, [order("c", 1, 1, ts_ms=200), order("c", 4, 2, ts_ms=400), order("c", 2, 3, ts_ms=50)])
    for _ in range(3):
        left = tables.after_cascades().where("table = 'orders'")
        assert sorted(r["id"] for r in left.collect()) == [2, 4]
        tables.fold()
    whole = log_of(spark, [event("d", "customers", gone, None, 1, ts_ms=100), event("d", "customers", gone, None, 2, ts_ms=300)])
    assert rows(cascade_deletes(tables.current().where("table = 'orders'"), changes(whole)).select("id")) == rows(left.select("id"))


def test_stores_that_cannot_be_read(spark):
    root = new_folder(spark, "stores")
    spark.range(3).write.parquet(f"{root}/full")
    spark.range(0).write.parquet(f"{root}/empty")
    found = stored_counts(spark, {"full": f"{root}/full", "empty": f"{root}/empty", "gone": f"{root}/gone"}, "n")
    assert {r["table"]: r["n"] for r in found.collect()} == {"full": 3, "empty": 0, "gone": None}


def test_every_gauge_has_its_name():
    names = [n for group in (SOURCE_GAUGES, TARGET_GAUGES, COUNTER_GAUGES, OFFSET_GAUGES, REPORT_GAUGES) for n in group.values()]
    # Beside these: the best score, up and in sync.
    assert len(set(names)) == len(names) == 29 - 3
