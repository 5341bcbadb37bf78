"""Restarts, retries and folds leave the same tables as one pass over the log."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tideline.operators.counters import counters, scores
from tideline.operators.envelope import changes
from tideline.operators.state import latest_per_key
from tideline.plans.streams import PARTS, Arriving, StopOnce
from tideline.session import cut_lineage, new_folder, shared_root
from tideline.sources import feed
from tideline.sources.log import kafka_options, read_files
from tideline.streaming import ChangeSink, rebuild
from tideline.streaming.apply import start
from tideline.streaming.progress import progress_rows


def rows(df):
    return sorted(map(repr, df.collect()))


def whole(log):
    flat = changes(feed.to_log(log.events))
    return rows(latest_per_key(flat).select("table", "id", "op", "status")), rows(counters(flat)), rows(scores(flat))


def kept(log):
    return (
        rows(log.tables.latest.read().select("table", "id", "op", "status")),
        rows(log.tables.counters()),
        rows(log.tables.scores()),
    )


def test_restart_retry_and_fold(spark):
    log = Arriving(spark, SF_SMALL)
    log.arrive("c")
    log.apply()
    log.arrive("u")
    stop = StopOnce(1)
    with pytest.raises(Exception, match="stopped half-way"):
        log.apply(ChangeSink(log.tables, after_write=stop))
    # What the failed batch wrote is there, and counts in no table.
    assert (0, 1) in log.tables.latest._written()
    assert log.tables.deltas.batch_ids() == [0] and log.tables.latest.batch_ids() == [0]
    log.apply()
    assert log.tables.latest.fold() == 1 and log.tables.latest.fold() is None
    log.arrive("d")
    log.apply()
    assert kept(log) == whole(log)
    log.tables.fold()
    assert kept(log) == whole(log)
    assert log.tables.deltas.base_id() == 2


def test_retry_of_a_folded_batch_changes_nothing(spark):
    log = Arriving(spark, SF_SMALL)
    flat = cut_lineage(changes(feed.to_log(log.events)))
    sink = ChangeSink(log.tables)
    sink(flat, 0)
    log.tables.fold()
    sink(flat, 0)
    assert kept(log) == whole(log)


def test_parts_arrive_in_any_order(spark):
    log = Arriving(spark, SF_SMALL)
    for part in reversed(PARTS):
        log.arrive(part)
        log.apply(ChangeSink(log.tables, fold_every=2))
    assert log.tables.latest.base_id() == 1
    assert kept(log) == whole(log)


def test_empty_batch_leaves_no_trace(spark):
    log = Arriving(spark, SF_SMALL)
    ChangeSink(log.tables)(changes(feed.to_log(log.events)).where("false"), 0)
    assert log.tables.latest.batch_ids() == []
    assert log.tables.counters().count() == 0


@pytest.mark.parametrize("part", PARTS)
def test_a_part_builds_its_own_events_only(spark, part, capsys):
    log = Arriving(spark, SF_SMALL)
    asked = log.events_of((part,))
    assert rows(asked) == rows(log.events.where(F.col("op") == part))
    asked.explain(True)
    plan = capsys.readouterr().out
    # Events of the other ops are not in the plan, so neither are their images.
    assert [op for op in PARTS if f"op, {op}, off" in plan] == [part]


def test_nothing_new_runs_no_batch(spark):
    log = Arriving(spark, SF_SMALL)
    log.arrive("c")
    log.apply()
    query = log.apply()
    assert log.tables.latest.batch_ids() == [0]
    assert progress_rows(spark, query).where("num_input_rows > 0").count() == 0


def test_interval_trigger(spark):
    log = Arriving(spark, SF_SMALL)
    log.arrive("c")
    query = start(log.stream(), ChangeSink(log.tables), log.checkpoint, "200 milliseconds")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert log.tables.counters().count() > 0


def test_log_reads_back_as_written(spark):
    log = Arriving(spark, SF_SMALL)
    log.arrive_all()
    assert read_files(spark, log.path).count() == log.events.count()


def test_folders_are_under_the_shared_one_and_new(spark):
    first, second = new_folder(spark, "x"), new_folder(spark, "x")
    assert first != second and first.startswith(shared_root(spark))


def test_kafka_options():
    assert kafka_options("h:9", ["customers", "orders"], "latest") == {
        "kafka.bootstrap.servers": "h:9",
        "subscribe": "inventory.inventory.customers,inventory.inventory.orders",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    assert kafka_options("h:9", ["orders"], max_per_batch=5)["maxOffsetsPerTrigger"] == "5"


def test_rebuild_equals_the_stream(spark):
    log = Arriving(spark, SF_SMALL)
    log.arrive_all()
    rebuild(read_files(spark, log.path), log.tables)
    assert kept(log) == whole(log)
