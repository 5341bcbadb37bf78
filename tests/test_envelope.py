"""Hand-written events: odd messages, both envelopes, both rule sets."""

from __future__ import annotations

import base64
import json

import pytest
from pyspark.sql import functions as F

from tideline.operators.counters import counters, customers_total, net_counters, scores, top_members
from tideline.operators.envelope import (
    FLAT_COLUMNS,
    changes,
    drop_empty_image,
    parse_events,
    reject_ledger,
    row_image,
)
from tideline.operators.state import (
    customer_documents,
    customer_hashes,
    latest_per_key,
    order_documents,
    survive_truncates,
)
from tideline.rules import Rules
from tideline.schema import LOG_SCHEMA


def log_of(spark, values, topic="inventory.inventory.orders"):
    rows = [
        (None, None if v is None else bytearray((v if isinstance(v, str) else json.dumps(v)).encode()), topic, 0, i, None)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, LOG_SCHEMA)


def amount(cents):
    n = max(1, (cents.bit_length() + 8) // 8)
    return base64.b64encode(cents.to_bytes(n, "big", signed=True)).decode()


def order(op, id, status="PENDING", cents=100, customer=1, before=None, ts=None):
    image = {"id": id, "customer_id": customer, "total_amount": amount(cents), "status": status}
    source = {"table": "orders"} | ({"ts_ms": ts} if ts is not None else {})
    if op == "d":
        return {"before": image, "after": None, "op": op, "source": source}
    return {"before": before, "after": image, "op": op, "source": source}


def customer(op, id, name="Name", email="abcd@x"):
    image = {"id": id, "name": name, "email": email}
    sides = {"before": image, "after": None} if op == "d" else {"before": None, "after": image}
    return sides | {"op": op, "source": {"table": "customers"}}


ODD = [
    None,
    "not json",
    order("c", 3_000_000_000),
    {"after": {"id": 5}, "source": {"table": "orders"}},
    {"payload": order("c", 6)},
    {"op": "t", "source": {"table": "orders"}},
    {"before": None, "after": None, "op": "u", "source": {"table": "orders"}},
    {"after": {"id": 8}, "op": "c", "source": {"table": "suppliers"}},
    {"after": {"name": "x"}, "op": "c", "source": {"table": "customers"}},
    {"after": {"id": 9}, "op": "c"},
    order("c", 10, cents=-7),
]


def test_what_is_applied(spark):
    rows = {r.id: r for r in changes(log_of(spark, ODD)).collect()}
    assert set(rows) == {3_000_000_000, 5, 10}
    assert rows[5].op is None
    assert str(rows[10].total_amount) == "-0.07"


def test_what_is_rejected(spark):
    reasons = {r.offset: r.reason for r in reject_ledger(log_of(spark, ODD)).collect()}
    assert reasons == {
        0: "tombstone", 1: "malformed", 4: "malformed", 5: "truncate", 6: "no_image",
        7: "unknown_table", 8: "no_key", 9: "unknown_table",
    }


def test_applied_and_rejected_are_everything(spark):
    log = log_of(spark, ODD)
    assert changes(log).count() + reject_ledger(log).count() == len(ODD)


def test_wrapped_and_bare_together(spark):
    log = log_of(spark, [{"payload": order("c", 6)}, order("c", 7)])
    assert sorted(r.id for r in changes(log, wrapped=True).collect()) == [6, 7]


def test_null_key_becomes_zero_under_the_scala_rules(spark):
    rows = changes(log_of(spark, [ODD[8]]), Rules.scala_job()).collect()
    assert [r.id for r in rows] == [0]


def test_flat_columns_hold_no_raw_contact(spark):
    flat = changes(log_of(spark, [customer("c", 1)]), with_order=False)
    assert flat.columns == FLAT_COLUMNS
    assert flat.first().masked_email == "a**d@x"


def test_one_parse_in_the_plan(spark, capsys):
    changes(log_of(spark, ODD)).explain()
    plan = capsys.readouterr().out
    assert plan.count("from_json") == 1
    assert "Python" not in plan.replace("PythonRDD", "")


def test_image_by_op(spark):
    events = drop_empty_image(row_image(parse_events(log_of(spark, [order("c", 1), order("d", 2)]))))
    assert sorted((r.op, r.record.id) for r in events.collect()) == [("c", 1), ("d", 2)]


def test_order_goes_by_commit_time_before_offset(spark):
    log = log_of(spark, [order("u", 1, "SHIPPED", ts=20), order("c", 1, "PENDING", ts=10)])
    assert latest_per_key(changes(log)).first().status == "SHIPPED"


def test_order_goes_by_position_before_offset(spark):
    events = [order("u", 1, "SHIPPED", ts=10), order("c", 1, "PENDING", ts=10)]
    events[0]["source"]["pos"], events[1]["source"]["pos"] = 9, 8
    assert latest_per_key(changes(log_of(spark, events))).first().status == "SHIPPED"


def test_ids_that_are_no_whole_numbers(spark):
    events = [{"after": {"id": i}, "op": "c", "source": {"table": "orders"}} for i in ("8", 8.5)]
    assert [r.reason for r in reject_ledger(log_of(spark, events)).collect()] == ["no_key", "no_key"]


def test_snapshot_read_loses_to_changes_around_it(spark):
    log = log_of(spark, [order("u", 1, "SHIPPED"), order("r", 1, "PENDING"), order("r", 2, "PENDING")])
    docs = {r._id: r.status for r in order_documents(latest_per_key(changes(log))).collect()}
    assert docs == {1: "SHIPPED", 2: "PENDING"}


def test_deletes_under_both_rule_sets(spark):
    log = log_of(spark, [customer("c", 1, name=None, email=None), customer("c", 2), customer("d", 2)])
    latest = latest_per_key(changes(log))
    assert [tuple(r) for r in customer_documents(latest).collect()] == [(1, "", "")]
    kept = customer_documents(latest, Rules.python_job()).orderBy("id").collect()
    assert [tuple(r) for r in kept] == [(1, None, None, 1), (2, "Name", "a**d@x", 2)]
    assert [tuple(r) for r in customer_hashes(latest, Rules.python_job()).collect()] == [("customer:1", "1", "", "")]


def test_counters_under_both_rule_sets(spark):
    events = [
        customer("c", 1), customer("u", 1), customer("d", 1),
        order("c", 1, None, 150), order("c", 2, "SHIPPED", 250), order("d", 2, "SHIPPED", 250),
        {"after": {"id": 3, "total_amount": "???"}, "op": "c", "source": {"table": "orders"}},
    ]
    flat = changes(log_of(spark, events))
    got = {r.key: str(r.value) for r in counters(flat).collect()}
    assert got == {
        "customers:total": "2.00", "orders:total": "2.00", "orders:revenue": "1.50",
        "orders:status:UNKNOWN": "2.00", "orders:status:SHIPPED": "0.00",
    }
    python = {r.key: str(r.value) for r in counters(flat, Rules.python_job()).collect()}
    assert python["customers:total"] == "3.00"
    assert "orders:status:UNKNOWN" not in python and python["orders:total"] == "2.00"
    assert customers_total(flat, Rules.python_job()).first().value == 3
    members = {r.member: r.score for r in scores(flat).collect()}
    assert members == {"customer:1": 2, "customer:UNKNOWN": 1}


def test_bad_amount_is_zero_under_the_scala_rules(spark):
    event = {"after": {"id": 3, "total_amount": "???"}, "op": "c", "source": {"table": "orders"}}
    log = log_of(spark, [event])
    assert changes(log).first().total_amount is None
    assert changes(log, Rules.scala_job()).first().total_amount == 0
    assert order_documents(latest_per_key(changes(log, Rules.scala_job())), Rules.scala_job()).first().total_amount == 0.0


def test_net_counters_follow_updates(spark):
    first = {"id": 1, "customer_id": 1, "total_amount": amount(100), "status": "PENDING"}
    events = [order("c", 1), order("u", 1, "SHIPPED", 300, before=first), order("c", 2, "SHIPPED", 50)]
    got = {r.status: (r.n, str(r.amount)) for r in net_counters(parse_events(log_of(spark, events))).collect()}
    assert got == {"PENDING": (0, "0.00"), "SHIPPED": (2, "3.50")}


def test_equal_scores_go_by_member_name_last_first(spark):
    table = spark.createDataFrame([("customer:10", 2), ("customer:9", 2), ("customer:1", 3)], "member string, score bigint")
    assert [r.member for r in top_members(table, 2).collect()] == ["customer:1", "customer:9"]


def test_truncate_clears_what_came_before(spark):
    log = log_of(spark, [order("c", 1), {"op": "t", "source": {"table": "orders"}}, order("c", 2)])
    kept = survive_truncates(changes(log), parse_events(log))
    assert [r.id for r in kept.collect()] == [2]


@pytest.mark.parametrize("seed", [1, 2])
def test_deltas_add_up(spark, seed):
    events = [order("c" if i % 4 else "d", i % 11, ["PENDING", "SHIPPED"][i % 2], i) for i in range(200)]
    flat = changes(log_of(spark, events))
    whole = {r.key: r.value for r in counters(flat).collect()}
    part = F.xxhash64(F.col("ord.offset"), F.lit(seed)) % 2 == 0
    halves = [{r.key: r.value for r in counters(flat.where(p)).collect()} for p in (part, ~part)]
    summed = {k: sum(h.get(k, 0) for h in halves) for k in whole}
    assert summed == whole
