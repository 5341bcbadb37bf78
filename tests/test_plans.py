"""Shapes of the physical plans, and totals worked out beforehand."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import SF_MIDDLE
from tideline.plans import all_queries, logs
from tideline.session import new_folder
from tideline.sources.log import read_files, subscribe


def plan_of(df, capsys):
    df.explain()
    return capsys.readouterr().out


def test_known_totals(spark):
    run = {n: all_queries()[n](spark, SF_MIDDLE) for n in ("doc_state_orders", "orders_total", "orders_revenue", "orders_by_status", "top_customers")}
    state = run["doc_state_orders"].agg(F.count("*").alias("n"), F.sum("total_amount").alias("a")).first()
    assert (state.n, state.a) == (12_857, Decimal("3226754391.26"))
    assert run["orders_total"].first().value == 17_857
    assert run["orders_revenue"].first().value == Decimal("4461572909.22")
    assert {r.key.rsplit(":", 1)[1]: r.value for r in run["orders_by_status"].collect()} == {
        "DELIVERED": 4473, "PENDING": 4500, "PROCESSING": 4599, "SHIPPED": 4285,
    }
    assert [(r.member, r.score) for r in run["top_customers"].take(3)] == [
        ("customer:605", 37), ("customer:1242", 30), ("customer:1001", 30),
    ]


def test_range_reaches_the_scan(spark, capsys):
    plan = plan_of(all_queries()["id_range_count"](spark, SF_MIDDLE), capsys)
    assert "GreaterThanOrEqual(o_orderkey,1000)" in plan and "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_topics_reach_the_scan_of_a_stored_log(spark, capsys):
    path = new_folder(spark, "log")
    logs.both_log(spark, SF_MIDDLE).write.parquet(path)
    plan = plan_of(subscribe(read_files(spark, path), ["orders"]), capsys)
    assert "EqualTo(topic,inventory.inventory.orders)" in plan


def test_top_k_sorts_no_whole_table(spark, capsys):
    assert "TakeOrderedAndProject" in plan_of(all_queries()["top_customers"](spark, SF_MIDDLE), capsys)


def test_counters_combine_before_the_shuffle(spark, capsys):
    plan = plan_of(all_queries()["counters_all"](spark, SF_MIDDLE), capsys)
    assert "partial_sum" in plan and "SortAggregate" not in plan and "from_json" in plan


def test_state_shuffles_only_what_documents_need(spark, capsys):
    plan = plan_of(all_queries()["doc_state_orders"](spark, SF_MIDDLE), capsys)
    partial = next(line for line in plan.splitlines() if "partial_max" in line)
    assert "masked_email" not in partial and "total_amount" in partial


def test_row_reconciliation_shuffles_each_side_once(spark, capsys):
    plan = plan_of(all_queries()["reconcile_rows"](spark, SF_MIDDLE), capsys)
    assert plan.count("Exchange hashpartitioning") == 2


def test_no_python_in_any_hot_plan(spark, capsys):
    for name in ("doc_state_orders", "counters_all", "net_counters", "flatten_change", "rate_30s", "resample"):
        plan = plan_of(all_queries()[name](spark, SF_MIDDLE), capsys)
        assert "PythonUDF" not in plan and "EvalPython" not in plan
