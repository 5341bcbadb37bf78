"""Serving aggregates over changes: totals, status breakdown, revenue, scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions import counter_sign, customer_key, decode_amount, status_key
from tideline.operators.envelope import change_order, route
from tideline.operators.state import survive_truncates
from tideline.rules import DEFAULT, Rules
from tideline.schema import (
    CUSTOMERS,
    KEY_CUSTOMERS_TOTAL,
    KEY_ORDERS_REVENUE,
    KEY_ORDERS_TOTAL,
    MONEY,
    ORDERS,
)

# Kinds of deltas that a batch adds.
COUNTER, SCORE, ROWS = "counter", "score", "rows"


def _order_sums() -> list:
    sign = counter_sign(F.col("op"))
    amount = F.coalesce(F.col("total_amount").cast(MONEY), F.lit(0).cast(MONEY))
    return [
        F.coalesce(F.sum(sign), F.lit(0)).cast("bigint").alias("n"),
        F.coalesce(F.sum((sign.cast("decimal(1,0)") * amount).cast(MONEY)), F.lit(0)).cast(MONEY).alias("revenue"),
    ]


def customers_total(flat: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    counted = F.lit(True) if rules.count_customer_deletes else ~F.col("op").eqNullSafe("d")
    return route(flat, CUSTOMERS).agg(F.count_if(counted).cast("bigint").alias("value"))


def orders_total(flat: DataFrame) -> DataFrame:
    return route(flat, ORDERS).agg(_order_sums()[0].alias("value"))


def orders_revenue(flat: DataFrame) -> DataFrame:
    return route(flat, ORDERS).agg(_order_sums()[1].alias("value"))


def orders_by_status(flat: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    keyed = route(flat, ORDERS).withColumn("key", status_key(F.col("status"), rules.null_status))
    return keyed.where(F.col("key").isNotNull()).groupBy("key").agg(_order_sums()[0].alias("value"))


def _grouped(flat: DataFrame, *by: str) -> DataFrame:
    """What any counter needs, summed over few groups before keys are built."""
    return flat.groupBy("table", "status", *by).agg(
        *_order_sums(),
        F.count_if(~F.col("op").eqNullSafe("d")).cast("bigint").alias("upserts"),
        F.count(F.lit(1)).cast("bigint").alias("rows"),
    )


def _entry(kind: str, key: Column, value: str) -> Column:
    return F.struct(F.lit(kind).alias("kind"), key.alias("key"), F.col(value).cast(MONEY).alias("value"))


def _customer_entries(rules: Rules) -> list[Column]:
    return [_entry(COUNTER, F.lit(KEY_CUSTOMERS_TOTAL), "rows" if rules.count_customer_deletes else "upserts")]


def _order_entries(rules: Rules) -> list[Column]:
    return [
        _entry(COUNTER, F.lit(KEY_ORDERS_TOTAL), "n"),
        _entry(COUNTER, F.lit(KEY_ORDERS_REVENUE), "revenue"),
        _entry(COUNTER, status_key(F.col("status"), rules.null_status), "n"),
    ]


def _summed(grouped: DataFrame, of_customers: list[Column], of_orders: list[Column]) -> DataFrame:
    entries = F.when(F.col("table") == CUSTOMERS, F.array(*of_customers)).when(
        F.col("table") == ORDERS, F.array(*of_orders)
    )
    return add_deltas(grouped.select(F.inline(entries)).where(F.col("key").isNotNull()))


def counters(flat: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """All counter keys in one pass: ``(key, value)``.

    Any subset of a log gives its delta; deltas add up.
    """
    return _summed(_grouped(flat), _customer_entries(rules), _order_entries(rules)).select("key", "value")


def scores(flat: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Upserts per customer; a delete never lowers a score."""
    upserts = route(flat, ORDERS).where(~F.col("op").eqNullSafe("d"))
    counted = upserts.groupBy("customer_id").agg(F.count(F.lit(1)).cast("bigint").alias("score"))
    return counted.select(customer_key(F.col("customer_id"), rules.null_member).alias("member"), "score")


def deltas(flat: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Everything a set of changes adds: counters, scores and row counts, ``(kind, key, value)``.

    One pass: sums per table, status and customer give all of them.
    """
    rows = _entry(ROWS, F.col("table"), "rows")
    score = _entry(SCORE, customer_key(F.col("customer_id"), rules.null_member), "upserts")
    # Groups of deletes alone give no score entry, so no member starts at zero.
    scored = F.when(F.col("upserts") > 0, score)
    return _summed(
        _grouped(flat, "customer_id"), [*_customer_entries(rules), rows], [*_order_entries(rules), scored, rows]
    )


def add_deltas(rows: DataFrame) -> DataFrame:
    return rows.groupBy("kind", "key").agg(F.sum("value").cast(MONEY).alias("value"))


def top_members(score_table: DataFrame, k: int) -> DataFrame:
    """Best ``k``; equal scores go by member name, last first."""
    return score_table.orderBy(F.desc("score"), F.desc("member")).limit(k)


def signed_images(parsed: DataFrame) -> DataFrame:
    """Both images of each event as signed rows: -1 for the row that was, +1 for the row that is."""
    sides = F.array(
        F.struct(F.lit(-1).cast("bigint").alias("sign"), F.col("before").alias("record")),
        F.struct(F.lit(1).cast("bigint").alias("sign"), F.col("after").alias("record")),
    )
    signed = parsed.select(F.col("source.table").alias("table"), F.inline(sides))
    return signed.where(F.col("record").isNotNull())


def net_counters(parsed: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """True totals by table and status: what the source holds, not how often it changed.

    Needs full before-images in the log. A truncate empties its table, so images from before the
    last one do not count.
    """
    placed = parsed.withColumn("table", F.col("source.table")).withColumn("ord", change_order())
    rows = signed_images(survive_truncates(placed, parsed)).where(F.col("table").isin(CUSTOMERS, ORDERS))
    amount = F.coalesce(decode_amount(F.col("record.total_amount")), F.lit(0).cast("decimal(12,2)"))
    status = F.col("record.status")
    if rules.null_status is not None:
        status = F.when(F.col("table") == ORDERS, F.coalesce(status, F.lit(rules.null_status)))
    return (
        rows.groupBy("table", status.alias("status"))
        .agg(
            F.sum("sign").cast("bigint").alias("n"),
            F.sum((F.col("sign").cast("decimal(1,0)") * amount).cast(MONEY)).cast(MONEY).alias("amount"),
        )
    )
