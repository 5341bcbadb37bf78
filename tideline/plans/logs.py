"""Logs that the queries read, and the same events as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.envelope import changes
from tideline.schema import CUSTOMERS, ORDERS
from tideline.session import new_folder, prepare
from tideline.sources import feed
from tideline.sources.log import read_files, subscribe


def order_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.order_rows(feed.read_table(prepare(spark), sf_dir, "orders"))


def customer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.customer_rows(feed.read_table(prepare(spark), sf_dir, "customer"))


def order_events(spark: SparkSession, sf_dir: str, ops: tuple[str, ...] = feed.ALL_OPS) -> DataFrame:
    return feed.order_changes(order_table(spark, sf_dir), ops)


def customer_events(spark: SparkSession, sf_dir: str, ops: tuple[str, ...] = feed.ALL_OPS) -> DataFrame:
    return feed.customer_changes(customer_table(spark, sf_dir), ops)


def supplier_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.supplier_changes(feed.read_table(prepare(spark), sf_dir, "supplier"))


# Folders of the logs written so far, by application, tables and log name.
_WRITTEN: dict[tuple[str, str, str], str] = {}


def _stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The log as files, one folder per topic, written when a session first asks for it.

    A log is an input: queries read it as it lies there, only the topics they follow.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        path = new_folder(spark, f"log-{name}")
        build().write.partitionBy("topic").parquet(path)
        _WRITTEN[key] = path
    return read_files(spark, _WRITTEN[key])


def every_topic_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and orders, and a table that is not followed."""

    def build() -> DataFrame:
        events = [order_events(spark, sf_dir), customer_events(spark, sf_dir), supplier_events(spark, sf_dir)]
        return feed.to_log(feed.union_all(events))

    return _stored(prepare(spark), sf_dir, "topics", build)


def rough_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With tombstones and messages that are no events."""

    def build() -> DataFrame:
        gone = [feed.tombstones(order_events(spark, sf_dir)), feed.tombstones(customer_events(spark, sf_dir))]
        return feed.union_all([*gone, feed.stray_messages(feed.read_table(spark, sf_dir, "events"))])

    return every_topic_log(spark, sf_dir).unionByName(_stored(spark, sf_dir, "strays", build))


def both_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and orders, one log."""
    return subscribe(every_topic_log(spark, sf_dir), [CUSTOMERS, ORDERS])


def orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subscribe(every_topic_log(spark, sf_dir), [ORDERS])


def customers_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subscribe(every_topic_log(spark, sf_dir), [CUSTOMERS])


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes(orders_log(spark, sf_dir))


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes(customers_log(spark, sf_dir))


def both_changes(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return changes(both_log(spark, sf_dir), **options)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric readings: events by type, with values as exact hundredths."""
    events = feed.read_table(prepare(spark), sf_dir, "events")
    return events.select(
        "event_id", F.col("event_type").alias("name"), "ts", F.col("value").cast("decimal(18,2)").alias("value")
    )



# The same events as SQL: ob/cb are the source rows, oe/ce their change events.
ORDER_CTE = """
ob as (select o_orderkey id, o_custkey cid, cast(o_totalprice as decimal(12,2)) amt,
              case o_orderstatus when 'O' then 'PENDING' when 'P' then 'PROCESSING' else 'DELIVERED' end st,
              epoch_ms(o_orderdate) ms from orders),
oe as (select id*4 off, 'c' op, id, cid, amt, st, ms ts from ob
       union all select id*4+1, 'u', id, cid, amt, 'SHIPPED', ms+86400000 from ob where id%3=0
       union all select id*4+2, 'd', id, cid, amt, case when id%3=0 then 'SHIPPED' else st end,
                        ms+172800000 from ob where id%7=0)
"""
CUSTOMER_CTE = """
cb as (select c_custkey id, c_name nm, lower(replace(c_name,'#','.')) || '@example.com' em from customer),
ce as (select id*4 off, 'c' op, id, nm, em, epoch_ms(timestamp '1994-01-01') ts from cb
       union all select id*4+1, 'u', id, nm, 'new.' || em, epoch_ms(timestamp '1997-01-01') from cb where id%5=0
       union all select id*4+2, 'd', id, nm, case when id%5=0 then 'new.' || em else em end,
                        epoch_ms(timestamp '2000-01-01') from cb where id%11=0
       union all select id*4+3, 'c', id, nm, 'back.' || em, epoch_ms(timestamp '2000-07-01') from cb where id%22=0)
"""
ORDER_LATEST_CTE = ORDER_CTE + """,
ol as (select * exclude (rn) from (select *, row_number() over (partition by id order by off desc) rn from oe) where rn=1)
"""
CUSTOMER_LATEST_CTE = CUSTOMER_CTE + """,
cl as (select * exclude (rn) from (select *, row_number() over (partition by id order by off desc) rn from ce) where rn=1)
"""


def masked(email: str) -> str:
    """SQL for the mask of an address that is known to have one ``@`` and a long local part."""
    local = f"split_part({email}, '@', 1)"
    return (
        f"left({local}, 1) || repeat('*', length({local}) - 2) || right({local}, 1) || '@' || split_part({email}, '@', 2)"
    )
