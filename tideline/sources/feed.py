"""A change log derived from the given tables.

Every row of a table gives a create event; a third of the orders are then shipped, a
seventh deleted, and so on. Nothing is left out of a table: the conditions below only
decide which further events a row goes through.

A change has ``table, id, op, off, ts_ms, before, after``. ``off`` counts up per key and
is unique per topic, ``ts_ms`` is the commit time and compares across topics.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions import encode_amount
from tideline.schema import AMOUNT, CUSTOMERS, ORDERS, SUPPLIERS, TOPIC_PREFIX, record_schema

DAY_MS = 86_400_000
# Instants of the customer life cycle in the derived log.
CUSTOMER_CREATED = "1994-01-01 00:00:00"
CUSTOMER_CHANGED = "1997-01-01 00:00:00"
CUSTOMER_DELETED = "2000-01-01 00:00:00"
CUSTOMER_REJOINED = "2000-07-01 00:00:00"

_CHANGE_FIELDS = ("id", "name", "email", "phone", "customer_id", "total_amount", "status")
_RECORD = record_schema(_CHANGE_FIELDS)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_rows(orders: DataFrame) -> DataFrame:
    """Order table in its source shape: id, customer_id, order_date, total_amount, status."""
    status = (
        F.when(F.col("o_orderstatus") == "O", "PENDING")
        .when(F.col("o_orderstatus") == "P", "PROCESSING")
        .otherwise("DELIVERED")
    )
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_totalprice").cast(AMOUNT).alias("total_amount"),
        status.alias("status"),
    )


def customer_rows(customer: DataFrame) -> DataFrame:
    """Customer table in its source shape: id, name, email, phone."""
    mailbox = F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit(".")))
    return customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.concat(mailbox, F.lit("@example.com")).alias("email"),
        F.concat(F.lit("09"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias("phone"),
    )


def _record(**fields: Column) -> Column:
    columns = [
        fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in _RECORD.fields
    ]
    return F.struct(*columns)


def _event(op: str, step: int, ts_ms: Column, before: Column | None, after: Column | None) -> Column:
    nothing = F.lit(None).cast(_RECORD)
    return F.struct(
        F.lit(op).alias("op"),
        (F.col("id") * 4 + step).alias("off"),
        ts_ms.cast("bigint").alias("ts_ms"),
        (nothing if before is None else before).alias("before"),
        (nothing if after is None else after).alias("after"),
    )


def spread_out(rows: DataFrame) -> DataFrame:
    """Use all cores when the input has fewer splits than that.

    A log costs far more per row to build and parse than to move, and a small table is
    one split. Tables with enough splits stay as they are, without a shuffle.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def _unfold(rows: DataFrame, table: str, events: list[Column]) -> DataFrame:
    """One narrow pass: each row becomes the events of its life cycle."""
    unfolded = rows.select(F.lit(table).alias("table"), F.col("id"), F.inline(F.array(*events)))
    return unfolded.where(F.col("op").isNotNull())


def _cycle(rows: DataFrame, table: str, steps: list[tuple[str, Column, Column]], ops: tuple[str, ...]) -> DataFrame:
    """Events of the asked ops only. ``steps``: op, which rows go through it, and its event; other rows and images are not built."""
    asked = [(which, event) for op, which, event in steps if op in ops]
    met = rows.where(reduce(lambda a, b: a | b, [which for which, _ in asked], F.lit(False)))
    return _unfold(met, table, [F.when(which, event) for which, event in asked])


ALL_OPS = ("c", "u", "d")


def order_changes(rows: DataFrame, ops: tuple[str, ...] = ALL_OPS) -> DataFrame:
    """Create, ship (every third id), delete (every seventh id)."""

    def image(status: Column) -> Column:
        return _record(
            id=F.col("id"),
            customer_id=F.col("customer_id"),
            total_amount=F.col("coded"),
            status=status,
        )

    # Encoded once per row, not once per image.
    rows = spread_out(rows).withColumn("coded", encode_amount(F.col("total_amount")))
    shipped = F.col("id") % 3 == 0
    deleted = F.col("id") % 7 == 0
    placed = F.unix_millis(F.col("order_date").cast("timestamp"))
    first, second = image(F.col("status")), image(F.lit("SHIPPED"))
    return _cycle(
        rows,
        ORDERS,
        [
            ("c", F.lit(True), _event("c", 0, placed, None, first)),
            ("u", shipped, _event("u", 1, placed + DAY_MS, first, second)),
            ("d", deleted, _event("d", 2, placed + 2 * DAY_MS, F.when(shipped, second).otherwise(first), None)),
        ],
        ops,
    )


def customer_changes(rows: DataFrame, ops: tuple[str, ...] = ALL_OPS) -> DataFrame:
    """Create, new address (every fifth id), delete (every 11th), come back (every 22nd)."""

    def image(email: Column) -> Column:
        return _record(id=F.col("id"), name=F.col("name"), email=email, phone=F.col("phone"))

    def at(instant: str) -> Column:
        return F.unix_millis(F.lit(instant).cast("timestamp"))

    moved = F.col("id") % 5 == 0
    left = F.col("id") % 11 == 0
    back = F.col("id") % 22 == 0
    first = image(F.col("email"))
    second = image(F.concat(F.lit("new."), F.col("email")))
    third = image(F.concat(F.lit("back."), F.col("email")))
    return _cycle(
        spread_out(rows),
        CUSTOMERS,
        [
            ("c", F.lit(True), _event("c", 0, at(CUSTOMER_CREATED), None, first)),
            ("u", moved, _event("u", 1, at(CUSTOMER_CHANGED), first, second)),
            ("d", left, _event("d", 2, at(CUSTOMER_DELETED), F.when(moved, second).otherwise(first), None)),
            ("c", back, _event("c", 3, at(CUSTOMER_REJOINED), None, third)),
        ],
        ops,
    )


def supplier_changes(supplier: DataFrame) -> DataFrame:
    """Creates of a table that the engine is not asked to follow."""
    rows = supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    created = F.unix_millis(F.lit(CUSTOMER_CREATED).cast("timestamp"))
    return _unfold(
        rows, SUPPLIERS, [_event("c", 0, created, None, _record(id=F.col("id"), name=F.col("name")))]
    )


def snapshot_changes(rows: DataFrame, table: str) -> DataFrame:
    """Current rows of a table as snapshot reads (``r``), without a log position."""
    if table == ORDERS:
        after = _record(
            id=F.col("id"),
            customer_id=F.col("customer_id"),
            total_amount=encode_amount(F.col("total_amount")),
            status=F.col("status"),
        )
    else:
        after = _record(id=F.col("id"), name=F.col("name"), email=F.col("email"), phone=F.col("phone"))
    event = _event("r", 0, F.lit(None), None, after)
    return _unfold(rows, table, [event]).withColumn("off", F.lit(-1).cast("bigint"))


def to_log(changes: DataFrame, partitions: int = 3, wrapped: bool = False) -> DataFrame:
    """Log records with the transport's columns; ``wrapped`` puts the envelope under ``payload``."""
    envelope = F.struct(
        "before", "after", "op", F.struct(F.col("table"), F.col("ts_ms")).alias("source")
    )
    body = F.struct(envelope.alias("payload")) if wrapped else envelope
    return changes.select(
        F.to_json(F.struct("id")).cast("binary").alias("key"),
        F.to_json(body).cast("binary").alias("value"),
        F.concat(F.lit(TOPIC_PREFIX), F.col("table")).alias("topic"),
        F.pmod(F.col("id"), F.lit(partitions)).cast("int").alias("partition"),
        F.col("off").alias("offset"),
        F.timestamp_millis(F.col("ts_ms")).alias("timestamp"),
    )


def tombstones(changes: DataFrame, partitions: int = 3) -> DataFrame:
    """The empty record that follows each delete so that a compacted log can forget the key."""
    gone = changes.where(F.col("op") == "d").withColumn("off", F.col("off") + 1)
    return to_log(gone, partitions).withColumn("value", F.lit(None).cast("binary"))


def stray_messages(events: DataFrame) -> DataFrame:
    """Messages on the orders topic that are no change events: bare JSON and plain text."""
    # Positions above every order event are not needed: strays have no key and no effect.
    text = F.when(F.col("event_type") == "error", F.concat_ws(" ", "event_type", F.col("ts").cast("string")))
    return events.select(
        F.lit(None).cast("binary").alias("key"),
        F.coalesce(text, F.col("props")).cast("binary").alias("value"),
        F.lit(TOPIC_PREFIX + ORDERS).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
