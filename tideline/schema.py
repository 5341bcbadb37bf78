"""Schemas and fixed values of the change log and its tables."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: names and labels that results must carry ----
CUSTOMERS = "customers"
ORDERS = "orders"
SUPPLIERS = "suppliers"
TOPIC_PREFIX = "inventory.inventory."
STATUSES = ["PENDING", "PROCESSING", "SHIPPED", "DELIVERED", "CANCELLED"]
DEFAULT_STATUS = "PENDING"
KEY_CUSTOMERS_TOTAL = "customers:total"
KEY_ORDERS_TOTAL = "orders:total"
KEY_ORDERS_REVENUE = "orders:revenue"
KEY_STATUS_PREFIX = "orders:status:"
CUSTOMER_PREFIX = "customer:"
# ---- end of fixed values ----

AMOUNT = T.DecimalType(12, 2)
MONEY = T.DecimalType(38, 2)

# Every column of the union record. Ids are BIGINT: order ids outgrow INT.
RECORD_FIELDS: dict[str, T.DataType] = {
    "id": T.LongType(),
    "name": T.StringType(),
    "email": T.StringType(),
    "phone": T.StringType(),
    "created_at": T.StringType(),
    "customer_id": T.LongType(),
    "total_amount": T.StringType(),
    "status": T.StringType(),
    "order_date": T.StringType(),
}
# Fields that reach a sink; phone and the two dates are never parsed for them.
SINK_FIELDS = ("id", "name", "email", "customer_id", "total_amount", "status")

LOG_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def record_schema(fields=SINK_FIELDS) -> T.StructType:
    return T.StructType([T.StructField(name, RECORD_FIELDS[name]) for name in fields])


def event_schema(fields=SINK_FIELDS) -> T.StructType:
    """Envelope with the asked record fields; ``ts_ms``, ``file``, ``pos`` and ``row`` are optional in a log."""
    record = record_schema(fields)
    source = (
        T.StructType()
        .add("table", T.StringType())
        .add("ts_ms", T.LongType())
        .add("file", T.StringType())
        .add("pos", T.LongType())
        .add("row", T.LongType())
    )
    return (
        T.StructType()
        .add("before", record)
        .add("after", record)
        .add("op", T.StringType())
        .add("source", source)
    )


def topic_of(table: str) -> str:
    return TOPIC_PREFIX + table
