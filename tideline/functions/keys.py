"""Keys of the serving store and NULL defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tideline.schema import CUSTOMER_PREFIX, KEY_STATUS_PREFIX


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def customer_key(customer_id: Column, null_label: str = "UNKNOWN") -> Column:
    return F.concat(F.lit(CUSTOMER_PREFIX), F.coalesce(customer_id.cast("string"), F.lit(null_label)))


def status_key(status: Column, null_label: str | None = "UNKNOWN") -> Column:
    """NULL when NULL statuses are left out."""
    label = status if null_label is None else F.coalesce(status, F.lit(null_label))
    return F.concat(F.lit(KEY_STATUS_PREFIX), label)


def counter_sign(op: Column) -> Column:
    """-1 for a delete, +1 for everything else, a missing op included."""
    return F.when(op == "d", F.lit(-1)).otherwise(F.lit(1)).cast("bigint")
