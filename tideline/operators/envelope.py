"""Change events: parse, choose the row image, flatten, mask, route, reject."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions import decode_amount, mask_email
from tideline.rules import DEFAULT, Rules
from tideline.schema import CUSTOMERS, ORDERS, SINK_FIELDS, STATUSES, DEFAULT_STATUS, event_schema

FLAT_COLUMNS = ["op", "table", "id", "name", "masked_email", "customer_id", "total_amount", "status"]
FOLLOWED = [CUSTOMERS, ORDERS]
PLACE = ("topic", "partition", "offset")


def parse_events(
    log: DataFrame, wrapped: bool = False, fields: tuple[str, ...] = SINK_FIELDS, keep: tuple[str, ...] = ("offset",)
) -> DataFrame:
    """Envelope columns ``before, after, op, source`` beside the kept log columns.

    ``inline`` over a one-element array is a barrier for filter push-down: without it
    the optimizer repeats the JSON parse for every later predicate.
    """
    text = F.col("value").cast("string")
    if wrapped:
        text = F.coalesce(F.get_json_object(text, "$.payload"), text)
    event = F.from_json(text, event_schema(fields))
    return log.select(*keep, F.inline(F.array(event)))


def row_image(events: DataFrame) -> DataFrame:
    """``record`` is the row before a delete and the row after anything else."""
    return events.withColumn("record", F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after")))


def drop_empty_image(events: DataFrame) -> DataFrame:
    """Tombstones, malformed messages and truncates have no image."""
    return events.where(F.col("record").isNotNull())


def change_order(events_have_offset: bool = True) -> Column:
    """Sort key of changes: commit time, log file, position and row, then offset within a partition.

    Commit times have steps of a second, and positions start again in each log file, whose
    number its name ends with. A snapshot read without a position comes before every change. Offsets alone compare
    only within one partition, so a log whose partition count changes needs positions.
    """
    return F.struct(
        F.coalesce(F.col("source.ts_ms"), F.lit(-1)).cast("bigint").alias("ts_ms"),
        F.coalesce(F.regexp_extract("source.file", "([0-9]{1,18})$", 1).try_cast("bigint"), F.lit(-1)).alias("file"),
        F.coalesce(F.col("source.pos"), F.lit(-1)).cast("bigint").alias("pos"),
        F.coalesce(F.col("source.row"), F.lit(-1)).cast("bigint").alias("row"),
        F.when(F.col("op") == "r", 0).otherwise(1).alias("is_change"),
        (F.col("offset") if events_have_offset else F.lit(0)).cast("bigint").alias("offset"),
    )


def reject_reason(rules: Rules = DEFAULT) -> Column:
    """Why an event leads to no row change; NULL for an event that is applied."""
    empty = F.col("op").isNull() & F.col("before").isNull() & F.col("after").isNull()
    table = F.col("source.table")
    reason = (
        F.when(F.col("value_missing"), "tombstone")
        .when(empty, "malformed")
        .when((F.col("op") == "t") & F.col("record").isNull(), "truncate")
        .when(F.col("record").isNull(), "no_image")
        .when(table.isNull() | ~table.isin(FOLLOWED), "unknown_table")
    )
    if rules.null_key is None:
        reason = reason.when(F.col("record.id").isNull(), "no_key")
    return reason


def _judged(log: DataFrame, rules: Rules, wrapped: bool, keep: tuple[str, ...]) -> DataFrame:
    marked = log.withColumn("value_missing", F.col("value").isNull())
    events = row_image(parse_events(marked, wrapped, keep=(*keep, "value_missing")))
    return events.withColumn("reason", reject_reason(rules))


def reject_ledger(log: DataFrame, rules: Rules = DEFAULT, wrapped: bool = False) -> DataFrame:
    """Every event that changes nothing, with its place in the log and the reason."""
    judged = _judged(log, rules, wrapped, PLACE)
    return judged.where(F.col("reason").isNotNull()).select(
        *PLACE, "op", F.col("source.table").alias("table"), "reason"
    )


def flatten(events: DataFrame, rules: Rules = DEFAULT, with_order: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """The flat change row, and the kept columns beside it. Raw e-mail and phone end here."""
    amount = decode_amount(F.col("record.total_amount"))
    if rules.bad_amount_as_zero:
        amount = F.coalesce(amount, F.lit(0).cast("decimal(12,2)"))
    key = F.col("record.id")
    if rules.null_key is not None:
        key = F.coalesce(key, F.lit(rules.null_key).cast("bigint"))
    columns = [
        F.col("op"),
        F.col("source.table").alias("table"),
        key.alias("id"),
        F.col("record.name").alias("name"),
        mask_email(F.col("record.email"), rules.drop_trailing_empty_part).alias("masked_email"),
        F.col("record.customer_id").alias("customer_id"),
        amount.alias("total_amount"),
        F.col("record.status").alias("status"),
    ]
    if with_order:
        columns.append(change_order().alias("ord"))
    return events.select(*columns, *keep)


def changes(log: DataFrame, rules: Rules = DEFAULT, wrapped: bool = False, with_order: bool = True) -> DataFrame:
    """Log to flat changes of the followed tables: what a sink applies."""
    judged = _judged(log, rules, wrapped, ("offset",))
    return flatten(judged.where(F.col("reason").isNull()), rules, with_order)


def judged_changes(log: DataFrame, rules: Rules = DEFAULT, wrapped: bool = False) -> DataFrame:
    """``changes`` and, with a ``reason`` and their place in the log, the events that change no row: one parse for both."""
    judged = _judged(log, rules, wrapped, PLACE)
    return flatten(judged, rules, True, ("reason", *PLACE))


def after_only(events: DataFrame) -> DataFrame:
    """Columns of the after-image; a delete gives a row of NULLs."""
    return events.select("after.*")


def route(flat: DataFrame, table: str) -> DataFrame:
    return flat.where(F.col("table") == table)


def status_domain(rows: DataFrame) -> DataFrame:
    """Insert default for a missing status and a check against the known ones."""
    return rows.withColumn("status_out", F.coalesce("status", F.lit(DEFAULT_STATUS))).withColumn(
        "in_domain", F.col("status_out").isin(STATUSES)
    )
