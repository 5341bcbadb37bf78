"""Current state by key: latest change, deletes, truncates, cascades, documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions import customer_key, or_empty
from tideline.operators.envelope import change_order, route
from tideline.operators.joins import MAX_BROADCAST_ROWS, join_small
from tideline.rules import DEFAULT, Rules
from tideline.schema import CUSTOMERS, ORDERS
from tideline.session import cut_lineage

# The id leads: sorts compare it first, and it settles nearly every comparison.
KEYS = ["id", "table"]
# What the documents of a table are made of.
ORDER_VALUES = ["op", "customer_id", "total_amount", "status"]
CUSTOMER_VALUES = ["op", "name", "masked_email"]


def latest_per_key(changes: DataFrame, keep: list[str] | None = None, keys: list[str] = KEYS) -> DataFrame:
    """Last change of each key by ``ord``, with the kept columns only.

    The largest struct is combined before the shuffle, so a key with a third of all events
    sends one row per input partition. Columns left out never reach the shuffle.
    """
    kept = [c for c in (keep or changes.columns) if c not in keys]
    last = F.max(F.struct("ord", *[c for c in kept if c != "ord"])).alias("last")
    picked = [F.col(f"last.{c}").alias(c) for c in kept]
    return changes.groupBy(*keys).agg(last).select(*keys, *picked)


def latest_of(changes: DataFrame, table: str, keep: list[str]) -> DataFrame:
    """Last change of each key of one table, partitioned by the id alone.

    A later join on the id then needs no further shuffle of the state.
    """
    latest = latest_per_key(route(changes, table), keep, keys=["id"])
    return latest.select(F.lit(table).alias("table"), *latest.columns)


def is_live(rules: Rules = DEFAULT) -> Column:
    """A missing op counts as an upsert."""
    if not rules.delete_documents:
        return F.lit(True)
    return ~F.col("op").eqNullSafe("d")


def live_rows(latest: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    return latest.where(is_live(rules))


def customer_documents(latest: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    rows = live_rows(route(latest, CUSTOMERS), rules)
    if rules.wide_documents:
        return rows.select("id", "name", "masked_email", F.col("id").alias("_id"))
    return rows.select(
        F.col("id").alias("_id"), or_empty(F.col("name")).alias("name"), or_empty(F.col("masked_email")).alias("email")
    )


def order_documents(latest: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    rows = live_rows(route(latest, ORDERS), rules)
    if rules.wide_documents:
        return rows.select("id", "customer_id", "total_amount", "status", F.col("id").alias("_id"))
    amount = F.col("total_amount").cast("double") if rules.amount_as_double else F.col("total_amount")
    status = F.col("status") if rules.null_status is None else F.coalesce("status", F.lit(rules.null_status))
    return rows.select(F.col("id").alias("_id"), "customer_id", amount.alias("total_amount"), status.alias("status"))


def customer_hashes(latest: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Serving-store hash per customer; deletes remove it under every rule set."""
    rows = route(latest, CUSTOMERS).where(~F.col("op").eqNullSafe("d"))
    return rows.select(
        customer_key(F.col("id"), rules.null_member).alias("key"),
        F.coalesce(F.col("id").cast("string"), F.lit(rules.null_member)).alias("id"),
        or_empty(F.col("name")).alias("name"),
        or_empty(F.col("masked_email")).alias("email"),
    )


def deleted_keys(latest: DataFrame) -> DataFrame:
    return latest.where(F.col("op") == "d").select(*KEYS)


def survive_truncates(changes: DataFrame, events: DataFrame) -> DataFrame:
    """Drop the changes of a table that come before its last truncate.

    ``events`` are parsed events with the ``t`` ones still inside. Their last positions
    are one row per table, so that side is counted and broadcast.
    """
    cuts = (
        events.where(F.col("op") == "t")
        .select(F.col("source.table").alias("table"), change_order().alias("cut"))
        .groupBy("table")
        .agg(F.max("cut").alias("cut"))
    )
    return after_cuts(changes, cuts)


def after_cuts(changes: DataFrame, cuts: DataFrame) -> DataFrame:
    """Changes after the ``cut`` of their table; a table without one keeps all."""
    joined = join_small(changes, cuts, ["table"], "left")
    return joined.where(F.col("cut").isNull() | (F.col("ord") > F.col("cut"))).drop("cut")


def cascade_deletes(orders: DataFrame, customer_changes: DataFrame) -> DataFrame:
    """Orders left after deleting a customer also deleted the orders placed until then.

    Cascades run inside the source database and are not in its log, so they follow from
    the customer delete itself. Orders placed after the customer came back stay.
    ``orders`` carries ``ord``; commit times compare across tables.
    """
    deleted = customer_changes.where(F.col("op") == "d")
    return cascade_gone(orders, deleted.select(F.col("id").alias("customer_id"), F.col("ord.ts_ms").alias("gone_ms")))


def cascade_gone(orders: DataFrame, gone: DataFrame) -> DataFrame:
    """Orders placed after their customer's last delete; ``gone``: customer_id and gone_ms of deletes."""
    last = gone.groupBy("customer_id").agg(F.max("gone_ms").alias("gone_ms"))
    joined = join_small(orders, last, ["customer_id"], "left")
    return joined.where(F.col("gone_ms").isNull() | (F.col("ord.ts_ms") > F.col("gone_ms"))).drop("gone_ms")


def orphans(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders whose customer does not exist. A NULL customer is no reference.

    Customers is the table that grows, so this stays a shuffled anti join whose hot
    customers adaptive execution can split.
    """
    known = customers.select(F.col("_id").alias("customer_id"))
    return orders.where(F.col("customer_id").isNotNull()).join(known, ["customer_id"], "left_anti")


def newest_wins(state: DataFrame, newest: DataFrame, keys: list[str] = KEYS) -> tuple[DataFrame, DataFrame]:
    """(rows of ``state`` that stay, rows of ``newest`` that count); together the last change of each key.

    Both have one row per key. ``newest`` is broadcast, so ``state`` passes without a shuffle: once with all its
    columns, once with keys and order to find late changes that are older than what is stored. Rows are settled by
    order, so it does not matter which side a change came in.
    """
    sent = F.broadcast(newest.select(*[F.col(c).alias(f"_{c}") for c in keys], F.col("ord").alias("_ord")))
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_{c}") for c in keys])
    kept = state.join(sent, same & (F.col("ord") <= F.col("_ord")), "left_anti")
    later = state.select(*keys, "ord").join(sent, same & (F.col("ord") > F.col("_ord")), "left_semi").select(*keys)
    return kept, newest.join(F.broadcast(later), keys, "left_anti")


def merge_latest(state: DataFrame, newest: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Fold new changes into a state; both have one row per key and keep delete marks.

    While the touched keys are few, rows of the state pass through without a shuffle; with very many it is one shuffle.
    """
    newest = cut_lineage(newest)
    if newest.count() > MAX_BROADCAST_ROWS:
        return latest_per_key(state.unionByName(newest), keys=keys)
    kept, fresh = newest_wins(state, newest, keys)
    return kept.unionByName(fresh)
