"""Parsing, row images, flattening, masking, routing, rejects."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions import counter_sign, customer_key, decode_amount, encode_amount, mask_email, or_empty, status_key
from tideline.operators.envelope import (
    after_only,
    drop_empty_image,
    flatten,
    parse_events,
    reject_ledger,
    route,
    row_image,
    status_domain,
)
from tideline.plans import logs
from tideline.plans.logs import CUSTOMER_CTE, ORDER_CTE, masked
from tideline.schema import CUSTOMERS, ORDERS
from tideline.sources import feed


def _event_columns(events):
    return events.select(
        "offset",
        "op",
        F.col("source.table").alias("table"),
        F.col("before.id").alias("before_id"),
        F.col("before.status").alias("before_status"),
        F.col("after.id").alias("after_id"),
        F.col("after.status").alias("after_status"),
    )


def parse_bare(spark, sf_dir):
    return _event_columns(parse_events(logs.orders_log(spark, sf_dir)))


def parse_wrapped(spark, sf_dir):
    """Wrapped and bare envelopes in the same log."""
    wrapped = feed.to_log(logs.order_events(spark, sf_dir).where(F.col("op") == "c"), wrapped=True)
    bare = feed.to_log(logs.order_events(spark, sf_dir).where(F.col("op") != "c"))
    return _event_columns(parse_events(wrapped.unionByName(bare), wrapped=True))


def image_of_row(spark, sf_dir):
    events = row_image(parse_events(logs.orders_log(spark, sf_dir)))
    return events.select("offset", "op", F.col("record.id").alias("id"), F.col("record.status").alias("status"))


def images_left(spark, sf_dir):
    """Events of a rough log that have a row image, by topic."""
    events = parse_events(logs.rough_log(spark, sf_dir), keep=("topic", "offset"))
    kept = drop_empty_image(row_image(events))
    return kept.groupBy("topic").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.sum("record.id").cast("bigint").alias("ids")
    )


def rejects(spark, sf_dir):
    return reject_ledger(logs.rough_log(spark, sf_dir))


def flatten_change(spark, sf_dir):
    events = drop_empty_image(row_image(parse_events(logs.both_log(spark, sf_dir))))
    return flatten(events)


def after_images(spark, sf_dir):
    return after_only(parse_events(logs.orders_log(spark, sf_dir))).select("id", "customer_id", "status")


def route_customers(spark, sf_dir):
    return route(logs.both_changes(spark, sf_dir), CUSTOMERS).select("op", "id", "name", "masked_email")


def route_orders(spark, sf_dir):
    return route(logs.both_changes(spark, sf_dir), ORDERS).select("op", "id", "customer_id", "total_amount", "status")


def pii_projection(spark, sf_dir):
    """Addresses that reach a sink, from a log that carries phone numbers and raw addresses."""
    flat = logs.customer_changes(spark, sf_dir)
    assert "email" not in flat.columns and "phone" not in flat.columns
    return flat.select("id", "masked_email")


def status_check(spark, sf_dir):
    """Missing statuses get the insert default, unknown ones are flagged."""
    orders = feed.read_table(logs.prepare(spark), sf_dir, "orders")
    code = F.col("o_orderstatus")
    status = F.when(code == "P", "PROCESSING").when(code == "F", code)
    checked = status_domain(orders.select(status.alias("status")))
    return checked.groupBy("status", "status_out", "in_domain").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def decode_decimal(spark, sf_dir):
    """Amounts of the table and their negatives through the log encoding and back."""
    rows = logs.order_table(spark, sf_dir)
    amount = F.col("total_amount")
    coded = rows.select("id", encode_amount(amount).alias("plus"), encode_amount(-amount).alias("minus"))
    return coded.select("id", decode_amount(F.col("plus")).alias("plus"), decode_amount(F.col("minus")).alias("minus"))


def _addresses(spark, sf_dir):
    customers = feed.read_table(logs.prepare(spark), sf_dir, "customer")
    name, segment = F.lower("c_name"), F.lower("c_mktsegment")
    forms = F.array(
        F.concat(name, F.lit("@example.com")),
        F.concat(F.left(name, F.lit(1)), F.lit("@x")),
        F.concat(F.left(name, F.lit(2)), F.lit("@x")),
        name,
        F.concat(name, F.lit("@a@b")),
        F.concat(segment, F.lit("@")),
        F.concat(F.lit("@"), segment),
        F.lit(None).cast("string"),
    )
    return customers.select(F.col("c_custkey").alias("id"), F.posexplode(forms).alias("form", "email"))


def mask_emails(spark, sf_dir):
    return _addresses(spark, sf_dir).select("id", "form", mask_email(F.col("email")).alias("masked"))


def mask_emails_scala(spark, sf_dir):
    masked_email = mask_email(F.col("email"), drop_trailing_empty_part=True)
    return _addresses(spark, sf_dir).select("id", "form", masked_email.alias("masked"))


def null_defaults(spark, sf_dir):
    flat = logs.both_changes(spark, sf_dir)
    return flat.select(
        "table",
        "id",
        "op",
        or_empty(F.col("name")).alias("name"),
        F.coalesce("total_amount", F.lit(0).cast("decimal(12,2)")).alias("amount"),
        F.coalesce("status", F.lit("UNKNOWN")).alias("status"),
    )


def kv_keys(spark, sf_dir):
    flat = logs.order_changes(spark, sf_dir)
    return flat.select(
        "id",
        counter_sign(F.col("op")).alias("step"),
        customer_key(F.col("customer_id")).alias("member"),
        status_key(F.col("status")).alias("status_key"),
    )


QUERIES = {
    "parse_bare": parse_bare,
    "parse_wrapped": parse_wrapped,
    "row_image": image_of_row,
    "drop_empty_image": images_left,
    "reject_ledger": rejects,
    "flatten_change": flatten_change,
    "after_only": after_images,
    "route_customers": route_customers,
    "route_orders": route_orders,
    "pii_projection": pii_projection,
    "status_domain": status_check,
    "decode_decimal": decode_decimal,
    "mask_email": mask_emails,
    "mask_email_scala": mask_emails_scala,
    "null_defaults": null_defaults,
    "kv_keys": kv_keys,
}

_EVENTS = """select off as "offset", op, 'orders' as "table",
  case when op <> 'c' then oe.id end as before_id,
  case op when 'u' then ob.st when 'd' then oe.st end as before_status,
  case when op <> 'd' then oe.id end as after_id,
  case when op <> 'd' then oe.st end as after_status
from oe join ob on oe.id = ob.id"""

_MASK = """
with f as (select c_custkey id, lower(c_name) n, lower(c_mktsegment) s from customer)
select id, 0 as form, left(n,1) || repeat('*', length(n)-2) || right(n,1) || '@example.com' as masked from f
union all select id, 1, left(n,1) || '@x' from f
union all select id, 2, left(n,2) || '@x' from f
union all select id, 3, n from f
union all select id, 4, n || '@a@b' from f
union all select id, 5, {short} from f
union all select id, 6, '@' || s from f
union all select id, 7, null from f"""

ORACLE = {
    "parse_bare": f"with {ORDER_CTE} {_EVENTS}",
    "parse_wrapped": f"with {ORDER_CTE} {_EVENTS}",
    "row_image": f"""with {ORDER_CTE} select off as "offset", op, id, st as status from oe""",
    "drop_empty_image": f"""
with {ORDER_CTE}, {CUSTOMER_CTE}
select 'inventory.inventory.orders' as topic, count(*) as n, cast(sum(id) as bigint) as ids from oe
union all select 'inventory.inventory.customers', count(*), cast(sum(id) as bigint) from ce
union all select 'inventory.inventory.suppliers', count(*), cast(sum(s_suppkey) as bigint) from supplier""",
    "reject_ledger": f"""
with {ORDER_CTE}, {CUSTOMER_CTE}
select 'inventory.inventory.orders' as topic, cast(id%3 as integer) as partition, off+1 as "offset",
       cast(null as varchar) as op, cast(null as varchar) as "table", 'tombstone' as reason from oe where op='d'
union all select 'inventory.inventory.customers', cast(id%3 as integer), off+1, null, null, 'tombstone' from ce where op='d'
union all select 'inventory.inventory.orders', 0, event_id, null, null, 'malformed' from events
union all select 'inventory.inventory.suppliers', cast(s_suppkey%3 as integer), s_suppkey*4, 'c', 'suppliers',
                 'unknown_table' from supplier""",
    "flatten_change": f"""
with {ORDER_CTE}, {CUSTOMER_CTE}
select op, 'orders' as "table", id, cast(null as varchar) as name, cast(null as varchar) as masked_email,
       cid as customer_id, amt as total_amount, st as status from oe
union all select op, 'customers', id, nm, {masked('em')}, null, null, null from ce""",
    "after_only": f"""
with {ORDER_CTE}
select case when op<>'d' then id end as id, case when op<>'d' then cid end as customer_id,
       case when op<>'d' then st end as status from oe""",
    "route_customers": f"with {CUSTOMER_CTE} select op, id, nm as name, {masked('em')} as masked_email from ce",
    "route_orders": f"""
with {ORDER_CTE} select op, id, cid as customer_id, amt as total_amount, st as status from oe""",
    "pii_projection": f"with {CUSTOMER_CTE} select id, {masked('em')} as masked_email from ce",
    "status_domain": """
select case o_orderstatus when 'P' then 'PROCESSING' when 'F' then 'F' end as status,
       case o_orderstatus when 'P' then 'PROCESSING' when 'F' then 'F' else 'PENDING' end as status_out,
       o_orderstatus <> 'F' as in_domain, count(*) as n
from orders group by 1, 2, 3""",
    "decode_decimal": f"""
with {ORDER_CTE} select id, amt as plus, cast(-amt as decimal(12,2)) as minus from ob""",
    "mask_email": _MASK.format(
        short="left(s,1) || repeat('*', length(s)-2) || right(s,1) || '@'"
    ),
    "mask_email_scala": _MASK.format(short="s || '@'"),
    "null_defaults": f"""
with {ORDER_CTE}, {CUSTOMER_CTE}
select 'orders' as "table", id, op, '' as name, amt as amount, st as status from oe
union all select 'customers', id, op, nm, cast(0 as decimal(12,2)), 'UNKNOWN' from ce""",
    "kv_keys": f"""
with {ORDER_CTE}
select id, cast(case op when 'd' then -1 else 1 end as bigint) as step, 'customer:' || cid as member,
       'orders:status:' || st as status_key from oe""",
}
