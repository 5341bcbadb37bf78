"""Counters, scores and net totals."""

from __future__ import annotations

from tideline.operators import counters as agg
from tideline.operators.envelope import parse_events
from tideline.plans import logs
from tideline.plans.logs import CUSTOMER_CTE, ORDER_CTE, ORDER_LATEST_CTE
from tideline.plans.logs import CUSTOMER_LATEST_CTE
from tideline.rules import Rules

PYTHON = Rules.python_job()
TOP_K = 10


def customers_total(spark, sf_dir):
    return agg.customers_total(logs.customer_changes(spark, sf_dir))


def customers_total_python(spark, sf_dir):
    """Deletes count as well."""
    return agg.customers_total(logs.customer_changes(spark, sf_dir), PYTHON)


def orders_total(spark, sf_dir):
    return agg.orders_total(logs.order_changes(spark, sf_dir))


def orders_by_status(spark, sf_dir):
    return agg.orders_by_status(logs.order_changes(spark, sf_dir))


def orders_revenue(spark, sf_dir):
    return agg.orders_revenue(logs.order_changes(spark, sf_dir))


def counters_all(spark, sf_dir):
    return agg.counters(logs.both_changes(spark, sf_dir))


def customer_order_score(spark, sf_dir):
    return agg.scores(logs.order_changes(spark, sf_dir))


def top_customers(spark, sf_dir):
    return agg.top_members(agg.scores(logs.order_changes(spark, sf_dir)), TOP_K)


def top_customer(spark, sf_dir):
    return agg.top_members(agg.scores(logs.order_changes(spark, sf_dir)), 1)


def net_counters(spark, sf_dir):
    return agg.net_counters(parse_events(logs.both_log(spark, sf_dir)))


QUERIES = {
    "customers_total": customers_total,
    "customers_total_python": customers_total_python,
    "orders_total": orders_total,
    "orders_by_status": orders_by_status,
    "orders_revenue": orders_revenue,
    "counters_all": counters_all,
    "customer_order_score": customer_order_score,
    "top_customers": top_customers,
    "top_customer": top_customer,
    "net_counters": net_counters,
}

_SIGN = "case op when 'd' then -1 else 1 end"
COUNTERS_SQL = f"""
with {ORDER_CTE}, {CUSTOMER_CTE}
select 'customers:total' as key, cast(count(*) as decimal(38,2)) as value from ce where op <> 'd'
union all select 'orders:total', cast(sum({_SIGN}) as decimal(38,2)) from oe
union all select 'orders:revenue', cast(sum({_SIGN} * amt) as decimal(38,2)) from oe
union all select 'orders:status:' || st, cast(sum({_SIGN}) as decimal(38,2)) from oe group by st"""
SCORES_SQL = f"""
with {ORDER_CTE} select 'customer:' || cid as member, count(*) as score from oe where op <> 'd' group by cid"""

ORACLE = {
    "customers_total": f"with {CUSTOMER_CTE} select count(*) as value from ce where op <> 'd'",
    "customers_total_python": f"with {CUSTOMER_CTE} select count(*) as value from ce",
    "orders_total": f"with {ORDER_CTE} select cast(sum({_SIGN}) as bigint) as value from oe",
    "orders_by_status": f"""
with {ORDER_CTE} select 'orders:status:' || st as key, cast(sum({_SIGN}) as bigint) as value from oe group by st""",
    "orders_revenue": f"with {ORDER_CTE} select cast(sum({_SIGN} * amt) as decimal(38,2)) as value from oe",
    "counters_all": COUNTERS_SQL,
    "customer_order_score": SCORES_SQL,
    "top_customers": f"select * from ({SCORES_SQL}) order by score desc, member desc limit {TOP_K}",
    "top_customer": f"select * from ({SCORES_SQL}) order by score desc, member desc limit 1",
    # The log has no event between a delete and a return that would carry an image, so the
    # net count of the signed images is the current state, statuses that fell to zero included.
    "net_counters": f"""
with {ORDER_LATEST_CTE}, {CUSTOMER_LATEST_CTE}
select 'orders' as "table", s.st as status, count(ol.id) as n, cast(coalesce(sum(ol.amt), 0) as decimal(38,2)) as amount
from (select distinct st from oe) s left join ol on ol.st = s.st and ol.op <> 'd' group by s.st
union all select 'customers', null, count(*), cast(0 as decimal(38,2)) from cl where op <> 'd'""",
}
