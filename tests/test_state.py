"""State folding, cascades, reconciliation and joins beyond the broadcast bound."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.operators import joins, state
from tideline.operators.joins import join_small
from tideline.operators.reconcile import reconcile_counts, reconcile_rows
from tideline.operators.runs import purge
from tideline.operators.state import cascade_deletes, latest_per_key, merge_latest, orphans

ORD = "ord struct<ts_ms: bigint, pos: bigint, is_change: int, offset: bigint>"


def rows_of(spark, rows):
    """(table, id, op, ts)"""
    return spark.createDataFrame(
        [(t, i, op, (ts, -1, 1, 0)) for t, i, op, ts in rows], f"table string, id bigint, op string, {ORD}"
    )


def as_set(df):
    return {(r.id, r.op, r.ord.ts_ms) for r in df.collect()}


BASE = [("orders", 1, "c", 10), ("orders", 2, "c", 10), ("orders", 3, "d", 50)]
NEW = [("orders", 2, "u", 20), ("orders", 3, "u", 40), ("orders", 4, "c", 5)]
WANT = {(1, "c", 10), (2, "u", 20), (3, "d", 50), (4, "c", 5)}


def test_fold_lets_a_late_older_change_lose(spark):
    assert as_set(merge_latest(rows_of(spark, BASE), rows_of(spark, NEW))) == WANT


def test_fold_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(state, "MAX_BROADCAST_ROWS", 1)
    assert as_set(merge_latest(rows_of(spark, BASE), rows_of(spark, NEW))) == WANT


def test_hot_key_sends_one_row_per_partition(spark):
    hot = spark.range(0, 50_000, 1, 8).select(
        F.lit("orders").alias("table"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id"),
        F.lit("u").alias("op"),
        F.struct(F.col("id").alias("ts_ms"), F.lit(-1).cast("bigint").alias("pos"), F.lit(1).alias("is_change"),
                 F.lit(0).cast("bigint").alias("offset")).alias("ord"),
    )
    latest = latest_per_key(hot)
    assert latest.where("id = 7").first().ord.ts_ms == 49_998
    assert latest.count() == hot.select("id").distinct().count()


def test_small_side_within_and_beyond_the_bound(spark, capsys):
    big = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    small = spark.createDataFrame([(1, 10), (None, 30)], "k int, w int")
    for bound, join in ((10, "BroadcastHashJoin"), (1, None)):
        joined = join_small(big, small, ["k"], "left", max_rows=bound)
        assert {tuple(r) for r in joined.collect()} == {(1, "a", 10), (2, "b", None), (None, "n", 30)}
        if join:
            joined.explain()
            assert join in capsys.readouterr().out
    assert {tuple(r) for r in join_small(big, small, ["k"], "left_anti").collect()} == {(2, "b")}


def test_bound_is_finite():
    assert 0 < joins.MAX_BROADCAST_ROWS <= 1_000_000


def test_cascade_spares_orders_placed_after_the_return(spark):
    orders = spark.createDataFrame(
        [(1, 5, (10, -1, 1, 0)), (2, 5, (40, -1, 1, 0)), (3, 6, (10, -1, 1, 0))], f"id bigint, customer_id bigint, {ORD}"
    )
    customers = rows_of(spark, [("customers", 5, "c", 1), ("customers", 5, "d", 20), ("customers", 5, "c", 30), ("customers", 6, "c", 1)])
    assert sorted(r.id for r in cascade_deletes(orders, customers).collect()) == [2, 3]


def test_orphans_ignore_null_references(spark):
    orders = spark.createDataFrame([(1, 5), (2, 9), (3, None)], "_id bigint, customer_id bigint")
    customers = spark.createDataFrame([(5,)], "_id bigint")
    assert [r._id for r in orphans(orders, customers).collect()] == [2]


def test_rows_that_swap_their_nulls_differ(spark):
    schema = "id bigint, a string, b string"
    source = spark.createDataFrame([(1, "x", None), (2, "same", "same"), (3, "gone", "gone"), (5, None, None)], schema)
    target = spark.createDataFrame([(1, None, "x"), (2, "same", "same"), (4, "new", "new"), (5, None, None)], schema)
    got = {r.id: r.verdict for r in reconcile_rows(source, target, "id").collect()}
    assert got == {1: "different", 3: "missing", 4: "extra"}


def test_counts_of_a_table_missing_on_one_side(spark):
    source = spark.createDataFrame([("a", 3), ("b", 2)], "table string, source_rows bigint")
    target = spark.createDataFrame([("a", 3), ("c", 1)], "table string, target_rows bigint")
    got = {r.table: (r.lag, r.in_sync) for r in reconcile_counts(source, target).collect()}
    assert got == {"a": (0, 1), "b": (2, 0), "c": (-1, 0)}


def test_purge_keeps_rows_it_cannot_judge(spark):
    rows = spark.createDataFrame([(1,), (None,), (9,)], "id bigint")
    assert [r.id for r in purge(rows, F.col("id") >= 5).collect()] == [1, None]


def test_ranges_find_what_rows_find(spark):
    """Missing, extra and different rows, swapped NULLs among them, with few rows compared."""
    from tideline.operators.reconcile import differing_ranges, reconcile_ranges, reconcile_rows

    rows = spark.range(-2_000, 30_000).select("id", F.when(F.col("id") % 3 != 0, F.col("id")).alias("x"), F.when(F.col("id") % 3 == 0, F.col("id")).alias("y"))
    swapped = F.col("id") == 12_000
    target = rows.where("id not in (-1999, 17)").select(
        "id", F.when(swapped, F.col("y")).otherwise(F.col("x")).alias("x"), F.when(swapped, F.col("x")).otherwise(F.col("y")).alias("y")
    ).unionByName(spark.createDataFrame([(40_000, 1, 1)], "id long, x long, y long"))
    for fanout, leaf in ((4, 16), (256, 64), (2, 1)):
        got = {(r["id"], r["verdict"]) for r in reconcile_ranges(rows, target, "id", fanout, leaf).collect()}
        assert got == {(-1999, "missing"), (17, "missing"), (12_000, "different"), (40_000, "extra")}
        ranges, width, _ = differing_ranges(rows, target, "id", fanout, leaf)
        assert width == leaf and ranges.count() == 4
    assert reconcile_ranges(rows, rows, "id").count() == 0
    assert reconcile_ranges(rows.where("false"), rows.where("false"), "id").count() == 0
    assert reconcile_ranges(rows, rows.where("false"), "id").count() == reconcile_rows(rows, rows.where("false"), "id").count()
