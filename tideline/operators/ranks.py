"""Exact order statistics by index, without sorting a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.joins import join_small, match_keys
from tideline.session import cut_lineage

BUCKETS = 4096
# Distinct values of one group that a single task may walk through in order.
WINDOW_ROWS = 1_000_000


def p50_index(n: Column) -> Column:
    return F.floor(n / 2).cast("bigint")


def p95_index(n: Column) -> Column:
    """``floor(0.95 n)`` in whole numbers, never beyond the last reading."""
    return F.least(F.expr("n * 95 div 100"), n - 1)


def _holds_rank() -> Column:
    return (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("held"))


def _running(by: list[str], order: str):
    return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)


def _bucketed(counted: DataFrame, edges: DataFrame, by: list[str], value: str) -> DataFrame:
    """Order-keeping bucket of each value between its group's least and largest finite one.

    Both edges keep the value's own type, so they fall apart whenever they differ: whole and
    decimal numbers are subtracted exactly, others by halves, which cannot overflow. The two
    infinities and NaN, the largest of all, have buckets of their own.
    """
    exact = counted.schema[value].dataType.typeName() in ("byte", "short", "integer", "long", "decimal")

    def apart(a: Column) -> Column:
        low = F.col("lo")
        if exact:
            return (a.cast("decimal(38,10)") - low.cast("decimal(38,10)")).cast("double")
        return a.cast("double") / 2 - low.cast("double") / 2

    width = F.nullif(apart(F.col("hi")), F.lit(0.0))
    place = F.floor(apart(F.col(value)) / width * BUCKETS)
    number = F.col(value).cast("double")
    bucket = (
        F.when(F.isnan(number), BUCKETS + 1)
        .when(number == float("inf"), BUCKETS)
        .when(number == float("-inf"), -1)
        .otherwise(F.coalesce(F.least(place, F.lit(BUCKETS - 1)), F.lit(0)))
        .cast("int")
    )
    return join_small(counted, edges, by).withColumn("bucket", bucket).drop("lo", "hi")


def _edges(value: str) -> list[Column]:
    number = F.col(value).cast("double")
    finite = F.when(~F.isnan(number) & (F.abs(number) < float("inf")), F.col(value))
    return [F.min(finite).alias("lo"), F.max(finite).alias("hi")]


def pick_by_index(
    rows: DataFrame, groups: list[str], value: str, indexes: dict[str, Column], window_rows: int = WINDOW_ROWS
) -> DataFrame:
    """For each group the readings at the given zero-based sorted positions.

    ``indexes`` maps a result name to a position in terms of ``n``, the group's size;
    NULL readings are left out. Result: one row per group and name with ``picked``.

    While a group has more values than one task should walk through, they are counted
    into value buckets, which combines before the shuffle, and only the bucket that holds
    the position is looked at closer. Each round parts the least from the largest finite
    value, and infinities and NaN from both, so it ends; the readings themselves are scanned again rather than shuffled.
    """
    rows = rows.where(F.col(value).isNotNull()).select(*groups, value)
    n = F.count(F.lit(1)).cast("bigint").alias("n")
    sizes = cut_lineage(rows.groupBy(*groups).agg(n, *_edges(value)))
    wanted = F.array(
        *[F.struct(F.lit(k).alias("stat"), i.cast("bigint").alias("rank")) for k, i in indexes.items()]
    )
    targets = sizes.select(*groups, F.inline(wanted))
    by, left = list(groups), rows.withColumn("held", F.lit(1).cast("bigint"))
    edges, largest = sizes.select(*groups, "lo", "hi"), _largest(sizes)

    while largest > window_rows:
        placed = _bucketed(left, edges, by, value)
        totals = placed.groupBy(*by, "bucket").agg(F.sum("held").alias("held"))
        totals = totals.withColumn("upto", F.sum("held").over(_running(by, "bucket")))
        rank = (F.col("rank") - F.col("upto") + F.col("held")).alias("rank")
        ranked = match_keys(totals, targets, by).where(_holds_rank())
        found = cut_lineage(ranked.select(*groups, "stat", "bucket", rank))
        inside = join_small(placed, found.drop("rank"), [*by, "bucket"])
        by = [*groups, "stat"]
        left = cut_lineage(inside.groupBy(*by, value).agg(F.sum("held").alias("held")))
        targets = found.select(*by, "rank")
        sizes = cut_lineage(left.groupBy(*by).agg(n, *_edges(value)))
        edges, largest = sizes.select(*by, "lo", "hi"), _largest(sizes)

    counted = left.groupBy(*by, value).agg(F.sum("held").alias("held"))
    counted = counted.withColumn("upto", F.sum("held").over(_running(by, value)))
    return match_keys(counted, targets, by).where(_holds_rank()).select(*groups, "stat", F.col(value).alias("picked"))


# ---- ranks of what a stream has seen ----
SKETCH_K, SLACK, GRID = 400, 0.01, 200
SKETCHED = "n bigint, sketch binary"


def sketched(rows: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Count and quantile sketch of each group: a few kilobytes, however many readings. Sketches of batches merge."""
    number = F.col(value).cast("double")
    return rows.where(F.col(value).isNotNull()).groupBy(*groups).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.kll_sketch_agg_double(number, F.lit(SKETCH_K)).alias("sketch")
    )


def merged_sketches(sketches: DataFrame, groups: list[str]) -> DataFrame:
    return sketches.groupBy(*groups).agg(F.sum("n").cast("bigint").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketched_bounds(sketches: DataFrame, groups: list[str], indexes: dict[str, Column], slack: float = SLACK) -> DataFrame:
    """For each group and statistic the wanted position and two values that hold it, but for the sketch's rare misses."""
    wanted = F.array(*[F.struct(F.lit(k).alias("stat"), i.cast("bigint").alias("rank")) for k, i in indexes.items()])
    # The sketch answers for fixed shares only: a grid, of which the two places around the position are taken.
    grid = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(k / GRID) for k in range(GRID + 1)]))
    share = F.col("rank") / F.col("n")
    place = F.greatest(F.floor((share - slack) * GRID), F.lit(0)), F.least(F.ceil((share + slack) * GRID), F.lit(GRID))
    return sketches.select(*groups, "n", grid.alias("grid"), F.inline(wanted)).select(
        *groups, "stat", "rank", *[F.get("grid", p.cast("int")).alias(name) for p, name in zip(place, ("low", "high"))]
    )


def close_exactly(
    rows: DataFrame, sketches: DataFrame, groups: list[str], value: str, indexes: dict[str, Column], slack: float = SLACK
) -> DataFrame:
    """``pick_by_index`` with the sketches' help: readings below the bounds are only counted, those between looked at.

    Exact: where the position does not lie between a sketch's bounds after all, its group is ranked as a whole.
    """
    rows = rows.where(F.col(value).isNotNull()).select(*groups, value)
    bounds = cut_lineage(sketched_bounds(sketches, groups, indexes, slack))
    number = F.col(value).cast("double")
    near = join_small(rows, bounds, groups)
    by = [*groups, "stat", "rank"]
    counted = near.groupBy(*by).agg(
        F.count_if(number < F.col("low")).alias("below"), F.count_if((number >= F.col("low")) & (number <= F.col("high"))).alias("between")
    )
    left = F.col("rank") - F.col("below")
    counted = cut_lineage(counted.select(*by, left.alias("left"), ((left >= 0) & (left < F.col("between"))).alias("held")))
    found = join_small(near, counted.where("held").select(*by, "left"), by).where((number >= F.col("low")) & (number <= F.col("high")))
    # The statistic is a group of its own here; its position is carried along.
    picked = pick_by_index(found.withColumnRenamed("stat", "name_of_stat"), [*groups, "name_of_stat", "left"], value, {"left": F.col("left")})
    picked = picked.select(*groups, F.col("name_of_stat").alias("stat"), "picked")
    missed = counted.where("not held").select(*groups).distinct()
    if missed.isEmpty():
        return picked
    whole = pick_by_index(join_small(rows, missed, groups, "left_semi"), groups, value, indexes)
    return join_small(picked, missed, groups, "left_anti").unionByName(whole)


def _largest(sizes: DataFrame) -> int:
    return sizes.agg(F.max("n")).first()[0] or 0


def picked_columns(picked: DataFrame, groups: list[str], names: list[str]) -> DataFrame:
    """One column per statistic instead of one row."""
    columns = [F.max(F.when(F.col("stat") == name, F.col("picked"))).alias(name) for name in names]
    return picked.groupBy(*groups).agg(*columns)
