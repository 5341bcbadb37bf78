"""Does the target hold what the source holds?"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.joins import join_small
from tideline.session import cut_lineage


def table_counts(tables: dict[str, DataFrame], name: str) -> DataFrame:
    """One row per table. Each count is a separate aggregate, so only footers or one column are read."""
    counted = [
        df.agg(F.count(F.lit(1)).cast("bigint").alias(name)).select(F.lit(table).alias("table"), name)
        for table, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def stored_counts(spark: SparkSession, paths: dict[str, str], name: str) -> DataFrame:
    """One row per stored table: its rows, 0 for one that is there and empty, NULL for one that cannot be read."""
    counted = []
    for table, path in paths.items():
        try:
            rows = spark.read.parquet(path).agg(F.count(F.lit(1)).cast("bigint").alias(name))
        except AnalysisException:  # no such folder, or nothing in it that is a table
            rows = spark.range(1).select(F.lit(None).cast("bigint").alias(name))
        counted.append(rows.select(F.lit(table).alias("table"), name))
    return reduce(DataFrame.unionByName, counted)


def reconcile_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Counts side by side with lag and an in-sync flag; a table missing on one side counts 0 there."""
    both = source.join(target, ["table"], "full")
    src = F.coalesce("source_rows", F.lit(0)).cast("bigint")
    tgt = F.coalesce("target_rows", F.lit(0)).cast("bigint")
    return both.select(
        "table",
        src.alias("source_rows"),
        tgt.alias("target_rows"),
        (src - tgt).alias("lag"),
        (src == tgt).cast("bigint").alias("in_sync"),
    )


def all_in_sync(reconciled: DataFrame) -> DataFrame:
    return reconciled.agg(F.min("in_sync").alias("in_sync"))


def both_readable(source_count: Column, target_count: Column) -> Column:
    """1 when both sides could be counted."""
    return (source_count.isNotNull() & target_count.isNotNull()).cast("bigint")


def reconcile_rows(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows that differ between the sides: ``missing``, ``extra`` or ``different``.

    Columns are compared as they are, NULLs included; a digest that skips NULLs would
    take two swapped NULLs for equal. Keys are unique on both sides.
    """
    values = [c for c in source.columns if c != key]
    left = source.select(key, F.struct(*values).alias("s"), F.lit(True).alias("in_source"))
    right = target.select(key, F.struct(*values).alias("t"), F.lit(True).alias("in_target"))
    verdict = (
        F.when(F.col("in_target").isNull(), "missing")
        .when(F.col("in_source").isNull(), "extra")
        .when(~F.col("s").eqNullSafe(F.col("t")), "different")
    )
    return (
        left.join(right, [key], "full")
        .select(key, verdict.alias("verdict"))
        .where(F.col("verdict").isNotNull())
    )


def _digests(rows: DataFrame, key: str, width: int) -> DataFrame:
    """Count and two digests of the rows of each range of ``width`` keys; sums of hashes, so they combine before the shuffle.

    NULLs are told apart from values and from each other's columns.
    """
    told = [x for c in rows.columns for x in (F.col(c), F.col(c).isNull())]
    return rows.groupBy(F.floor(F.col(key) / width).cast("bigint").alias("range")).agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64(*told)).alias("first"),
        F.bit_xor(F.xxhash64(F.lit("second"), *told)).alias("second"),
    )


def _inside(rows: DataFrame, key: str, ranges: DataFrame, width: int, bounds: tuple[int, int]) -> DataFrame:
    """Rows of the given ranges. The outermost bounds reach the scan; the ranges are broadcast while they are few."""
    low, high = bounds
    near = rows.where((F.col(key) >= low) & (F.col(key) < high))
    return join_small(near.withColumn("range", F.floor(F.col(key) / width).cast("bigint")), ranges.select("range"), ["range"], "left_semi").drop("range")


def differing_ranges(source: DataFrame, target: DataFrame, key: str, fanout: int = 256, leaf: int = 64) -> tuple[DataFrame | None, int, tuple[int, int]]:
    """(ranges of keys whose rows differ, their width, bounds of all of them); no ranges if the sides agree.

    Both sides are digested by wide ranges first. Ranges whose digests differ are cut into ``fanout`` narrower ones,
    until they are ``leaf`` keys wide. What the sides exchange is a row per range; after the first level only rows of
    ranges that differ are read again.
    """
    ends = [side.agg(F.min(key).alias("low"), F.max(key).alias("high")).first() for side in (source, target)]
    known = [e for e in ends if e["low"] is not None]
    if not known:
        return None, leaf, (0, 0)
    low, high = min(e["low"] for e in known), max(e["high"] for e in known)
    width = leaf
    while width * fanout < high - low + 1:
        width *= fanout
    bounds = low, high + 1
    sides = (source, target)
    while True:
        one, other = (_digests(side, key, width) for side in sides)
        same = reduce(lambda a, b: a & b, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("n", "first", "second")])
        apart = one.alias("a").join(other.alias("b"), "range", "full").where(~F.coalesce(same, F.lit(False))).select("range")
        apart = cut_lineage(apart)
        edge = apart.agg(F.min("range").alias("low"), F.max("range").alias("high")).first()
        if edge["low"] is None:
            return None, width, bounds
        bounds = edge["low"] * width, (edge["high"] + 1) * width
        if width == leaf:
            return apart, width, bounds
        sides = tuple(_inside(side, key, apart, width, bounds) for side in (source, target))
        width //= fanout


def reconcile_ranges(source: DataFrame, target: DataFrame, key: str, fanout: int = 256, leaf: int = 64) -> DataFrame:
    """``reconcile_rows`` that compares rows only in the ranges of keys whose digests differ. ``key`` is a whole number.

    Keys are unique on both sides and not NULL.
    """
    apart, width, bounds = differing_ranges(source, target, key, fanout, leaf)
    if apart is None:
        return reconcile_rows(source.where("false"), target.where("false"), key)
    return reconcile_rows(*[_inside(side, key, apart, width, bounds) for side in (source, target)], key)
