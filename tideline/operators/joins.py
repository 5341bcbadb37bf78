"""Joins with a side that is usually small."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.session import cut_lineage

# Rows are a few dozen bytes wide, so this stays near ten megabytes.
MAX_BROADCAST_ROWS = 100_000


def match_keys(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL equals NULL, so that no group is lost."""
    renamed = right.withColumnsRenamed({c: f"_{c}" for c in on})
    same = reduce(lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"_{c}"]) for c in on])
    return left.join(renamed, same, how).drop(*[f"_{c}" for c in on])


def join_small(
    big: DataFrame, small: DataFrame, on: list[str], how: str = "inner", max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Broadcast ``small`` when it is counted to fit; else a shuffled join.

    The small side is computed once, into the shared folder, counted there and joined
    from there. The shuffled join leaves hot keys of ``big`` to adaptive skew splitting,
    which is open to inner, left, semi and anti joins with the hot side on the left.
    """
    held = cut_lineage(small)
    if held.count() <= max_rows:
        held = F.broadcast(held)
    return match_keys(big, held, on, how)
