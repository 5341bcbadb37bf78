"""Rates and percentages with a zero for an empty denominator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def per_second(n: Column, elapsed: Column, digits: int = 1) -> Column:
    rate = F.round(n.cast("double") / F.nullif(elapsed.cast("double"), F.lit(0.0)), digits)
    return F.when(elapsed > 0, rate).otherwise(F.lit(0.0))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """NULL when there is nothing to compare with."""
    share = part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
    return F.round(share * 100, digits)
