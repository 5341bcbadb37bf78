"""Metric exposition text: one ``name value`` per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_metric_lines(lines: DataFrame) -> DataFrame:
    """Comments, lines without exactly two words and values that are no numbers are skipped."""
    words = F.filter(F.split(F.col("value"), "\\s+"), lambda w: w != "")
    named = lines.where(~F.col("value").startswith("#")).select(words.alias("w"))
    pairs = named.where(F.size("w") == 2).select(
        F.get("w", F.lit(0)).alias("name"), F.get("w", F.lit(1)).try_cast("double").alias("value")
    )
    return pairs.where(F.col("value").isNotNull())


def scan_metric_text(spark: SparkSession, path: str) -> DataFrame:
    return parse_metric_lines(spark.read.text(path))
