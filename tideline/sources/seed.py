"""Seed rows and their replace-by-key insertion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.joins import join_small

# ---- fixed values: the seed rows ----
SEED_CUSTOMERS = [
    (1, "Nguyễn Văn An", "an.nguyen@company.com", "0912345678"),
    (2, "Trần Thị Bích", "bich.tran@company.com", "0987654321"),
    (3, "Lê Hoàng Cường", "cuong.le@company.com", "0978123456"),
]
SEED_ORDERS = [
    (1, 1, "1250000.00", "DELIVERED"),
    (2, 1, "850000.00", "PENDING"),
    (3, 2, "2450000.00", "SHIPPED"),
    (4, 3, "670000.00", "PROCESSING"),
]
# ---- end of fixed values ----


def seed_customers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SEED_CUSTOMERS, "id bigint, name string, email string, phone string")


def seed_orders(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(
        SEED_ORDERS, "id bigint, customer_id bigint, total_amount string, status string"
    )
    return rows.withColumn("total_amount", F.col("total_amount").cast("decimal(12,2)"))


def replace_rows(table: DataFrame, rows: DataFrame, key: str = "id") -> DataFrame:
    """Insert ``rows``, taking the place of table rows with the same key."""
    kept = join_small(table, rows.select(key), [key], "left_anti")
    return kept.unionByName(rows.select(*table.columns))
