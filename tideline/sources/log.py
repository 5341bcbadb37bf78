"""Reading a change log, as a batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.joins import join_small
from tideline.schema import LOG_SCHEMA, topic_of


def kafka_options(
    servers: str,
    tables: list[str],
    starting: str = "earliest",
    fail_on_data_loss: bool = False,
    max_per_batch: int | None = None,
) -> dict[str, str]:
    """``max_per_batch`` bounds the records of a micro-batch while a backlog is worked off."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topic_of(t) for t in tables),
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_per_batch:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    return options


def stream_kafka(spark: SparkSession, servers: str, tables: list[str], **options) -> DataFrame:
    """Several topics as one stream; needs Spark's Kafka package on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, tables, **options)).load()


def read_kafka(spark: SparkSession, servers: str, tables: list[str]) -> DataFrame:
    """The whole log as a batch, for a rebuild; lost records fail it."""
    options = kafka_options(servers, tables, fail_on_data_loss=True) | {"endingOffsets": "latest"}
    return spark.read.format("kafka").options(**options).load()


def stream_files(
    spark: SparkSession, path: str, files_per_batch: int | None = None, tolerate_loss: bool = True
) -> DataFrame:
    """A log kept as parquet files, read as they arrive. Lost files are tolerated unless told otherwise."""
    reader = spark.readStream.schema(LOG_SCHEMA).option("ignoreMissingFiles", str(tolerate_loss).lower())
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """The whole log as a batch; a file that is lost or unreadable fails it, whatever the session allows."""
    strict = {"ignoreMissingFiles": "false", "ignoreCorruptFiles": "false"}
    return spark.read.schema(LOG_SCHEMA).options(**strict).parquet(path)


def subscribe(log: DataFrame, tables: list[str]) -> DataFrame:
    """Topic allow-list; reaches the parquet scan as a pushed filter."""
    return log.where(F.col("topic").isin([topic_of(t) for t in tables]))


def from_offsets(log: DataFrame, starts: DataFrame) -> DataFrame:
    """Records at or after ``start_offset`` of their topic and partition.

    A partition without a start is read whole, as a partition added later would be.
    ``starts`` has one row per topic partition.
    """
    joined = join_small(log, starts, ["topic", "partition"], "left")
    reached = F.col("offset") >= F.coalesce(F.col("start_offset"), F.lit(0))
    return joined.where(reached).drop("start_offset")


def end_offsets(log: DataFrame) -> DataFrame:
    """Next offset per topic partition."""
    return log.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).cast("bigint").alias("end_offset")
    )


def topic_end_offsets(log: DataFrame) -> DataFrame:
    """Next offsets summed over all partitions of a topic, not only the last one read."""
    return end_offsets(log).groupBy("topic").agg(
        F.sum("end_offset").cast("bigint").alias("end_offset"),
        F.count(F.lit(1)).cast("bigint").alias("partitions"),
    )
