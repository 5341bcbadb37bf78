"""True totals kept by a stream, also from a log without before-images.

The last image of each key is kept beside the checkpoint, as a table of batch folders and a base in buckets. A change
takes the stored image out of the totals and puts its own in, so what a batch adds is a handful of signed rows. Stored
and new images meet in one shuffled aggregate; a small batch is broadcast to the stored ones first. A truncate is kept
like an image: it takes out the images from before it, and is remembered for changes that come late. Whatever the order
in which the log's records arrive, the totals are those of the last change of each key since its table's last truncate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tideline.operators.envelope import judged_changes
from tideline.operators.joins import MAX_BROADCAST_ROWS, match_keys
from tideline.operators.state import KEYS, latest_per_key
from tideline.rules import DEFAULT, Rules
from tideline.schema import MONEY, ORDERS
from tideline.streaming.folders import Commit, Commits
from tideline.streaming.tables import BatchTable, Buckets

NET_SCHEMA = "table string, status string, n bigint, amount decimal(38,2)"
IMAGE_SCHEMA = """
    table string, id bigint, truncate boolean,
    ord struct<ts_ms: bigint, file: bigint, pos: bigint, row: bigint, is_change: int, offset: bigint>,
    live boolean, status string, amount decimal(12,2)
"""
# The base is written on after so many batches.
FOLD_EVERY = 8


def _newest(images: DataFrame) -> DataFrame:
    # A deleted key keeps its place, so that an older change that comes late does not bring it back.
    return latest_per_key(images, keys=[*KEYS, "truncate"])


def image_table(spark: SparkSession, checkpoint: str, buckets: int) -> BatchTable:
    """Last images and last truncates, as of the last committed batch of a checkpoint."""
    root = f"{checkpoint}/net"
    return BatchTable(
        spark, f"{root}/images", IMAGE_SCHEMA, _newest, lambda a, b: _newest(a.unionByName(b)), ("truncate",), Commits(spark, root), Buckets(buckets, keys=(*KEYS, "truncate"))
    )


def net_images(log: DataFrame, rules: Rules = DEFAULT, wrapped: bool = False) -> DataFrame:
    """A log as images: what each change leaves of its key, and truncates, which have no key."""
    judged = judged_changes(log, rules, wrapped)
    truncate = F.coalesce(F.col("reason") == "truncate", F.lit(False))
    status = F.col("status")
    if rules.null_status is not None:
        status = F.when(F.col("table") == ORDERS, F.coalesce(status, F.lit(rules.null_status))).otherwise(status)
    return judged.where(F.col("reason").isNull() | truncate).select(
        "table", F.when(~truncate, F.col("id")).alias("id"), truncate.alias("truncate"), "ord",
        (~truncate & ~F.col("op").eqNullSafe("d")).alias("live"), F.when(~truncate, status).alias("status"), F.col("total_amount").alias("amount"),
    )


def _cuts(images: DataFrame, name: str) -> DataFrame:
    """One row per table with a truncate."""
    return F.broadcast(images.where("truncate").groupBy("table").agg(F.max("ord").alias(name)))


def net_changes(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Signed changes of the totals from the images so far and those of a batch, one row of ``fresh`` per key."""
    changed, cuts = fresh.groupBy().agg(F.count_if(~F.col("truncate")), F.count_if("truncate")).first()
    old = stored.where(~F.col("truncate"))
    if not cuts and changed <= MAX_BROADCAST_ROWS:
        old = match_keys(old, F.broadcast(fresh.where(~F.col("truncate")).select(*KEYS)), KEYS, "left_semi")
    last = F.struct("ord", "live", "status", "amount")
    both = old.select(*KEYS, last.alias("old"), last.alias("new")).unionByName(
        fresh.where(~F.col("truncate")).select(*KEYS, last.alias("new")), allowMissingColumns=True
    )
    keyed = both.groupBy(*KEYS).agg(F.max("old").alias("old"), F.max("new").alias("new"))
    met = match_keys(keyed, _cuts(stored, "before"), ["table"], "left")
    met = match_keys(met, _cuts(stored.unionByName(fresh), "after"), ["table"], "left")
    met = met.where(~F.col("old").eqNullSafe(F.col("new")) | ~F.col("before").eqNullSafe(F.col("after")))

    def signed(image: str, cut: str, sign: int):
        counts = F.col(f"{image}.live") & (F.col(cut).isNull() | (F.col(f"{image}.ord") > F.col(cut)))
        amount = F.coalesce(F.col(f"{image}.amount").cast(MONEY), F.lit(0).cast(MONEY))
        return F.when(
            counts,
            F.struct(
                F.col(f"{image}.status").alias("status"), F.lit(sign).cast("bigint").alias("n"), (amount if sign > 0 else -amount).cast(MONEY).alias("amount")
            ),
        )

    moved = met.select("table", F.inline(F.array_compact(F.array(signed("old", "before", -1), signed("new", "after", 1)))))
    return _summed(moved).where((F.col("n") != 0) | (F.col("amount") != 0))


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("table", "status").agg(F.sum("n").cast("bigint").alias("n"), F.sum("amount").cast(MONEY).alias("amount"))


def net_table(spark, path: str) -> BatchTable:
    """Signed totals per micro-batch; they add up to the true ones."""
    return BatchTable(spark, path, NET_SCHEMA, _summed, lambda a, b: _summed(a.unionByName(b)))


def net_totals(table: BatchTable) -> DataFrame:
    """True totals by table and status, without those that are down to nothing."""
    return table.read().where((F.col("n") != 0) | (F.col("amount") != 0))


def keep_net_totals(
    log: DataFrame, table: BatchTable, checkpoint: str, interval: str | None = None, rules: Rules = DEFAULT, wrapped: bool = False, buckets: int = 64
) -> StreamingQuery:
    """Runs a log stream into the totals; without an interval, takes what is there and stops. A retried batch replaces itself.

    ``buckets``: of the stored images; they stay as they are for the life of a checkpoint.
    """
    images = image_table(log.sparkSession, checkpoint, buckets)

    def write(rows: DataFrame, batch_id: int) -> None:
        place = (0, batch_id)
        if not images.commits.is_committed(place):
            stored = images.pieces()
            images.write_batch(_newest(rows), batch_id)
            fresh = images.batches([place])
            table.write_batch(net_changes(stored, fresh), batch_id)
            images.commits.commit(Commit(place, fresh.count(), (images.name,)))
        if (batch_id + 1) % FOLD_EVERY == 0:
            before = images.base()
            images.fold()
            if before:
                images.commits.drop_covered(before.place)

    writer = net_images(log, rules, wrapped).writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
