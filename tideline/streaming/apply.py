"""The change sink: one micro-batch into documents, counters and scores."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tideline.operators.counters import ROWS, deltas
from tideline.operators.envelope import PLACE, changes, judged_changes
from tideline.operators.state import KEYS
from tideline.rules import DEFAULT, Rules
from tideline.schema import CUSTOMERS
from tideline.streaming.folders import Folders
from tideline.streaming.tables import LATEST_COLUMNS, BatchTable, StateTables, last_cuts, rows_key


@dataclass(kw_only=True)
class _Options:
    rules: Rules = DEFAULT
    # hold the parsed batch for the later writes; a rebuild reads stored rows instead
    hold: bool = True
    # fold the tables after every so many batches; never on its own when None
    fold_every: int | None = None
    # of the checkpoint; the newest one of the tables when None
    epoch: int | None = None
    # commit a batch without rows too, so that an empty log replaces what was there
    commit_empty: bool = False
    # called after each write with the table's name and the batch; tests use it to fail half-way
    after_write: Callable[[str, int], None] = field(default=lambda table, batch_id: None)


@dataclass
class ChangeSink(_Options):
    """``foreachBatch`` target: documents, deltas, truncates and rejects, then one commit record for all of them.

    Every write is keyed by the batch, so a retry replaces itself, and no reader sees any of them before the
    record. A batch that is committed already is left alone. The writes are independent of each other and run side
    by side. A batch is flat changes, or judged ones: those with a ``reason`` go to the ledger of rejects, and
    truncates among them also to the cuts that ``StateTables.current`` applies.
    """

    tables: StateTables

    def __call__(self, flat: DataFrame, batch_id: int) -> None:
        epoch = self.tables.epoch() if self.epoch is None else self.epoch
        if not self.tables.commits.is_committed((epoch, batch_id)):
            self._apply(flat, batch_id, epoch)
        if self.fold_every and (batch_id + 1) % self.fold_every == 0:
            self.tables.fold()

    def _apply(self, flat: DataFrame, batch_id: int, epoch: int) -> None:
        held = flat.persist() if self.hold else None
        try:
            judged = flat if "reason" in flat.columns else flat.withColumn("reason", F.lit(None).cast("string"))
            # One look at the batch decides which tables get anything.
            left = F.col("reason").isNull() & (F.col("table") == CUSTOMERS) & (F.col("op") == "d")
            applied, rejected, cut, gone = judged.agg(
                F.count_if(F.col("reason").isNull()), F.count("reason"), F.count_if(F.col("reason") == "truncate"), F.count_if(left)
            ).first()
            changed = judged.where(F.col("reason").isNull()).drop("reason", *PLACE)
            writes: list[tuple[BatchTable, Callable[[], DataFrame]]] = []
            if applied:
                # As they are: readers and folds take the last of each key anyway, over all batches at once.
                writes.append((self.tables.latest, lambda: changed.select(*KEYS, *LATEST_COLUMNS)))
                writes.append((self.tables.deltas, lambda: self._deltas(changed, epoch, batch_id)))
            if rejected:
                rest = judged.where(F.col("reason").isNotNull())
                writes.append((self.tables.rejects, lambda: rest.select(*PLACE, "op", "table", "reason")))
            if cut:
                truncates = judged.where(F.col("reason") == "truncate")
                writes.append((self.tables.cuts, lambda: last_cuts(truncates.select("table", F.col("ord").alias("cut")))))
            if gone and "ord" in judged.columns:
                deleted = judged.where(left).select(F.col("id").alias("customer_id"), F.col("ord.ts_ms").alias("gone_ms"))
                writes.append((self.tables.gone, lambda: deleted.groupBy("customer_id").agg(F.max("gone_ms").alias("gone_ms"))))
            if writes:
                in_thread = inheritable_thread_target(self.tables.latest.spark)
                with ThreadPoolExecutor(len(writes)) as pool:
                    for done in [pool.submit(in_thread(self._write), t, rows, batch_id, epoch) for t, rows in writes]:
                        done.result()
            if writes or self.commit_empty:
                self.tables.commit(batch_id, applied, tuple(t.name for t, _ in writes), epoch)
        finally:
            if held is not None:
                held.unpersist()

    def _write(self, table: BatchTable, rows: Callable[[], DataFrame], batch_id: int, epoch: int) -> None:
        table.write_batch(rows(), batch_id, epoch)
        self.after_write(table.name, batch_id)

    def _deltas(self, changed: DataFrame, epoch: int, batch_id: int) -> DataFrame:
        key = F.when(F.col("kind") == ROWS, rows_key(epoch, batch_id)).otherwise(F.col("key"))
        return deltas(changed, self.rules).withColumn("key", key)


def start(
    log: DataFrame,
    sink: ChangeSink,
    checkpoint: str,
    interval: str | None = "5 seconds",
    wrapped: bool = False,
    from_start: bool = True,
) -> StreamingQuery:
    """Run a log stream into the sink; without an interval, take what is there and stop.

    A new checkpoint over kept tables reads the log from the start, so its batches replace what is
    there. Say ``from_start=False`` if the log itself begins where the tables end.
    """
    sink = replace(sink, epoch=sink.tables.epoch_of(checkpoint, from_start))
    writer = (
        judged_changes(log, sink.rules, wrapped)
        .writeStream.foreachBatch(sink)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def run_available(log: DataFrame, sink: ChangeSink, checkpoint: str) -> StreamingQuery:
    query = start(log, sink, checkpoint, interval=None)
    query.awaitTermination()
    return query


def rebuild(log: DataFrame, tables: StateTables, rules: Rules = DEFAULT, wrapped: bool = False) -> None:
    """State of a whole log as one batch, in place of what the tables held, even if the log is empty.

    The log is parsed once: judged rows are stored beside the tables while the batch is written from them.
    """
    epoch = tables.open_epoch(replaces=True)
    folders, held = Folders(tables.latest.spark, tables.commits.path), f"{tables.commits.path}/rebuild-{epoch}"
    judged = judged_changes(log, rules, wrapped)
    judged.write.mode("overwrite").parquet(held)
    stored = log.sparkSession.read.schema(judged.schema).parquet(held)
    ChangeSink(tables, rules=rules, hold=False, epoch=epoch, commit_empty=True)(stored, 0)
    folders.remove(held)


def preview(log: DataFrame, name: str, checkpoint: str, rules: Rules = DEFAULT, sink: str = "memory") -> StreamingQuery:
    """Changes by table and op to a console or an in-memory table: a few rows, however long the stream."""
    totals = changes(log, rules, with_order=False).groupBy("table", "op").agg(F.count("*").cast("bigint").alias("n"))
    return (
        totals.writeStream.format(sink)
        .queryName(name)
        .outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def to_parquet(frame: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append stream into parquet with Spark's own exactly-once file sink."""
    query = (
        frame.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def running_aggregate(frame: DataFrame, out: BatchTable, checkpoint: str) -> StreamingQuery:
    """Streaming aggregation whose state Spark keeps; each batch writes the whole result."""
    query = (
        frame.writeStream.foreachBatch(out.write_batch)
        .outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
