"""Tables written one folder per micro-batch, and folded now and then.

A batch writes folders of its own and overwrites them when it is retried, so a retry replaces its rows instead of
adding to them. It counts once its commit record is there (``Commits``), in all tables of a store at once; a table
outside a store goes by Spark's success marks.

A fold moves batches into the base. A base is a version file that names folders, so a fold writes only what it
changes and readers see one version or the next:

* ``Whole``: one folder with everything, for tables that stay small.
* ``Buckets``: a folder per hash bucket of the key; only buckets that the batches touch are written anew, and their
  old rows pass from scan to file without a shuffle.
* ``Segments``: for rows that are only ever added; a fold adds a folder, and eight of one size become one of the next.

What only versions before the last one name is removed, so neither folders nor listings grow with the batches ever
written, and a reader that has just listed its files keeps them over one more fold.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline.operators.counters import COUNTER, ROWS, SCORE, add_deltas
from tideline.operators.envelope import route
from tideline.operators.joins import MAX_BROADCAST_ROWS
from tideline.operators.state import KEYS, after_cuts, cascade_gone, latest_per_key, newest_wins
from tideline.schema import ORDERS
from tideline.session import cut_lineage
from tideline.streaming.folders import Commit, Commits, Folders, Place, numbers

LATEST_SCHEMA = """
    table string, id bigint, op string, name string, masked_email string, customer_id bigint,
    total_amount decimal(12,2), status string,
    ord struct<ts_ms: bigint, file: bigint, pos: bigint, row: bigint, is_change: int, offset: bigint>
"""
LATEST_COLUMNS = ["op", "name", "masked_email", "customer_id", "total_amount", "status", "ord"]
CUT_SCHEMA = """
    table string, cut struct<ts_ms: bigint, file: bigint, pos: bigint, row: bigint, is_change: int, offset: bigint>
"""
REJECT_SCHEMA = "topic string, partition int, offset bigint, op string, table string, reason string"
GONE_SCHEMA = "customer_id bigint, gone_ms bigint"
DELTA_SCHEMA = "kind string, key string, value decimal(38,2)"


def _folder(place: Place, tag: str) -> str:
    return f"epoch={place[0]}/{tag}={place[1]}"


@dataclass(frozen=True)
class Version:
    """A base: everything up to ``place``. ``parts``: name -> folder under ``base/data`` and how often it was written on."""

    place: Place
    parts: dict[str, tuple[str, int]]


@dataclass(frozen=True)
class BatchTable:
    """One table: batch folders, a base and the rules that sum them up."""

    spark: SparkSession
    path: str
    schema: str
    # changes of several batches -> one row per key
    combine: Callable[[DataFrame], DataFrame]
    # base, later batches (already combined) -> whole table
    merge: Callable[[DataFrame, DataFrame], DataFrame]
    # folders inside a batch or base, so that a reader of one table skips the others
    split_by: tuple[str, ...] = ()
    # without it, finished batches of epoch 0 count
    commits: Commits | None = None
    base_kind: Whole | Buckets | Segments | None = None

    @property
    def name(self) -> str:
        return self.path.rpartition("/")[2]

    def _write(self, rows: DataFrame, path: str, split_by: tuple[str, ...]) -> None:
        rows.write.mode("overwrite").partitionBy(*split_by).parquet(path)

    def folders(self) -> Folders:
        return Folders(self.spark, self.path)

    def write_batch(self, rows: DataFrame, batch_id: int, epoch: int = 0) -> None:
        self._write(rows, f"{self.path}/batches/{_folder((epoch, batch_id), 'batch')}", self.split_by)

    # ---- what counts ----
    def _written(self) -> list[Place]:
        """Batches with a finished folder, in order."""
        marks = self.folders().found(f"{self.path}/batches/epoch=*/batch=*/_SUCCESS")
        parts = [path.split("/")[-3:-1] for path in marks]
        return sorted((int(e.split("=")[1]), int(n.split("=")[1])) for e, n in parts)

    def places(self) -> list[Place]:
        """Committed batches that gave this table rows and whose folders are kept, in order."""
        if self.commits is None:
            return self._written()
        return [c.place for c in self.commits.committed() if self.name in c.tables]

    def batch_ids(self) -> list[int]:
        written = set(self._written())
        return [n for e, n in self.places() if (e, n) in written]

    def _versions(self) -> list[Place]:
        found = sorted(numbers(path) for path in self.folders().found(f"{self.path}/base/versions/epoch=*.json"))
        if self.commits is None:
            return found
        first, upto = self.commits.first_epoch(), self.commits.upto
        return [p for p in found if p[0] >= first and (upto is None or p <= upto)]

    def version_file(self, place: Place) -> str:
        return f"{self.path}/base/versions/epoch={place[0]},upto={place[1]}.json"

    def version(self, place: Place) -> Version:
        found = json.loads(self.folders().read(self.version_file(place)))
        return Version(place, {k: (folder, age) for k, (folder, age) in found.items()})

    def base(self) -> Version | None:
        places = self._versions()
        return self.version(places[-1]) if places else None

    def base_id(self) -> int | None:
        places = self._versions()
        return places[-1][1] if places else None

    def _newer(self, base: Version | None) -> list[Place]:
        return [p for p in self.places() if base is None or p > base.place]

    # ---- reading ----
    def _read(self, root: str, folders: list[str], more: str = "") -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema + more)
        reader = self.spark.read.schema(self.schema + more).option("basePath", root)
        return reader.parquet(*[f"{root}/{f}" for f in folders])

    def batches(self, places: list[Place]) -> DataFrame:
        return self._read(f"{self.path}/batches", [_folder(p, "batch") for p in places]).drop("batch", "epoch")

    def parts(self, folders: list[str], more: str = "") -> DataFrame:
        return self._read(f"{self.path}/base/data", folders, more).drop("upto", "epoch")

    def last_batch(self) -> DataFrame:
        return self.batches(self.places()[-1:])

    def changes_in(self, places: list[Place]) -> int | None:
        """A bound on the rows of batches, by their records."""
        return sum(c.changes for c in self.commits.committed() if c.place in set(places)) if self.commits else None

    def read(self) -> DataFrame:
        """The table as of the last committed batch."""
        return self._current().select(*StructType.fromDDL(self.schema).names)

    def pieces(self) -> DataFrame:
        """Rows of the base and of every committed batch since, not combined: for readers that combine them with more."""
        base = self.base()
        newer = self.batches(self._newer(base))
        if base is None:
            return newer
        return self.parts(sorted({folder for folder, _ in base.parts.values()})).drop("bucket").unionByName(newer)

    def _current(self) -> DataFrame:
        base = self.base()
        newer = self._newer(base)
        if base is None:
            return self.combine(self.batches(newer))
        whole = self.parts(sorted({folder for folder, _ in base.parts.values()})).drop("bucket")
        if not newer:
            return whole
        newest = self.combine(self.batches(newer))
        return self.base_kind.merged(self, whole, newest, self.changes_in(newer)) if self.base_kind else self.merge(whole, newest)

    # ---- folding ----
    def fold(self) -> int | None:
        """Moves the batches since the base into a new base version. Run it between batches."""
        before = self.base()
        places = self._newer(before)
        # All tables of a store fold up to the same batch, whether it gave them rows or not.
        last = max(self.commits.places(), default=None) if self.commits else max(places, default=None)
        if last is None or (before and last <= before.place):
            return None
        kind = self.base_kind or Whole()
        parts = kind.folded(self, before, places, last) if places else dict(before.parts if before else {})
        self.folders().write(self.version_file(last), json.dumps(parts))
        if before:
            self._drop_covered(before, Version(last, parts))
        return last[1]

    def _drop_covered(self, before: Version, now: Version) -> None:
        """Removes the batches that the base before covers, and what only versions before it name."""
        folders = self.folders()
        for p in self._written():
            if p <= before.place:
                folders.remove(f"{self.path}/batches/{_folder(p, 'batch')}")
        named = {folder for v in (before, now) for folder, _ in v.parts.values()}
        for path in folders.found(f"{self.path}/base/versions/epoch=*.json"):
            place = numbers(path)
            if place < before.place:
                for folder, _ in self.version(place).parts.values():
                    if folder not in named:
                        folders.remove(f"{self.path}/base/data/{folder}")
                folders.remove(path)


class Whole:
    """The base is one folder."""

    def merged(self, table: BatchTable, base: DataFrame, newest: DataFrame, bound: int | None) -> DataFrame:
        return table.merge(base, newest)

    def folded(self, table: BatchTable, before: Version | None, places: list[Place], last: Place) -> dict[str, tuple[str, int]]:
        newest = table.combine(table.batches(places))
        rows = table.merge(table.parts([f for f, _ in before.parts.values()]), newest) if before and before.parts else newest
        folder = _folder(last, "upto")
        table._write(rows, f"{table.path}/base/data/{folder}", table.split_by)
        return {"all": (folder, 0)}


@dataclass(frozen=True)
class Buckets:
    """The base is a folder per hash bucket of ``key``; batches rewrite the buckets that they touch."""

    count: int = 16
    key: str = "id"
    # what names a row; the last one by order counts
    keys: tuple[str, ...] = tuple(KEYS)
    # A bucket gets one more file each time it is written on, so it is dealt anew after so many times.
    rounds: int = 8
    # Rows of new changes that may be broadcast; keys and orders are of fixed width, about a hundred bytes.
    max_rows: int = MAX_BROADCAST_ROWS
    # Changes of the fullest bucket, in times the mean, from which a fold combines them before it deals them.
    uneven: float = 2.0

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.count)).cast("int")

    def merged(self, table: BatchTable, base: DataFrame, newest: DataFrame, bound: int | None) -> DataFrame:
        if bound is None or bound > self.max_rows:
            return table.merge(base, newest)
        kept, fresh = newest_wins(base, newest)
        return kept.unionByName(fresh)

    def folded(self, table: BatchTable, before: Version | None, places: list[Place], last: Place) -> dict[str, tuple[str, int]]:
        folder = _folder(last, "upto")
        if table.batches(places).count() > self.max_rows:  # by the files' own counts
            return self._rewritten(table, before, places, folder)
        # Written once to the shared folder: every step below reads it from there.
        newest = cut_lineage(table.combine(table.batches(places)).withColumn("bucket", self.bucket()))
        touched = newest.groupBy("bucket").count().collect()  # at most as many rows as buckets
        parts = dict(before.parts) if before else {}
        old = {b: parts[str(b)] for b in (r["bucket"] for r in touched) if str(b) in parts}
        rows, dealt = newest, [r["bucket"] for r in touched]
        if old:
            state = table.parts([folder for folder, _ in old.values()], ", bucket int")
            kept, fresh = newest_wins(state, newest)
            dealt = [b for b, (_, age) in old.items() if age + 1 >= self.rounds]
            rows = fresh.repartition("bucket").unionByName(kept.where(~F.col("bucket").isin(dealt)) if dealt else kept)
            if dealt:
                rows = rows.unionByName(kept.where(F.col("bucket").isin(dealt)).repartition("bucket"))
        else:
            rows = rows.repartition("bucket")
        table._write(rows, f"{table.path}/base/data/{folder}", ("bucket", *table.split_by))
        for r in touched:
            b = r["bucket"]
            age = 0 if b in dealt or b not in old else old[b][1] + 1
            parts[str(b)] = (f"{folder}/bucket={b}", age)
        return parts

    def _rewritten(self, table: BatchTable, before: Version | None, places: list[Place], folder: str) -> dict[str, tuple[str, int]]:
        """Every bucket anew, for changes that are too many to broadcast: one shuffle deals rows to buckets and settles keys there.

        A key with very many changes would send them all to one bucket, so they are combined first where buckets differ much.
        """
        rows = table.batches(places)
        most, mean = rows.groupBy(self.bucket().alias("bucket")).count().agg(F.max("count"), F.sum("count") / self.count).first()
        if most > self.uneven * mean:
            rows = table.combine(rows)
        if before and before.parts:
            rows = rows.unionByName(table.parts(sorted({f for f, _ in before.parts.values()})).drop("bucket"))
        rows = latest_per_key(rows.withColumn("bucket", self.bucket()).repartition("bucket"), keys=["bucket", *self.keys])
        table._write(rows, f"{table.path}/base/data/{folder}", ("bucket", *table.split_by))
        written = table.folders().found(f"{table.path}/base/data/{folder}/bucket=*")
        return {b: (f"{folder}/bucket={b}", 0) for b in (path.rpartition("=")[2] for path in written)}


@dataclass(frozen=True)
class Segments:
    """The base is a list of folders; rows are only added, so old ones are written again a few times only."""

    together: int = 8

    def merged(self, table: BatchTable, base: DataFrame, newest: DataFrame, bound: int | None) -> DataFrame:
        return base.unionByName(newest)

    def folded(self, table: BatchTable, before: Version | None, places: list[Place], last: Place) -> dict[str, tuple[str, int]]:
        parts = dict(before.parts) if before else {}
        rows, tier = table.batches(places), 0
        while True:
            same = [name for name, (_, age) in parts.items() if age == tier]
            if len(same) + 1 < self.together:
                break
            rows = rows.unionByName(table.parts([parts.pop(name)[0] for name in same]))
            tier += 1
        folder = _folder(last, "upto")
        table._write(rows, f"{table.path}/base/data/{folder}", table.split_by)
        return parts | {f"{last[0]}-{last[1]}": (folder, tier)}


def last_cuts(cuts: DataFrame) -> DataFrame:
    return cuts.groupBy("table").agg(F.max("cut").alias("cut"))


def rows_key(epoch: int, batch: int) -> Column:
    """Key of the count of a batch's changes to a table: it names the batch, so counts outlive folds."""
    return F.concat(F.lit(f"{epoch}:{batch}:"), F.col("key"))


@dataclass(frozen=True)
class StateTables:
    """What the change sink keeps: the latest change of each key, deltas that add up, truncates and rejects.

    Deltas of all kinds share one table. All tables share one record of commits, so what one of them shows of a
    batch, all show.
    """

    latest: BatchTable
    deltas: BatchTable
    cuts: BatchTable
    rejects: BatchTable
    # deletes of customers, which take their orders along
    gone: BatchTable
    commits: Commits

    @staticmethod
    def at(spark: SparkSession, root: str, buckets: int = 16) -> StateTables:
        """``buckets``: of the latest changes; enough for a few hundred megabytes each. Kept for the life of the tables."""
        commits = Commits(spark, root)
        return StateTables(
            BatchTable(
                spark, f"{root}/latest", LATEST_SCHEMA, partial(latest_per_key, keep=LATEST_COLUMNS), _latest_of_both, ("table",), commits, Buckets(buckets)
            ),
            BatchTable(spark, f"{root}/deltas", DELTA_SCHEMA, add_deltas, lambda a, b: add_deltas(a.unionByName(b)), ("kind",), commits, Whole()),
            BatchTable(spark, f"{root}/cuts", CUT_SCHEMA, last_cuts, lambda a, b: last_cuts(a.unionByName(b)), (), commits, Whole()),
            BatchTable(spark, f"{root}/rejects", REJECT_SCHEMA, lambda d: d, DataFrame.unionByName, (), commits, Segments()),
            BatchTable(spark, f"{root}/gone", GONE_SCHEMA, lambda d: d, DataFrame.unionByName, (), commits, Segments()),
            commits,
        )

    @property
    def all(self) -> tuple[BatchTable, ...]:
        return self.latest, self.deltas, self.cuts, self.rejects, self.gone

    def pinned(self) -> StateTables:
        """The tables as of the last committed batch, however many batches come in while they are read.

        Holds over one fold, like any reader.
        """
        places = self.commits.places()
        upto = places[-1] if places else max((t.base().place for t in self.all if t.base()), default=None)
        commits = replace(self.commits, upto=upto) if upto else self.commits
        return StateTables(*[replace(t, commits=commits) for t in self.all], commits)

    def epoch(self) -> int:
        """The newest epoch, 0 before any is opened."""
        return max(self.commits.epochs(), default=0)

    def open_epoch(self, replaces: bool) -> int:
        return self.commits.open_epoch(replaces)

    def epoch_of(self, checkpoint: str, replaces: bool) -> int:
        return self.commits.epoch_of(checkpoint, replaces)

    def commit(self, batch_id: int, changes: int, tables: tuple[str, ...], epoch: int = 0) -> None:
        self.commits.commit(Commit((epoch, batch_id), changes, tables))

    def current(self) -> DataFrame:
        """The latest change of each key that its table's last truncate has left."""
        tables = self.pinned()
        return after_cuts(tables.latest.read(), tables.cuts.read())

    def after_cascades(self) -> DataFrame:
        """``current`` without the orders that went with their customer, however late either of them came in.

        The stored orders stay as they are: the ledger of deleted customers is met when they are read, by a
        broadcast while it is small.
        """
        tables = self.pinned()
        rows = tables.current()
        orders = cascade_gone(route(rows, ORDERS), tables.gone.read())
        return orders.unionByName(rows.where(F.col("table") != ORDERS))

    def counters(self) -> DataFrame:
        return self.deltas.read().where(F.col("kind") == COUNTER).select("key", "value")

    def scores(self) -> DataFrame:
        rows = self.deltas.read().where(F.col("kind") == SCORE)
        return rows.select(F.col("key").alias("member"), F.col("value").cast("bigint").alias("score"))

    def batch_rows(self) -> DataFrame:
        """Changes per micro-batch and table, of folded batches too."""
        rows = self.deltas.read().where(F.col("kind") == ROWS)
        part = F.split("key", ":", 3)
        return rows.select(
            part[1].cast("bigint").alias("batch"), part[2].alias("table"), F.col("value").cast("bigint").alias("n"), part[0].cast("bigint").alias("epoch")
        )

    def fold(self) -> None:
        """Folds all tables up to the last committed batch and forgets the records that all bases before cover."""
        before = [t.base() for t in self.all]
        for table in self.all:
            table.fold()
        if all(before):
            self.commits.drop_covered(min(v.place for v in before))


def _latest_of_both(base: DataFrame, newest: DataFrame) -> DataFrame:
    return latest_per_key(base.unionByName(newest), keys=KEYS)


def folder_counts(tables: StateTables) -> Counter:
    """Batch folders, base versions and base folders of each table, and commit records."""
    out: Counter = Counter()
    for t in tables.all:
        folders = t.folders()
        out[f"{t.name} batches"] = len(t._written())
        out[f"{t.name} versions"] = len(folders.found(f"{t.path}/base/versions/epoch=*.json"))
        out[f"{t.name} folders"] = len(folders.found(f"{t.path}/base/data/epoch=*/upto=*"))
    folders = Folders(tables.latest.spark, tables.commits.path)
    out["commits"] = len(folders.found(f"{tables.commits.path}/commits/epoch=*.json"))
    return out
