"""Listing, marking and removing in the shared store, and the record of committed micro-batches."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

Place = tuple[int, int]  # epoch and batch


class Folders:
    """Files and folders of the shared store, by way of the session's own file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._store = self._path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        self._text = spark._jvm.org.apache.commons.io.IOUtils

    def found(self, pattern: str) -> list[str]:
        return [f.getPath().toString() for f in self._store.globStatus(self._path(pattern)) or []]

    def exists(self, path: str) -> bool:
        return self._store.exists(self._path(path))

    def make(self, path: str) -> None:
        self._store.mkdirs(self._path(path))

    def remove(self, path: str) -> None:
        self._store.delete(self._path(path), True)

    def read(self, path: str) -> str:
        stream = self._store.open(self._path(path))
        try:
            return self._text.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """The whole file or none: written beside its place and renamed. A file that is there already is replaced."""
        made = self._path(f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
        out = self._store.create(made, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self._store.delete(self._path(path), False)
        self._store.rename(made, self._path(path))


def numbers(name: str) -> Place:
    """The two numbers of a name like ``epoch=1,batch=20.json``."""
    first, second = name.rpartition("/")[2].removesuffix(".json").split(",")
    return int(first.split("=")[1]), int(second.split("=")[1])


@dataclass(frozen=True)
class Commit:
    """What one committed micro-batch wrote: changes applied, and tables that got a folder."""

    place: Place
    changes: int = 0
    tables: tuple[str, ...] = ()


@dataclass(frozen=True)
class Commits:
    """One version for several tables: a micro-batch counts in all of them once its record is there, and in none before.

    Batch numbers start again with every checkpoint, so records carry the epoch of theirs. Once an epoch that
    replaces earlier ones has a record, all earlier records are void, for every table alike, whether the
    epoch gave that table rows or not.
    """

    spark: SparkSession
    path: str
    # Readers that must agree with each other look at nothing after this.
    upto: Place | None = None

    def _folders(self) -> Folders:
        return Folders(self.spark, self.path)

    # ---- epochs ----
    def epochs(self) -> dict[int, bool]:
        """Epoch -> whether it replaces the ones before it."""
        names = [path.split("/")[-1].split("-") for path in self._folders().found(f"{self.path}/epochs/epoch=*")]
        return {int(name[0].split("=")[1]): name[1] == "replaces" for name in names}

    def mark_epoch(self, number: int, replaces: bool) -> None:
        self._folders().make(f"{self.path}/epochs/epoch={number}-{'replaces' if replaces else 'adds'}")

    def open_epoch(self, replaces: bool) -> int:
        """A new epoch: one that reads its log from the start, or one that goes on after the others."""
        number = max(self.epochs(), default=-1) + 1
        self.mark_epoch(number, replaces)
        return number

    def epoch_of(self, checkpoint: str, replaces: bool) -> int:
        """The epoch of a checkpoint; a checkpoint without one gets a new one and keeps it.

        The checkpoint is marked first, so a start that fails in between takes the same number again.
        """
        folders = Folders(self.spark, checkpoint)
        found = folders.found(f"{checkpoint}/epoch=*")
        if found:
            number, kind = found[0].split("/")[-1].split("=")[1].split("-")
            self.mark_epoch(int(number), kind == "replaces")
            return int(number)
        number = max(self.epochs(), default=-1) + 1
        folders.make(f"{checkpoint}/epoch={number}-{'replaces' if replaces else 'adds'}")
        self.mark_epoch(number, replaces)
        return number

    # ---- records ----
    def commit(self, done: Commit) -> None:
        """The record is a file whose name says all, so that readers list a folder and open nothing."""
        epoch, batch = done.place
        self._folders().write(f"{self.path}/commits/epoch={epoch},batch={batch},changes={done.changes},tables={'+'.join(done.tables)}.json", "{}")

    def _records(self) -> dict[Place, str]:
        """File of each batch that has a record, in order."""
        found = self._folders().found(f"{self.path}/commits/epoch=*.json")
        return dict(sorted((numbers(",".join(path.rpartition("/")[2].split(",")[:2])), path) for path in found))

    def is_committed(self, place: Place) -> bool:
        """Whether a record is there, or was there before a fold took it along."""
        return place in self._records() or any(place <= folded and place[0] == folded[0] for folded in self._folded())

    def _folded(self) -> list[Place]:
        return sorted(numbers(path) for path in self._folders().found(f"{self.path}/folded/epoch=*.json"))

    def first_epoch(self) -> int:
        """The last replacing epoch with a record: what lies before it does not count any more."""
        begun = {epoch for epoch, _ in [*self._records(), *self._folded()]}
        return max((e for e, fresh in self.epochs().items() if fresh and e in begun), default=0)

    def committed(self) -> list[Commit]:
        """Committed batches whose records are kept, in order."""
        first, out = self.first_epoch(), []
        for place, path in self._records().items():
            if place[0] >= first and (self.upto is None or place <= self.upto):
                said = dict(part.split("=", 1) for part in path.rpartition("/")[2].removesuffix(".json").split(","))
                out.append(Commit(place, int(said["changes"]), tuple(said["tables"].split("+"))))
        return out

    def places(self) -> list[Place]:
        return [c.place for c in self.committed()]

    def drop_covered(self, place: Place) -> None:
        """Forgets the records up to one that every table's base covers; the place itself stays known."""
        folders = self._folders()
        folders.write(f"{self.path}/folded/epoch={place[0]},batch={place[1]}.json", "{}")
        for p, path in self._records().items():
            if p <= place:
                folders.remove(path)
        last_of_epoch = {p[0]: p for p in self._folded()}
        for p in self._folded():
            if p != last_of_epoch[p[0]]:
                folders.remove(f"{self.path}/folded/epoch={p[0]},batch={p[1]}.json")
