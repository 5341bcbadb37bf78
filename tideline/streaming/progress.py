"""Micro-batch progress as rows."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tideline.streaming.folders import Folders

PROGRESS_SCHEMA = "batch_id bigint, ts string, num_input_rows bigint, batch_ms bigint, input_rate double, process_rate double"
_STORED = f"{PROGRESS_SCHEMA}, query_id string"


def _row(p: dict) -> tuple:
    return (
        int(p["batchId"]),
        p["timestamp"],
        int(p["numInputRows"]),
        int(p["durationMs"].get("triggerExecution", 0)),
        float(p.get("inputRowsPerSecond") or 0.0),
        float(p.get("processedRowsPerSecond") or 0.0),
    )


class ProgressLog(StreamingQueryListener):
    """Writes the progress of every batch to a folder as it comes, where it stays.

    A query itself remembers its last 100 entries only. A lost driver loses none that it was told of; ``together``
    files become one, so that the folder grows slowly.
    """

    def __init__(self, spark: SparkSession, path: str, together: int = 50):
        self.spark, self.path, self.together = spark, path, together
        self._single: dict[str, list[tuple[str, str]]] = {}  # files of one line since the last longer one, by query
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        names = [part.split()[0] for part in PROGRESS_SCHEMA.split(", ")]
        line = json.dumps(dict(zip(names, _row(progress))) | {"query_id": progress["id"]})
        folders = Folders(self.spark, self.path)
        file = f"{self.path}/{progress['id']}-{progress['batchId']:012d}.json"
        folders.write(file, line + "\n")
        single = self._single.setdefault(progress["id"], [])
        single.append((file, line))
        if len(single) >= self.together:
            # The lines of both are equal while both are there, and rows() counts each batch once.
            folders.write(f"{self.path}/{progress['id']}-{progress['batchId']:012d}-all.json", "\n".join(text for _, text in single) + "\n")
            for name in {name for name, _ in single}:
                folders.remove(name)
            single.clear()

    def rows(self) -> DataFrame:
        """Every batch of every query once, however many there were."""
        stored = self.spark.read.schema(_STORED).json(f"{self.path}/*.json")
        return stored.groupBy("query_id", "batch_id").agg(
            *[F.max_by(c, F.struct("num_input_rows", "ts")).alias(c) for c in ("ts", "num_input_rows", "batch_ms", "input_rate", "process_rate")]
        )

    def close(self) -> None:
        self.spark.streams.removeListener(self)


def progress_rows(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Recent progress of a query. Spark keeps a fixed number of entries, 100 by default; ``ProgressLog`` keeps all."""
    return spark.createDataFrame([_row(p) for p in query.recentProgress], PROGRESS_SCHEMA)
