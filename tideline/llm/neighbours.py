"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each table hashes a vector by k random projections cut into cells of one width. A query visits its own bucket
and perturbed ones in the estimated order of success (the squared distances to the crossed cell borders);
candidates of all tables are reranked by exact distance where they lie, so only the nearest few of each
group of buckets travel on. Width, projections and probes are fitted on a bounded sample.
"""

from __future__ import annotations

from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.frames import kept_table, map_arrow

_OFFSETS = (1, 2)


@dataclass(frozen=True)
class Tables:
    directions: np.ndarray  # tables x dimensions x k
    shifts: np.ndarray  # tables x k
    width: float
    probes: int

    def cells(self, table: int, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Integer cells and the place inside each, in widths."""
        at = vectors @ self.directions[table] / self.width + self.shifts[table]
        cell = np.floor(at)
        return cell.astype(np.int64), at - cell


def bucket(cells: np.ndarray, table: int) -> np.ndarray:
    """One 64-bit number for each row of cells."""
    h = np.full(len(cells), 0x9E3779B97F4A7C15 + 2 * table, dtype=np.uint64)
    for column in cells.astype(np.uint64).T:
        h = (h ^ column) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h.astype(np.int64)


def perturbations(inside: np.ndarray, probes: int) -> np.ndarray:
    """probes x k cell offsets, own bucket first, then by rising sum of squared border distances."""
    k = len(inside)
    moves = sorted(
        [((inside[i] + o - 1) ** 2, i, -o) for i in range(k) for o in _OFFSETS]
        + [((o - inside[i]) ** 2, i, o) for i in range(k) for o in _OFFSETS]
    )
    out = [()]
    heap: list[tuple[float, tuple[int, ...]]] = [(moves[0][0], (0,))]
    while heap and len(out) < probes:
        score, chosen = heappop(heap)
        dimensions = [moves[m][1] for m in chosen]
        valid = len(set(dimensions)) == len(dimensions)
        if valid:
            out.append(chosen)
        last = chosen[-1]
        if last + 1 < len(moves):
            step = moves[last + 1][0]
            heappush(heap, (score - moves[last][0] + step, (*chosen[:-1], last + 1)))
            if valid:
                heappush(heap, (score + step, (*chosen, last + 1)))
    offsets = np.zeros((len(out), k), dtype=np.int64)
    for row, chosen in enumerate(out):
        for m in chosen:
            offsets[row, moves[m][1]] = moves[m][2]
    return offsets


def fit(sample: np.ndarray, rows: int, tables: int, target: float, nearest: int, most_probes: int, seed: int) -> Tables:
    """Projections by the number of rows; width by the sample's neighbour distance; probes by its recall.

    Neighbours within a sample lie farther apart than within all rows, so the probes err on the safe side.
    If the target needs more than ``most_probes``, there is one projection less.
    """
    random = np.random.default_rng(seed)
    queries = sample[:: max(1, len(sample) // 100)]
    squares = (queries**2).sum(1)[:, None] + (sample**2).sum(1)[None] - 2 * queries @ sample.T
    squares[np.arange(len(queries)), np.arange(0, len(sample), max(1, len(sample) // 100))] = np.inf
    count = min(nearest, len(sample) - 1)
    near = np.argsort(squares, axis=1, kind="stable")[:, :count] if count else np.zeros((len(queries), 0), dtype=np.int64)
    reach = np.sqrt(np.maximum(np.take_along_axis(squares, near, 1), 0)) if count else np.ones((1, 1))
    width = 2.0 * float(np.median(reach)) or 1.0
    k = int(np.clip(round(np.log2(max(rows, 1) / 300)), 0, 16))
    while True:
        made = Tables(random.normal(size=(tables, sample.shape[1], k)), random.random((tables, k)), width, most_probes)
        if k == 0 or not count:
            return Tables(made.directions[:, :, :0], made.shifts[:, :0], width, 1)
        rank = np.full(near.shape, most_probes)
        for t in range(tables):
            cell, inside = made.cells(t, sample)
            own, inside = made.cells(t, queries)
            for q in range(len(queries)):
                place = {x.tobytes(): r for r, x in enumerate(own[q] + perturbations(inside[q], most_probes))}
                found = [place.get(c.tobytes(), most_probes) for c in cell[near[q]]]
                rank[q] = np.minimum(rank[q], found)
        probes = int(np.quantile(rank, target, method="higher")) + 1
        if probes <= most_probes:
            return Tables(made.directions, made.shifts, width, probes)
        k -= 1


def usable(vector: Column) -> Column:
    """Neither null nor zero, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _vectors(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _hashed(rows: DataFrame, made: Tables) -> DataFrame:
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        vectors = _vectors(batch.column(1))
        keys = [bucket(made.cells(t, vectors)[0], t) for t in range(len(made.shifts))]
        n = len(keys)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(keys)), pa.array(np.tile(np.asarray(batch.column(0)), n)), pa.concat_arrays([batch.column(1)] * n)],
            ["bucket", "id", "vector"],
        )

    kind = rows.schema["vector"].dataType.simpleString()
    return map_arrow(rows.select("id", "vector"), step, f"bucket long, id long, vector {kind}")


def _probed(queries: DataFrame, made: Tables) -> DataFrame:
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        vectors, ids = _vectors(batch.column(1)), np.asarray(batch.column(0))
        keys, owners = [], []
        for t in range(len(made.shifts)):
            cell, inside = made.cells(t, vectors)
            for q in range(len(ids)):
                own = bucket(cell[q] + perturbations(inside[q], made.probes), t) if cell.shape[1] else bucket(cell[q : q + 1], t)
                keys.append(own)
                owners.append(np.full(len(own), ids[q]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(owners))], ["bucket", "query"])

    return map_arrow(queries.select("id", "vector"), step, "bucket long, query long")


def _nearest_in_group(keep: int):
    """The ``keep`` nearest of each query among the rows of the cells that it probes."""

    def run(group: pa.Table) -> pa.Table:
        kind = np.asarray(group["kind"])
        cell, ids, query = np.asarray(group["cell"]), np.asarray(group["id"]), np.asarray(group["query"])
        rows, asked, probes = (np.flatnonzero(kind == k) for k in (0, 1, 2))
        out: list[tuple[np.ndarray, ...]] = []
        if len(rows) and len(asked) and len(probes):
            rows = rows[np.argsort(cell[rows], kind="stable")]
            vectors = _vectors(group["vector"].take(pa.array(rows)))
            questions = _vectors(group["vector"].take(pa.array(asked)))
            place = {q: k for k, q in enumerate(query[asked].tolist())}
            row_cells, row_ids = cell[rows], ids[rows]
            probes = probes[np.argsort(query[probes], kind="stable")]
            for part in np.split(probes, np.flatnonzero(np.diff(query[probes])) + 1):
                wanted = np.unique(cell[part])
                first, last = np.searchsorted(row_cells, wanted), np.searchsorted(row_cells, wanted, side="right")
                at = np.concatenate([np.arange(a, b) for a, b in zip(first, last)])
                if not len(at):
                    continue
                at = at[np.unique(row_ids[at], return_index=True)[1]]  # a row lies in a cell of every table
                asking = query[part[0]]
                apart = vectors[at] - questions[place[asking]]
                distance = np.sqrt((apart * apart).sum(axis=1))
                best = np.lexsort((row_ids[at], distance))[:keep]
                out.append((np.full(len(best), asking), row_ids[at][best], distance[best]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, t) for t in (np.int64, np.int64, np.float64)]
        return pa.table(columns, names=["query", "id", "distance"])

    return run


def nearest_neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    nearest: int = 10,
    tables: int = 2,
    target: float = 0.985,
    sample_rows: int = 4000,
    most_probes: int = 2000,
    group_rows: int = 1000,
    seed: int = 11,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``queries`` the nearest rows of ``vectors`` (both vec_id, embedding).

    A query is not its own neighbour. Ties go to the smaller vec_id. Null and zero vectors and those with null
    or non-finite components take no part, nor do vectors of another length than most; repeated rows of an id
    count once. With no more than 300 rows everything is compared. An empty table gives no rows.
    ``sample_rows`` bounds what width and probes are fitted on. Equal vectors are indexed with their
    ``nearest + 1`` smallest ids, which is all that an answer can hold of them.
    """
    fields = [F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("vector")]
    rows = vectors.select(*fields).where(F.col("id").isNotNull() & usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return vectors.sparkSession.createDataFrame([], schema)
    size, total = lengths["size"], lengths["n"]
    rows = rows.where(F.size("vector") == size)
    asked = queries.select(*fields).where(F.col("id").isNotNull() & usable(F.col("vector")) & (F.size("vector") == size)).distinct()
    # The rank is cut on both sides of the shuffle, so a vector of very many ids sends few.
    same = Window.partitionBy("vector").orderBy("id")
    rows = kept_table(rows.withColumn("k", F.dense_rank().over(same)).where(F.col("k") <= nearest + 1).select("id", "vector").distinct(), "vectors")
    distinct = asked.groupBy("vector").agg(F.min("id").alias("query"))
    distinct = kept_table(distinct.select(F.col("query").alias("id"), "vector"), "queries")

    sample = rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("vector").toArrow()
    made = fit(_vectors(sample["vector"]), total, tables, target, nearest, most_probes, seed)

    indexed = kept_table(_hashed(rows, made), "indexed")
    counts = indexed.groupBy("bucket").agg(F.ceil(F.count("*") / F.lit(group_rows / 2)).alias("parts"))
    counts = kept_table(counts, "buckets")
    groups = max(1, -(-total * tables // group_rows))
    # A large bucket is split into parts that every query of the bucket visits.
    cell = F.xxhash64("bucket", "part").alias("cell")
    held = indexed.join(counts, "bucket").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts"))).select(cell, "id", "vector")
    probed = (
        _probed(distinct.repartition(16), made)
        .join(counts, "bucket")
        .select("bucket", "query", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
        .select(cell, "query")
    )

    def group_of(cell: Column) -> Column:
        return F.pmod(cell, F.lit(groups)).alias("group")

    probed = kept_table(probed.select(group_of(F.col("cell")), "cell", "query").distinct(), "probes")
    empty = F.lit(None).cast(rows.schema["vector"].dataType).alias("vector")
    zero = F.lit(0).cast("long")
    visits = probed.select("group", "query").distinct().join(distinct.withColumnRenamed("id", "query"), "query")
    parts = (
        held.select(group_of(F.col("cell")), F.lit(0).alias("kind"), "cell", "id", zero.alias("query"), "vector")
        .unionAll(visits.select("group", F.lit(1).alias("kind"), zero.alias("cell"), zero.alias("id"), "query", "vector"))
        .unionAll(probed.select("group", F.lit(2).alias("kind"), "cell", zero.alias("id"), "query", empty))
    )
    found = parts.groupBy("group").applyInArrow(_nearest_in_group(nearest + 1), "query long, id long, distance double").distinct()
    order = Window.partitionBy("query").orderBy("distance", "id")
    found = found.withColumn("k", F.row_number().over(order)).where(F.col("k") <= nearest + 1)

    # Queries with the same vector share an answer, each without itself.
    owners = asked.join(distinct.withColumnRenamed("id", "query"), "vector").select(F.col("id").alias("query_id"), "query")
    answers = owners.join(found, "query").where(F.col("query_id") != F.col("id"))
    last = Window.partitionBy("query_id").orderBy("distance", "id")
    return (
        answers.withColumn("rank", F.row_number().over(last))
        .where(F.col("rank") <= nearest)
        .select("query_id", "rank", F.col("id").alias("vec_id"), F.col("distance").alias("score"))
    )
