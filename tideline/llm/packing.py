"""Packing documents into fixed-length sequences by a distributed grouping genetic algorithm.

Documents are tokenized and cut into pieces of at most ``capacity`` tokens. Pieces are dealt by hash into
blocks of about ``block_items``; several islands evolve packings of the same block. Crossover injects whole
well-filled sequences of one parent into the other, dissolves the sequences that then hold a piece twice and
best-fits the displaced pieces. Between epochs each island sends its elite to its neighbour. Sequences that
stay poorly filled are dissolved and packed again across blocks in the next round, as long as rounds save sequences.
"""

from __future__ import annotations

import math
import zlib
from array import array
from bisect import bisect_left, insort
from struct import pack

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.frames import id_and_text, kept_table, map_arrow
from tideline.llm.library_ids import library_ids


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Pieces of each row of ``docs``: its ids and ``end_id``, cut only where longer than ``capacity``."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        end = pack("<I", end_id)
        for doc_id, raw in zip(batch.column(0).to_pylist(), library_ids(tokenizer_path, "packing").of_column(batch.column(1))):
            raw += end
            n = len(raw) // 4
            for k, start in enumerate(range(0, n, capacity)):
                part = raw[4 * start : 4 * (start + capacity)]
                out.append((doc_id, k, start, len(part) // 4, zlib.crc32(part)))
        columns = list(zip(*out)) or [()] * 5
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"]
        )

    return map_arrow(id_and_text(docs), step, PIECES)


def best_fit(order, lengths: list[int], capacity: int, place: np.ndarray, free: list[int]) -> int:
    """Puts pieces, in ``order``, where the least room is left. ``free``: room of each sequence. Returns the number opened."""
    room = sorted((f, s) for s, f in enumerate(free) if f > 0)
    used = len(free)
    for i in order:
        n = lengths[i]
        k = bisect_left(room, (n, -1))
        if k < len(room):
            f, s = room.pop(k)
        else:
            f, s = capacity, used
            used += 1
        place[i] = s
        if f > n:
            insort(room, (f - n, s))
    return used


class Island:
    """A population of packings of one block."""

    def __init__(self, lengths: np.ndarray, capacity: int, seed: int):
        self.lengths, self.capacity = lengths, capacity
        self.plain = lengths.tolist()
        self.random = np.random.default_rng(seed)
        self.least = math.ceil(int(lengths.sum()) / capacity)

    def first(self, size: int) -> list[np.ndarray]:
        """Best-fit decreasing, then best-fit in orders disturbed more and more."""
        out = []
        for k in range(size):
            noise = 1 + 0.1 * k * self.random.random(len(self.lengths))
            place = np.zeros(len(self.lengths), dtype=np.int32)
            best_fit(np.argsort(-self.lengths * noise, kind="stable").tolist(), self.plain, self.capacity, place, [])
            out.append(place)
        return out

    def fills(self, place: np.ndarray) -> np.ndarray:
        return np.bincount(place, weights=self.lengths).astype(np.int64)

    def fitness(self, place: np.ndarray) -> tuple[int, float]:
        """Fewer sequences first, then the more uneven filling, which leaves room in few of them."""
        fill = self.fills(place) / self.capacity
        return -len(fill), float((fill * fill).sum())

    def repair(self, place: np.ndarray, displaced: np.ndarray) -> np.ndarray:
        """Numbers the sequences anew without the displaced pieces (place < 0) and best-fits those."""
        held = place >= 0
        _, dense = np.unique(place[held], return_inverse=True)
        place[held] = dense
        fill = np.bincount(dense, weights=self.lengths[held]).astype(np.int64) if held.any() else np.zeros(0, np.int64)
        order = displaced[np.argsort(-self.lengths[displaced], kind="stable")]
        best_fit(order.tolist(), self.plain, self.capacity, place, (self.capacity - fill).tolist())
        return place

    def cross(self, into: np.ndarray, donor: np.ndarray) -> np.ndarray:
        fill = self.fills(donor)
        well = np.flatnonzero(fill >= 0.995 * self.capacity)
        if not len(well):
            well = np.flatnonzero(fill == fill.max())
        chosen = np.zeros(len(fill), dtype=bool)
        chosen[self.random.permutation(well)[: max(1, len(well) // 3)]] = True
        injected = chosen[donor]
        broken = np.zeros(int(into.max()) + 1, dtype=bool)
        broken[into[injected]] = True
        child = into.copy()
        displaced = np.flatnonzero(broken[into] & ~injected)
        child[displaced] = -1
        child[injected] = donor[injected] + len(broken)
        return self.repair(child, displaced)

    def mutate(self, place: np.ndarray) -> np.ndarray:
        """Dissolves the emptiest sequences and a few others."""
        fill = self.fills(place)
        k = max(2, len(fill) // 50)
        loose = np.union1d(np.argsort(fill, kind="stable")[:k], self.random.integers(0, len(fill), k))
        child = place.copy()
        displaced = np.flatnonzero(np.isin(place, loose))
        child[displaced] = -1
        return self.repair(child, self.random.permutation(displaced))

    def evolve(self, population: list[np.ndarray], generations: int, size: int) -> list[np.ndarray]:
        ranked = sorted(((self.fitness(p), k, p) for k, p in enumerate(population)), key=lambda x: (x[0], -x[1]), reverse=True)
        pool = [(f, p) for f, _, p in ranked][:size]
        for _ in range(generations):
            fill = self.fills(pool[0][1])
            if len(fill) <= self.least and (fill < self.capacity).sum() <= 1:
                break  # nothing is left to gain
            a, b = self.random.choice(len(pool), 2, replace=len(pool) < 2)
            child = self.mutate(self.cross(pool[min(a, b)][1], pool[max(a, b)][1]))
            pool.append((self.fitness(child), child))
            pool.sort(key=lambda x: x[0], reverse=True)
            pool = pool[:size]
        return [p for _, p in pool]


_ITEMS = "doc_id array<long>, piece array<int>, start array<long>, length array<long>, ids_crc32 array<long>"
_STATE = f"block long, island int, own boolean, {_ITEMS}, population array<array<int>>"
_NO_ID = -(1 << 63)
# Sequence ids have room for so many; every round but a few closes or saves sequences, so none come near it.
MOST_ROUNDS = 4096
_FIELDS = ["doc_id", "piece", "start", "length", "ids_crc32"]
_PLACED = f"{PIECES}, sequence_id long, offset long, fill long"


def _seed(*numbers) -> int:
    return zlib.crc32(repr(numbers).encode())


def _population(rows) -> list[np.ndarray]:
    return [np.asarray(p, dtype=np.int32) for row in rows for p in row]


def pack_blocks(
    pieces: DataFrame, capacity: int, blocks: int, round_: int, islands: int, population: int, epochs: int, generations: int
) -> DataFrame:
    """Places of all pieces, block by block."""

    def found(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True])
        items = {c: rows[c].to_numpy() for c in _FIELDS}
        states = []
        for k in range(islands):
            island = Island(items["length"].astype(np.int64), capacity, _seed(round_, key[0], k))
            first = island.first(population)
            states.append({"block": key[0], "island": k, "own": True, **items, "population": first})
        return pd.DataFrame(states)

    def epoch(number: int):
        def run(key, rows: pd.DataFrame) -> pd.DataFrame:
            mine = rows[rows["own"]].iloc[0]
            island = Island(np.asarray(mine["length"], dtype=np.int64), capacity, _seed(round_, number, int(key[0]), int(key[1])))
            pool = island.evolve(_population(rows["population"]), generations, population)
            own = {c: mine[c] for c in ("block", "island", "own", *_FIELDS)}
            if number == epochs - 1:
                return pd.DataFrame([own | {"population": pool[:1]}])
            guest = {c: None for c in _FIELDS} | {"block": key[0], "island": (int(key[1]) + 1) % islands, "own": False}
            return pd.DataFrame([own | {"population": pool}, guest | {"population": pool[:1]}])

        return run

    def best(key, rows: pd.DataFrame) -> pd.DataFrame:
        first = rows.sort_values("island").iloc[0]
        lengths = np.asarray(first["length"], dtype=np.int64)
        judge = Island(lengths, capacity, 0)
        place = max(_population(rows.sort_values("island")["population"]), key=judge.fitness)
        order = np.argsort(place, kind="stable")
        ends = np.cumsum(lengths[order])
        fill = judge.fills(place)
        before = np.r_[0, np.cumsum(fill)][:-1]
        out = {c: np.asarray(first[c])[order] for c in _FIELDS}
        out["sequence_id"] = ((int(key[0]) << 24) + place[order].astype(np.int64)) * MOST_ROUNDS + round_
        out["offset"] = ends - lengths[order] - before[place[order]]
        out["fill"] = fill[place[order]]
        return pd.DataFrame(out)

    state = (
        pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32", F.lit(round_)), F.lit(blocks)))
        .groupBy("block")
        .applyInPandas(found, _STATE)
    )
    for number in range(epochs):
        state = state.groupBy("block", "island").applyInPandas(epoch(number), _STATE)
    return state.groupBy("block").applyInPandas(best, _PLACED)


def pack_pieces(
    pieces: DataFrame,
    capacity: int = 4096,
    block_items: int = 1000,
    islands: int = 2,
    population: int = 4,
    epochs: int = 2,
    generations: int = 20,
    rounds: int = MOST_ROUNDS,
    well_filled: float = 0.999,
    calm: int = 3,
) -> DataFrame:
    """sequence_id and offset of each piece (PIECES columns), in as few sequences as the search finds.

    A full piece is a sequence of its own. A round leaves sequences filled to ``well_filled`` and packs the others
    again in fewer blocks; a round that saved none leaves four times the room. Rounds end when one block held all that
    was open, when the open pieces cannot do with fewer sequences, when nothing was filled, or after ``calm`` rounds
    in a row that saved none; the best round's packing counts.
    """
    # Pandas would turn ids beside a null one into floats.
    pieces = kept_table(pieces.withColumn("doc_id", F.coalesce("doc_id", F.lit(_NO_ID))), "pieces")
    columns = [*_FIELDS, "sequence_id", "offset"]
    done = pieces.where(F.col("length") >= capacity).select(
        *_FIELDS, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    open_ = pieces.where(F.col("length") < capacity)
    room = (1 - well_filled) * capacity
    closed, fewest, best, idle = 0, None, None, 0
    for round_ in range(rounds):
        blocks = max(1, math.ceil(open_.count() / block_items))
        placed = kept_table(
            pack_blocks(open_.select(*_FIELDS), capacity, blocks, round_, islands, population, epochs, generations), "placed"
        )
        first = F.col("offset") == 0
        used, tokens = placed.agg(F.count_if(first), F.coalesce(F.sum("length"), F.lit(0))).first()
        if fewest is None or closed + used < fewest:
            fewest, best, idle = closed + used, done.unionByName(placed.select(columns)), 0
        else:
            idle, room = idle + 1, 4 * room
        good = F.col("fill") >= F.lit(capacity - room)
        filled = placed.where(first & good).count()
        if blocks == 1 or used <= math.ceil(tokens / capacity) or not filled or idle == calm:
            break
        closed += filled
        done = done.unionByName(placed.where(good).select(columns))
        open_ = placed.where(~good)
    if best is None:
        raise ValueError("rounds must be at least 1")
    return best.withColumn("doc_id", F.nullif("doc_id", F.lit(_NO_ID)))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, **search) -> DataFrame:
    """Every piece of ``docs`` (doc_id, text, any other columns) and its place.

    A null or empty text is the end id alone; repeated rows are packed once each; an empty table gives no rows.
    """
    return pack_pieces(cut_documents(docs, tokenizer_path, capacity), capacity, **search)
