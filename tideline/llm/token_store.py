"""Token ids of documents as raw binary shards, and a minimal perfect hash index from document keys into them.

A store is a folder in the shared file system:

* ``shards/N.ids``: ids of consecutive documents in key order, 2 or 4 bytes each, little-endian; then where each
  document ends (ids, 8 bytes each), its key (8 bytes) and whether it has one (1 byte); last a fixed tail with counts.
* ``index/S.mph``: for the keys of one hash segment, a minimal perfect hash (levels of bit arrays; a key that shares
  its bit with another goes to the next level; its number is the rank of its bit) and, by that number, a
  fingerprint of the key, its first shard, its record and place there and over how many shards its documents go.
* ``runs``, ``totals``: Parquet tables of what each shard holds and of the ids before it.

A key is found with one segment file, a few bit tests and one place in one shard, whatever the size of the store;
keys that were never stored are told by their fingerprint and by the key kept in the shard.
"""

from __future__ import annotations

import functools
import math
import struct
import uuid
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.llm.frames import id_and_text, kept_table, map_arrow
from tideline.llm.library_ids import library_ids
from tideline.operators.joins import join_small
from tideline.session import new_folder

_TAIL = "<8sIIQQ"  # magic, version, bytes an id, documents, ids
_MAGIC, _INDEX_MAGIC = b"TLIDS\0\0\1", b"TLMPH\0\0\1"
_LEVELS, _BITS_PER_KEY = 32, 2
# Ids that one shard is meant to hold, and keys of one index segment.
SHARD_BYTES, SEGMENT_KEYS = 32 << 20, 32_000
_READ_AT_ONCE = 8 << 20


def file_system(path: str):
    """The file system of a folder that Spark names, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def publish(path: str, parts: Iterator[bytes]) -> None:
    """Writes a file under a name of its own and moves it into place, so a retried task leaves whole files only."""
    files, place = file_system(path)
    files.create_dir(place.rpartition("/")[0], recursive=True)
    made = f"{place}.{uuid.uuid4().hex}"
    with files.open_output_stream(made) as out:
        for part in parts:
            out.write(part)
    files.move(made, place)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one finalizer over 64 bits."""
    x = np.asarray(x).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Numbers 0 to n - 1 for n distinct 64-bit hashes, kept in a few bits each."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest
        self.ranks = []
        before = 0
        for bits in levels:
            counts = np.bitwise_count(bits).astype(np.int64)
            self.ranks.append(before + np.cumsum(counts) - counts)
            before += int(counts.sum())
        self.placed = before

    @staticmethod
    def _slots(hashes: np.ndarray, level: int, words: int) -> np.ndarray:
        return mix(hashes + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % (1 << 64))) % np.uint64(64 * words)

    @staticmethod
    def build(hashes: np.ndarray) -> PerfectHash:
        levels = []
        left = np.asarray(hashes, dtype=np.uint64)
        while len(left) and len(levels) < _LEVELS:
            words = math.ceil(_BITS_PER_KEY * len(left) / 64)
            slot = PerfectHash._slots(left, len(levels), words).astype(np.int64)
            alone = np.bincount(slot, minlength=64 * words) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[slot]]
        return PerfectHash(levels, np.sort(left))

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash that was built in; any number or -1 for another."""
        hashes = np.asarray(hashes, dtype=np.uint64)
        out = np.full(len(hashes), -1, dtype=np.int64)
        open_ = np.arange(len(hashes))
        for k, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            slot = self._slots(hashes[open_], k, len(bits))
            word, bit = (slot >> np.uint64(6)).astype(np.int64), slot & np.uint64(63)
            hit = (bits[word] >> bit) & np.uint64(1) == 1
            below = bits[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[open_[hit]] = ranks[word[hit]] + np.bitwise_count(below)
            open_ = open_[~hit]
        if len(self.rest) and len(open_):
            at = np.minimum(np.searchsorted(self.rest, hashes[open_]), len(self.rest) - 1)
            known = self.rest[at] == hashes[open_]
            out[open_[known]] = self.placed + at[known]
        return out

    def parts(self) -> Iterator[bytes]:
        yield struct.pack("<II", len(self.levels), len(self.rest))
        yield np.array([len(x) for x in self.levels], dtype="<u4").tobytes()
        for bits in self.levels:
            yield bits.astype("<u8").tobytes()
        yield self.rest.astype("<u8").tobytes()

    @staticmethod
    def read(raw: memoryview) -> tuple[PerfectHash, memoryview]:
        n, rest = struct.unpack_from("<II", raw)
        sizes = np.frombuffer(raw, "<u4", n, 8).tolist()
        at, levels = 8 + 4 * n, []
        for size in sizes:
            levels.append(np.frombuffer(raw, "<u8", size, at))
            at += 8 * size
        return PerfectHash(levels, np.frombuffer(raw, "<u8", rest, at)), raw[at + 8 * rest :]


# What the index stores by number.
_ENTRY = np.dtype([("print", "<u4"), ("shard", "<u4"), ("over", "<u4"), ("record", "<u4"), ("offset", "<u8"), ("length", "<u8")])


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype(np.uint32)


@dataclass
class Segment:
    """One index file."""

    hash: PerfectHash
    entries: np.ndarray

    @staticmethod
    def build(rows: pd.DataFrame) -> Segment:
        """``rows``: key, shard, record, offset, length of the runs of all keys of the segment."""
        rows = rows.sort_values(["key", "shard"])
        firsts = rows.drop_duplicates("key")
        hashes = mix(firsts["key"].to_numpy().astype(np.int64))
        found = PerfectHash.build(hashes)
        entries = np.zeros(len(firsts), dtype=_ENTRY)
        at = found.number(hashes)
        entries["print"][at] = fingerprint(hashes)
        entries["over"][at] = rows.groupby("key", sort=True).size().to_numpy()
        for name in ("shard", "record", "offset", "length"):
            entries[name][at] = firsts[name].to_numpy()
        return Segment(found, entries)

    def parts(self) -> Iterator[bytes]:
        yield _INDEX_MAGIC
        yield from self.hash.parts()
        yield self.entries.tobytes()

    @staticmethod
    def read(path: str) -> Segment:
        files, place = file_system(path)
        try:
            with files.open_input_file(place) as f:
                raw = memoryview(f.read())
        except FileNotFoundError:  # no key fell into this segment
            return Segment(PerfectHash([], np.zeros(0, dtype=np.uint64)), np.zeros(0, dtype=_ENTRY))
        if bytes(raw[:8]) != _INDEX_MAGIC:
            raise ValueError(f"{path} is no index segment")
        found, rest = PerfectHash.read(raw[8:])
        return Segment(found, np.frombuffer(rest, dtype=_ENTRY))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in ``keys``, entries) of the keys whose fingerprint fits."""
        hashes = mix(keys.astype(np.int64))
        number = self.hash.number(hashes)
        held = np.flatnonzero(number >= 0)
        held = held[self.entries["print"][number[held]] == fingerprint(hashes[held])]
        return held, self.entries[number[held]]


class Shard:
    """One file of ids, read a few places at a time."""

    def __init__(self, path: str):
        files, place = file_system(path)
        self.file = files.open_input_file(place)
        size = self.file.size()
        magic, _, self.width, self.docs, self.ids = struct.unpack(_TAIL, self._at(size - struct.calcsize(_TAIL), struct.calcsize(_TAIL)))
        if magic != _MAGIC:
            raise ValueError(f"{path} is no shard")
        raw = self._at(self.ids * self.width, 17 * self.docs)
        self.ends = np.frombuffer(raw, "<u8", self.docs).astype(np.int64)
        self.keys = np.frombuffer(raw, "<i8", self.docs, 8 * self.docs)
        # Documents without a key come first, the others by key.
        self.without_key = int(np.frombuffer(raw, "u1", self.docs, 16 * self.docs).sum())

    def _at(self, offset: int, size: int) -> bytes:
        return self.file.read_at(size, offset)

    def start(self, record: int) -> int:
        return int(self.ends[record - 1]) if record else 0

    def records(self, key: int | None, record: int) -> range:
        """The records of a key that begin at ``record``; none if another key lies there."""
        first = self.without_key
        if key is None:
            return range(record, max(record, first))
        start = max(record, first)
        if start >= self.docs or self.keys[start] != key:
            return range(0)
        return range(start, first + int(np.searchsorted(self.keys[first:], key, side="right")))

    def payloads(self, records: list[int]) -> Iterator[tuple[int, bytes]]:
        """(record, ids as little-endian unsigned 32-bit integers); neighbours are read together."""
        k = 0
        while k < len(records):
            first = start = self.start(records[k])
            stop = k
            while stop < len(records) and (int(self.ends[records[stop]]) - first) * self.width <= _READ_AT_ONCE and (
                stop == k or self.start(records[stop]) - int(self.ends[records[stop - 1]]) < 4096
            ):
                stop += 1
            stop = max(stop, k + 1)
            raw = self._at(first * self.width, (int(self.ends[records[stop - 1]]) - first) * self.width)
            ids = np.frombuffer(raw, f"<u{self.width}").astype("<u4")
            for r in records[k:stop]:
                start = self.start(r) - first
                yield r, ids[start : int(self.ends[r]) - first].tobytes()
            k = stop

    def close(self) -> None:
        self.file.close()


_RUNS = "absent boolean, key long, shard int, record long, docs long, offset long, length long, ids long, hash long"


def _encoded(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """doc_id, number of ids and ids, 2 or 4 bytes each and compressed for the way, of each row, the end id included."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = library_ids(tokenizer_path, "store")
        wide = _width(coder.library.get_vocab_size(), end_id) == 4
        end, squeeze = struct.pack("<I", end_id), zstandard.ZstdCompressor(level=1).compress
        n, packed = [], []
        for raw in coder.of_column(batch.column(1)):
            raw += end
            n.append(len(raw) // 4)
            packed.append(squeeze(raw if wide else np.frombuffer(raw, "<u4").astype("<u2").tobytes()))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(packed, pa.binary())], ["doc_id", "n", "ids"])

    return map_arrow(id_and_text(docs), step, "doc_id long, n long, ids binary")


def _width(vocabulary: int, end_id: int) -> int:
    """Bytes of an id in the files."""
    return 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4


def _write_shards(encoded: DataFrame, width: int, root: str, shard_bytes: int) -> DataFrame:
    """Writes the shards, one task each, and returns the runs of equal keys in them."""
    size = (encoded.agg(F.sum("n")).first()[0] or 0) * width
    shards = max(encoded.sparkSession.sparkContext.defaultParallelism, math.ceil(size / shard_bytes))
    # Equal keys, and even equal rows, can go to several shards, so none grows with a hot key.
    order = ["doc_id", "tie", "row"]
    placed = encoded.select("doc_id", F.xxhash64("ids").alias("tie"), F.monotonically_increasing_id().alias("row"), "ids")
    ordered = placed.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("doc_id", "ids")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        keys: list[int | None] = []
        lengths = array("q")
        unpack = zstandard.ZstdDecompressor().decompress

        def parts() -> Iterator[bytes]:
            for batch in batches:
                keys.extend(batch.column(0).to_pylist())
                for raw in map(unpack, batch.column(1).to_pylist()):
                    lengths.append(len(raw) // width)
                    yield raw
            ends = np.cumsum(np.frombuffer(lengths, dtype=np.int64)) if lengths else np.zeros(0, dtype=np.int64)
            yield ends.astype("<u8").tobytes()
            yield np.array([k or 0 for k in keys], dtype="<i8").tobytes()
            yield np.array([k is None for k in keys], dtype="u1").tobytes()
            yield struct.pack(_TAIL, _MAGIC, 1, width, len(keys), int(ends[-1]) if len(ends) else 0)

        publish(f"{root}/shards/{number:08d}.ids", parts())
        if not keys:
            return
        out, record, offset = [], 0, 0
        for key, same in groupby(keys):
            n = sum(1 for _ in same)
            ids = sum(lengths[record : record + n])
            out.append((key is None, key, number, record, n, offset, lengths[record], ids))
            record, offset = record + n, offset + ids
        columns = [list(c) for c in zip(*out)]
        hashes = mix(np.array([k or 0 for k in columns[1]], dtype=np.int64)).view(np.int64)
        kinds = [pa.bool_(), pa.int64(), pa.int32()] + [pa.int64()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)] + [pa.array(hashes)], [c.split()[0] for c in _RUNS.split(", ")]
        )

    return ordered.mapInArrow(step, _RUNS)


def _starts(runs: DataFrame) -> DataFrame:
    """shard, and the documents and ids of all shards before it: sums over blocks of shards, then within a block."""
    totals = runs.groupBy("shard").agg(F.sum("docs").alias("docs"), F.sum("ids").alias("ids")).withColumn("block", F.floor(F.col("shard") / 1024))
    blocks = totals.groupBy("block").agg(F.sum("docs").alias("docs"), F.sum("ids").alias("ids"))

    def before(name: str, window) -> Column:
        return F.coalesce(F.sum(name).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    every, inside = Window.partitionBy(F.lit(0)).orderBy("block"), Window.partitionBy("block").orderBy("shard")
    of_block = blocks.select("block", before("docs", every).alias("block_docs"), before("ids", every).alias("block_ids"))
    return totals.join(of_block, "block").select(
        "shard", (F.col("block_docs") + before("docs", inside)).alias("first_doc"), (F.col("block_ids") + before("ids", inside)).alias("first_id")
    )


def _segment(hash_column: str, segments: int) -> Column:
    return F.pmod(F.shiftrightunsigned(hash_column, 33), F.lit(segments)).cast("int")


@dataclass(frozen=True)
class TokenStore:
    """A written store. ``segments`` is the number of index files."""

    spark: SparkSession
    root: str
    segments: int

    def totals(self) -> DataFrame:
        return self.spark.read.schema("shard int, first_doc long, first_id long").parquet(f"{self.root}/totals")

    def runs(self) -> DataFrame:
        return self.spark.read.schema(_RUNS).parquet(f"{self.root}/runs")

    def segment_of(self, key: int) -> int:
        return (int(mix(np.array([key]))[0]) >> 33) % self.segments

    def get(self, key: int) -> list[bytes]:
        """Ids of the documents of one key, read directly; nothing for a key that is not stored."""
        _, found = _segment_file(f"{self.root}/index/{self.segment_of(key):08d}.mph").find(np.array([key]))
        out: list[bytes] = []
        for entry in found:
            for k in range(int(entry["over"])):
                shard = Shard(f"{self.root}/shards/{int(entry['shard']) + k:08d}.ids")
                records = shard.records(key, 0 if k else int(entry["record"]))
                out += [raw for _, raw in shard.payloads(list(records))]
                shard.close()
        return out

    def find(self, keys: DataFrame) -> DataFrame:
        """shard, record and key of the first document of each of ``keys`` (doc_id) there, by way of the index.

        A key over several shards has a row for each; a null key is where its runs are.
        """
        root, segments = self.root, self.segments

        def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hashes = mix(np.asarray(batch.column(0))).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashes)], ["key", "hash"])

        def look_up(group: pa.Table) -> pa.Table:
            wanted = group.column("key").to_numpy()
            held, entries = _segment_file(f"{root}/index/{group.column('segment')[0].as_py():08d}.mph").find(wanted)
            return pa.table(
                {"key": wanted[held], "shard": entries["shard"].astype(np.int32), "over": entries["over"].astype(np.int32), "record": entries["record"].astype(np.int64)}
            )

        distinct = keys.select(F.col("doc_id").cast("long").alias("key")).where("key is not null").distinct()
        placed = distinct.mapInArrow(hashed, "key long, hash long").select("key", _segment("hash", segments).alias("segment"))
        found = placed.groupBy("segment").applyInArrow(look_up, "key long, shard int, over int, record long")
        each = found.select("key", "record", F.posexplode(F.sequence("shard", F.col("shard") + F.col("over") - 1)).alias("k", "shard"))
        present = each.select("shard", F.when(F.col("k") == 0, F.col("record")).otherwise(0).cast("long").alias("record"), "key")
        asked = keys.where("doc_id is null").limit(1).select(F.lit(True).alias("absent"))
        absent = self.runs().where("absent").join(asked, "absent", "left_semi").select("shard", "record", F.lit(None).cast("long").alias("key"))
        return present.unionByName(absent)

    def read(self, keys: DataFrame) -> DataFrame:
        """doc_id, start (ids of all documents before it) and ids (little-endian unsigned 32-bit integers, binary) of
        every stored document of ``keys`` (doc_id, any other columns; repeats count once). Unknown keys give no row."""
        root = self.root

        def read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard, number = None, None
            for batch in batches:
                asked = zip(*[c.to_pylist() for c in batch.columns])
                for k, rows in groupby(asked, key=lambda r: r[0]):
                    if k != number:
                        if shard:
                            shard.close()
                        shard, number = Shard(f"{root}/shards/{k:08d}.ids"), k
                    wanted = {r: key for _, record, key in rows for r in shard.records(key, record)}
                    out: list[tuple] = []
                    held = 0
                    for r, raw in shard.payloads(sorted(wanted)):
                        out.append((k, wanted[r], shard.start(r), raw))
                        held += len(raw)
                        if held > _READ_AT_ONCE:
                            yield _documents(out)
                            out, held = [], 0
                    if out:
                        yield _documents(out)
            if shard:
                shard.close()

        asked = self.find(keys).select("shard", "record", "key").repartition("shard").sortWithinPartitions("shard", "record")
        documents = asked.mapInArrow(read_shards, "shard int, doc_id long, at long, ids binary")
        return join_small(documents, self.totals(), ["shard"]).select("doc_id", (F.col("first_id") + F.col("at")).alias("start"), "ids")


def _documents(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["shard", "doc_id", "at", "ids"])


@functools.lru_cache(maxsize=4)
def _segment_file(path: str) -> Segment:
    return Segment.read(path)


def write_store(
    docs: DataFrame, tokenizer_path: str, root: str | None = None, end_id: int = 1, shard_bytes: int = SHARD_BYTES, segment_keys: int = SEGMENT_KEYS
) -> TokenStore:
    """Stores the ids of each row of ``docs`` (doc_id, text, any other columns), ``end_id`` after each, in doc_id order.

    Rows without an id come first; rows that share an id lie together, equal or not; a null text counts as empty and
    has ``end_id`` alone. An empty table gives an empty store. ``root`` is a new folder that all executors reach; by
    default one under the shared folder.
    """
    spark = docs.sparkSession
    root = root or new_folder(spark, "tokens")
    # Encoded once; sampling key ranges, and a retried shard, read the ids.
    encoded = kept_table(_encoded(docs, tokenizer_path, end_id), "encoded")
    width = _width(library_ids(tokenizer_path, "store").library.get_vocab_size(), end_id)
    _write_shards(encoded, width, root, shard_bytes).write.parquet(f"{root}/runs")
    runs = spark.read.schema(_RUNS).parquet(f"{root}/runs")
    _starts(runs).write.parquet(f"{root}/totals")
    segments = max(1, math.ceil(runs.where("not absent").count() / segment_keys))

    def index(group: pa.Table) -> pa.Table:
        rows = group.to_pandas()
        segment = int(rows["segment"].iloc[0])
        built = Segment.build(rows)
        publish(f"{root}/index/{segment:08d}.mph", built.parts())
        return pa.table({"segment": pa.array([segment], pa.int32()), "keys": pa.array([len(built.entries)], pa.int64())})

    keyed = runs.where("not absent").select("key", "shard", "record", "offset", "length", _segment("hash", segments).alias("segment"))
    keyed.groupBy("segment").applyInArrow(index, "segment int, keys long").write.parquet(f"{root}/segments")
    return TokenStore(spark, root, segments)


def stored_digests(docs: DataFrame, tokenizer_path: str, **parameters) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each row of ``docs``, from a store that is written and read back by its index."""
    read = write_store(docs, tokenizer_path, **parameters).read(docs)
    return read.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
