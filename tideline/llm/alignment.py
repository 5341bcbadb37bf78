"""Alignment of two tokenizers' tokens over the same bytes.

Per batch, each token start finds the other side's covering token by ``pandas.merge_asof``, keyed by document; the
union of both directions gives all overlaps. Where an overlapping pair ends together, both sides are cut, and the
tokens between two cuts are a group. Counts of the id pairs that end together are taken over all documents.
"""

from __future__ import annotations

import functools
import gc
import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.chunks import Cache, byte_alphabet, text_slices
from tideline.llm.frames import id_and_text, kept_table, map_arrow
from tideline.llm.library_ids import LibraryIds

# Characters that are tokenized and aligned at once.
_CHARS = 300_000
# Rows whose links are counted at once.
_ROWS = 1_000


def byte_level_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level BPE file."""
    from tokenizers import Tokenizer

    byte = {c: b for b, c in enumerate(byte_alphabet())}
    library = Tokenizer.from_file(path)
    out = [b""] * library.get_vocab_size()
    for token, i in library.get_vocab().items():
        out[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
    return out


def piece_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a sentencepiece model: its piece with U+2581 as a blank, or the byte that it names."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
        for i in range(model.get_piece_size())
    ]


class Pair:
    """Both tokenizers of a worker."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.library = LibraryIds(path_a, "alignment", spaced=True, specials=False, bound=150_000)
        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a, self.bytes_b = byte_level_tokens(path_a), piece_tokens(path_b)
        self.pools = tuple(np.frombuffer(b"".join(x), dtype=np.uint8) for x in (self.bytes_a, self.bytes_b))
        self.sizes = tuple(np.array([len(t) for t in x], dtype=np.int64) for x in (self.bytes_a, self.bytes_b))
        # An id as text before each separator.
        self.shown = tuple(np.array([[f"{i}{sep}" for i in range(len(x))] for sep in ",|;"], dtype=object) for x in (self.bytes_a, self.bytes_b))

    def tokens(self, texts: list[str]) -> tuple[Tokens, Tokens]:
        """Tokens of both sides; none for an empty text and for one whose bytes a side does not give back."""
        spaced = [" " + t for t in texts]
        raw = [t.encode() for t in spaced]
        ids = (
            [np.frombuffer(x, "<u4").astype(np.int64) for x in self.library.of(spaced)],
            [np.array(x, dtype=np.int64) for x in self.model.encode(texts, num_threads=1)],
        )
        good = np.array([t != "" for t in texts])
        for of_side, pool, sizes in zip(ids, self.pools, self.sizes):
            good &= _gives_back(of_side, pool, sizes, raw)
        none = np.zeros(0, dtype=np.int64)
        return tuple(Tokens.of([x if ok else none for x, ok in zip(of_side, good)], sizes) for of_side, sizes in zip(ids, self.sizes))


def _gives_back(ids: list[np.ndarray], pool: np.ndarray, sizes: np.ndarray, raw: list[bytes]) -> np.ndarray:
    """Whether the joined bytes of each row of tokens are the text's own."""
    flat = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int64)
    n = sizes[flat]
    place = np.repeat((np.cumsum(sizes) - sizes)[flat] - (np.cumsum(n) - n), n)
    joined = pool[place + np.arange(len(place))].tobytes()
    if joined == b"".join(raw):
        # Equal as a whole; rows are equal too if their lengths are.
        ends = np.r_[0, np.cumsum(n)][np.cumsum([len(x) for x in ids])] if ids else np.zeros(0, dtype=np.int64)
        return np.diff(np.r_[0, ends]) == np.array([len(x) for x in raw])
    out, start = np.zeros(len(raw), dtype=bool), 0
    for k, (x, want) in enumerate(zip(ids, raw)):
        stop = start + int(sizes[x].sum())
        out[k] = joined[start:stop] == want
        start = stop
    return out


@functools.cache
def _pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def _done_with_texts() -> None:
    """Frees what a worker held to tokenize, before steps that only count."""
    if _pair.cache_info().currsize:
        _pair.cache_clear()
        Cache.drop("alignment")
        gc.collect()


@dataclass
class Tokens:
    """Tokens of several documents in a row; places count on over the documents."""

    doc: np.ndarray
    id: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @staticmethod
    def of(ids: list[np.ndarray], sizes: np.ndarray) -> Tokens:
        flat = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int64)
        end = np.cumsum(sizes[flat])
        return Tokens(np.repeat(np.arange(len(ids)), [len(x) for x in ids]), flat, end - sizes[flat], end)

    def frame(self, name: str) -> pd.DataFrame:
        return pd.DataFrame({"doc": self.doc, "start": self.start, name: np.arange(len(self.id))})


def overlaps(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of both sides for each pair that shares a byte."""
    left, right = a.frame("a"), b.frame("b")
    covers_a = pd.merge_asof(left, right, on="start", by="doc")
    covers_b = pd.merge_asof(right, left, on="start", by="doc")
    # Pairs that start together are found from both sides; the second search adds the others.
    inner = a.start[covers_b["a"].to_numpy()] != covers_b["start"].to_numpy() if len(covers_b) else np.zeros(0, dtype=bool)
    i = np.concatenate([covers_a["a"].to_numpy(), covers_b["a"].to_numpy()[inner]]).astype(np.int64)
    j = np.concatenate([covers_a["b"].to_numpy(), covers_b["b"].to_numpy()[inner]]).astype(np.int64)
    return i, j


def ending_together(a: Tokens, b: Tokens, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs that end at one byte, in order of place; a token ends together with one token at most."""
    together = a.end[i] == b.end[j]
    partner = np.full(len(a.id), -1, dtype=np.int64)
    partner[i[together]] = j[together]
    i = np.flatnonzero(partner >= 0)
    return i, partner[i]


def _groups(n: int, cuts: np.ndarray) -> np.ndarray:
    """The group of each of ``n`` tokens, of which those at ``cuts`` are the last of theirs."""
    last = np.zeros(n, dtype=np.int64)
    last[cuts] = 1
    return np.cumsum(last) - last


def _digests(pair: Pair, a: Tokens, b: Tokens, group_a: np.ndarray, group_b: np.ndarray, rows: int) -> list[str]:
    """SHA-256 of the ids of each document's groups, or an empty text."""
    groups = int(group_a[-1]) + 1 if len(group_a) else 0
    n_a, n_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    at_a = np.arange(len(a.id)) + (np.cumsum(n_b) - n_b)[group_a]
    at_b = np.arange(len(b.id)) + np.cumsum(n_a)[group_b]
    shown = np.empty(len(a.id) + len(b.id), dtype=object)
    last_a = np.r_[group_a[1:] != group_a[:-1], True][: len(a.id)]
    last_b = np.r_[group_b[1:] != group_b[:-1], True][: len(b.id)]
    shown[at_a] = pair.shown[0][last_a.astype(np.int64), a.id]
    shown[at_b] = pair.shown[1][2 * last_b.astype(np.int64), b.id]
    ends = np.cumsum(np.bincount(a.doc, minlength=rows) + np.bincount(b.doc, minlength=rows)).tolist()
    parts, start, out = shown.tolist(), 0, []
    for end in ends:
        out.append(hashlib.sha256("".join(parts[start:end])[:-1].encode()).hexdigest() if end > start else "")
        start = end
    return out


_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Numbers, digest of the groups and links (little-endian unsigned 32-bit: id of A times the size of B, plus id of B) of each row.

    A null or empty text, or one that a tokenizer does not give back, has no tokens.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        pair = _pair(path_a, path_b)
        columns: list[list] = [[] for _ in range(6)]
        for _, part in text_slices(batch.column(1).to_pylist(), _CHARS):
            a, b = pair.tokens(part)
            i, j = ending_together(a, b, *overlaps(a, b))
            links = (a.id[i] * len(pair.bytes_b) + b.id[j]).astype("<u4")
            n_links = np.bincount(a.doc[i], minlength=len(part))
            group_a, group_b = _groups(len(a.id), i), _groups(len(b.id), j)
            ends = np.cumsum(n_links).tolist()
            raw = links.tobytes()
            last = np.zeros(len(a.id), dtype=bool)
            last[i] = True
            for held, more in zip(
                columns,
                (
                    np.bincount(a.doc, minlength=len(part)).tolist(), np.bincount(b.doc, minlength=len(part)).tolist(),
                    np.bincount(a.doc[last], minlength=len(part)).tolist(), n_links.tolist(),
                    _digests(pair, a, b, group_a, group_b, len(part)), [raw[4 * s : 4 * e] for s, e in zip([0, *ends], ends)],
                ),
            ):
                held += more
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0)] + [pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in _ALIGNED.split(", ")]
        )

    return map_arrow(id_and_text(docs), step, _ALIGNED)


def align_tokens(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id and the overlapping tokens of each row of ``docs``: a_id, a_start, a_end, b_id, b_start, b_end, a_group, b_group.

    Places are bytes of a blank and the text. Rows without tokens, as in ``aligned``, give an empty list.
    """
    names = ("a_id", "a_start", "a_end", "b_id", "b_start", "b_end", "a_group", "b_group")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        pair = _pair(path_a, path_b)
        out: list[list[dict]] = []
        for _, part in text_slices(batch.column(1).to_pylist(), _CHARS):
            a, b = pair.tokens(part)
            i, j = overlaps(a, b)
            order = np.lexsort((j, i))
            i, j = i[order], j[order]
            last_a, last_b = ending_together(a, b, i, j)
            group_a, group_b = _groups(len(a.id), last_a), _groups(len(b.id), last_b)
            begin = np.zeros(len(part), dtype=np.int64)
            first = np.searchsorted(a.doc, np.arange(len(part)))
            group = np.zeros(len(part), dtype=np.int64)
            some = np.bincount(a.doc, minlength=len(part)) > 0
            begin[some], group[some] = a.start[first[some]], group_a[first[some]]
            doc = a.doc[i]
            columns = (
                a.id[i], a.start[i] - begin[doc], a.end[i] - begin[doc], b.id[j], b.start[j] - begin[doc], b.end[j] - begin[doc],
                group_a[i] - group[doc], group_b[j] - group[doc],
            )
            ends = np.cumsum(np.bincount(doc, minlength=len(part))).tolist()
            rows = [dict(zip(names, row)) for row in zip(*[c.tolist() for c in columns])]
            out += [rows[s:e] for s, e in zip([0, *ends], ends)]
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in names]))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["doc_id", "overlaps"])

    fields = ", ".join(f"{n}: bigint" for n in names)
    return map_arrow(id_and_text(docs), step, f"doc_id long, overlaps array<struct<{fields}>>")


def most_pairs(path_a: str, path_b: str) -> int:
    """A bound on the id pairs that can end together, whatever the documents: one token's bytes end the other's."""
    a, b = byte_level_tokens(path_a), piece_tokens(path_b)
    by_bytes: list[dict[bytes, int]] = [{}, {}]
    for held, tokens in zip(by_bytes, (a, b)):
        for t in tokens:
            held[t] = held.get(t, 0) + 1
    ends_of_a = sum(by_bytes[1].get(t[k:], 0) for t in a for k in range(len(t)))
    return ends_of_a + sum(by_bytes[0].get(t[k:], 0) for t in b for k in range(1, len(t)))


def pair_counts(links: DataFrame, size_b: int) -> DataFrame:
    """link, n (how often it occurs in all documents) and best (whether no link of its id of B occurs more often)."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        _done_with_texts()
        code, n = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        for start in range(0, batch.num_rows, _ROWS):
            more, times = np.unique(np.frombuffer(b"".join(batch.column(0).slice(start, _ROWS).to_pylist()), "<u4"), return_counts=True)
            both, place = np.unique(np.concatenate([code, more]), return_inverse=True)
            n = np.bincount(place, weights=np.concatenate([n, times]), minlength=len(both)).astype(np.int64)
            code = both
        return pa.RecordBatch.from_arrays([pa.array(code.astype(np.int64)), pa.array(n.astype(np.int64))], ["link", "n"])

    counted = map_arrow(links.select("links"), step, "link long, n long").groupBy("link").agg(F.sum("n").alias("n"))
    counted = kept_table(counted, "pairs")
    most = counted.groupBy((F.col("link") % size_b).alias("b")).agg(F.max("n").alias("most"))
    return counted.withColumn("b", F.col("link") % size_b).join(most, "b").select("link", "n", (F.col("n") == F.col("most")).alias("best"))


def alignment_digests(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row of ``docs`` (doc_id, text, any other columns).

    Repeated rows and ids give a row each and count each; a row without tokens has zeros and an empty digest; an
    empty table gives no rows. The counts of pairs are sent to all workers: they are as many as the vocabularies
    allow (``most_pairs``), however many documents there are.
    """
    spark = docs.sparkSession
    held = kept_table(aligned(docs, path_a, path_b), "aligned")
    counts = pair_counts(held, len(piece_tokens(path_b))).toArrow()
    if counts.num_rows > most_pairs(path_a, path_b):
        raise RuntimeError("more pairs than the vocabularies allow")
    order = np.argsort(counts.column("link").to_numpy())
    link, n, best = (counts.column(c).to_numpy()[order] for c in ("link", "n", "best"))
    sent = spark.sparkContext.broadcast((link.astype(np.uint32), n, best))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        _done_with_texts()
        link, n, best = sent.value
        sums: tuple[list, list] = ([], [])
        for start in range(0, batch.num_rows, _ROWS):
            raw = batch.column(1).slice(start, _ROWS).to_pylist()
            ends = np.cumsum([len(x) // 4 for x in raw])
            at = np.searchsorted(link, np.frombuffer(b"".join(raw), "<u4"))
            for held_sums, values in zip(sums, (best, n)):
                total = np.zeros(len(at) + 1, dtype=np.int64)
                np.cumsum(values[at], out=total[1:])
                held_sums += np.diff(total[np.r_[0, ends]]).tolist()
        sums = tuple(pa.array(x, pa.int64()) for x in sums)
        return pa.RecordBatch.from_arrays([batch.column(0), *sums], ["row", "n_best", "count_sum"])

    # The row travels as one field, so that only the links are worked on.
    row = F.struct("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").alias("row")
    kinds = "row struct<doc_id: bigint, n_a: bigint, n_b: bigint, n_groups: bigint, n_links: bigint, groups_sha256: string>"
    found = map_arrow(held.select(row, "links"), step, f"{kinds}, n_best long, count_sum long")
    return found.select(*[f"row.{c}" for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")], "n_best", "count_sum", "row.groups_sha256")
