"""Token counts by rank-synchronous merging of ragged symbol arrays.

A text is cut into chunks; chunks not seen before are split into pre-tokens, and all pre-tokens of a
batch are merged together: one flat array of symbols, one pass per round, in which every sequence
applies its own lowest-rank pair. What is left of a sequence when no pair has a rank is its count.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tideline.llm.chunks import BEYOND_LATIN, LETTERS, NUMBERS, SPACES, Cache, byte_alphabet, spaced_chunks, text_slices
from tideline.llm.frames import id_and_text, map_arrow

_NONE = np.int64(1 << 40)

# Fixed value: the published split pattern of the byte-level file, for text below U+0180.
_OTHER = f"[^{SPACES}{LETTERS}{NUMBERS}]"
_PRE_TOKEN = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?{_OTHER}+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)


class RankMerger:
    """The merge table of a byte-level BPE file as sorted arrays."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made
        self.symbol = np.array([vocab[c] for c in byte_alphabet()], dtype=np.int64)
        self.library_split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        specials = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True)))) if specials else None

    def ranks(self, ids: np.ndarray, seq: np.ndarray) -> np.ndarray:
        """Rank of the pair that starts at each symbol; none at the last symbol of a sequence."""
        out = np.full(len(ids), _NONE)
        here = np.flatnonzero(seq[:-1] == seq[1:])
        pair = (ids[here] << 32) | ids[here + 1]
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        known = self.keys[at] == pair
        out[here[known]] = self.rank[at[known]]
        return out

    def split(self, chunk: str) -> list[str]:
        """Pre-tokens of a chunk; beyond U+017F the library's own tables decide what a letter is."""
        if BEYOND_LATIN.search(chunk):
            return [chunk[a:b] for _, (a, b) in self.library_split(chunk)]
        return _PRE_TOKEN.findall(chunk)

    def surviving(self, words: list[str]) -> np.ndarray:
        """Symbols left of each pre-token."""
        raw = [w.encode() for w in words]
        counts = np.array([len(w) for w in raw], dtype=np.int64)
        ids = self.symbol[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        seq = np.repeat(np.arange(len(words)), counts)
        while len(ids) > 1:
            rank = self.ranks(ids, seq)
            starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            of = np.cumsum(np.r_[True, seq[1:] != seq[:-1]]) - 1
            best = lowest[of]
            hit = (rank == best) & (best < _NONE)
            if not hit.any():
                break
            # Of overlapping places (a run of one symbol) every second one merges, from the left.
            at = np.flatnonzero(hit)
            run = np.r_[True, np.diff(at) > 1]
            first = at[run][np.cumsum(run) - 1]
            at = at[(at - first) % 2 == 0]
            ids[at] = self.made[rank[at]]
            gone = at + 1
            np.subtract.at(counts, seq[gone], 1)
            alive = best < _NONE  # sequences without a ranked pair are done
            alive[gone] = False
            ids, seq = ids[alive], seq[alive]
        return counts

    def chunk_counts(self, chunks: list[str], cache: Cache) -> list[int]:
        """Counts of chunks by way of their pre-tokens, of which ``cache`` keeps the counts."""
        split = [self.split(chunk) for chunk in chunks]
        words = cache.missing(split)
        if words:
            cache.update(zip(words, self.surviving(words).tolist()))
        return [cache[row[0]] if len(row) == 1 else sum([cache[w] for w in row]) for row in split]


@functools.cache
def _merger(path: str) -> tuple[RankMerger, Cache, Cache]:
    return RankMerger(path), Cache("tokens", 500_000), Cache("tokens", 400_000)


def count_tokens(texts: list[str], path: str) -> list[int]:
    """Tokens of each text; a special string inside a text is one token, as the library has it."""
    merger, cache, words = _merger(path)
    out: list[int] = []
    for _, part in text_slices(texts):
        cut, specials = [], []
        for text in part:
            found = len(merger.special.findall(text)) if merger.special and "<|" in text else 0
            specials.append(found)
            cut.append([c for s in merger.special.split(text) for c in spaced_chunks(s)] if found else spaced_chunks(text))
        missing = cache.missing(cut)
        cache.update(zip(missing, merger.chunk_counts(missing, words)))
        out.extend(sum(map(cache.__getitem__, row)) + n for row, n in zip(cut, specials))
    return out


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row of ``docs`` (doc_id, text, any other columns).

    A null or empty text has 0 tokens; repeated rows and ids give a row each; an empty table gives none.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, texts = batch.column(0), batch.column(1)
        n = pa.array(count_tokens(texts.to_pylist(), tokenizer_path), pa.int64())
        size = pc.cast(pc.binary_length(texts), pa.int64())
        return pa.RecordBatch.from_arrays([ids, size, n, pc.greater(n, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return map_arrow(id_and_text(docs), step, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
