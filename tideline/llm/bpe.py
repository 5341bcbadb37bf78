"""Byte-pair encoding with a priority queue over a doubly linked symbol list, and decoding.

Each worker keeps the chunks it has met, so a word is merged once and looked up afterwards.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tideline.llm.chunks import BEYOND_LATIN, LETTERS, NUMBERS, Cache, byte_alphabet, chunks, text_slices
from tideline.llm.frames import id_and_text, map_arrow

# Fixed value: the file's split pattern, for a chunk below U+0180.
_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{LETTERS}{NUMBERS}]+")


def merge_symbols(symbols: list[int], merges: dict[int, tuple[int, int]]) -> list[int]:
    """Merges the lowest rank first, the leftmost of equal ranks; entries that no longer hold are skipped.

    ``merges``: left << 32 | right -> (rank, merged symbol).
    """
    n = len(symbols)
    ids = symbols[:]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = []
    for i in range(n - 1):
        found = merges.get((ids[i] << 32) | ids[i + 1])
        if found:
            queue.append((found[0], i, ids[i], ids[i + 1], found[1]))
    heapify(queue)
    while queue:
        _, i, left, right, merged = heappop(queue)
        j = after[i]
        if ids[i] != left or j >= n or ids[j] != right:
            continue
        ids[i], ids[j] = merged, -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            found = merges.get((merged << 32) | ids[k])
            if found:
                heappush(queue, (found[0], i, merged, ids[k], found[1]))
        h = before[i]
        if h >= 0:
            found = merges.get((ids[h] << 32) | merged)
            if found:
                heappush(queue, (found[0], h, ids[h], merged, found[1]))
    return [x for x in ids if x >= 0]


class WordBpe:
    """A BPE file with word ends: lower case, white space dropped, no decoder of its own."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = {(self.vocab[a] << 32) | self.vocab[b]: (r, self.vocab[a + b]) for r, (a, b) in enumerate(pairs)}
        self.token = {i: s for s, i in self.vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")")
        library = Tokenizer.from_file(path)
        self.normalize, self.pre_tokenize = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.byte = byte_alphabet()

    def words(self, chunk: str) -> list[str]:
        """Pre-tokens of a chunk in the byte alphabet."""
        if BEYOND_LATIN.search(chunk):
            return [w for w, _ in self.pre_tokenize(self.normalize(chunk))]
        # Below U+0180 the composed form is the text itself.
        return ["".join([self.byte[b] for b in w.encode()]) for w in _WORD.findall(chunk.lower())]

    def encode_word(self, word: str) -> list[int]:
        symbols = [self.vocab[c] for c in word[:-1]] + [self.vocab[word[-1] + self.end]]
        return merge_symbols(symbols, self.merges)

    def encode_chunks(self, chunks: list[str], cache: Cache) -> list[list[int]]:
        """Ids of chunks by way of their words, of which ``cache`` keeps the ids."""
        split = [self.words(c) for c in chunks]
        for w in cache.missing(split):
            cache[w] = self.encode_word(w)
        return [cache[row[0]] if len(row) == 1 else [i for w in row for i in cache[w]] for row in split]

    def decode(self, ids) -> str:
        """Vocabulary strings, joined by blanks as the library does for a file without decoder."""
        return " ".join([self.token[i] for i in ids])


@functools.cache
def _coder(path: str) -> tuple[WordBpe, Cache, Cache]:
    return WordBpe(path), Cache("bpe", 300_000), Cache("bpe", 250_000)


def encode_texts(texts: list[str], path: str):
    """(ids as little-endian unsigned 32-bit integers, decoded text) of each text."""
    coder, cache, words = _coder(path)
    for _, part in text_slices(texts):
        cut = []
        for text in part:
            if "<|" in text and coder.special.search(text):
                row = []
                for s in coder.special.split(text):
                    row.extend([s] if s in coder.specials else chunks(s))
                cut.append(row)
            else:
                cut.append(chunks(text))
        missing = cache.missing(cut)
        # A special string can only be a chunk of its own where it was cut out as one.
        for c in [c for c in missing if c in coder.specials]:
            cache[c] = (pack("<I", coder.specials[c]), c)
        missing = [c for c in missing if c not in coder.specials]
        for c, ids in zip(missing, coder.encode_chunks(missing, words)):
            cache[c] = (pack(f"<{len(ids)}I", *ids), coder.decode(ids))
        for row in cut:
            got = [cache[c] for c in row]
            yield b"".join([x[0] for x in got]), " ".join([x[1] for x in got if x[1]])


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, ids (array of long) and decoded text of each row of ``docs`` (doc_id, text, any other columns).

    A null or empty text has no ids and decodes to an empty text; repeated rows give a row each.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, texts = [], []
        for raw, text in encode_texts(batch.column(1).to_pylist(), tokenizer_path):
            ids.append(np.frombuffer(raw, dtype="<u4").astype(np.int64))
            texts.append(text)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(ids, pa.list_(pa.int64())), pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"]
        )

    return map_arrow(id_and_text(docs), step, "doc_id long, ids array<long>, decoded string")


def encoded_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of the ids and of the decoded text: ``encode_documents`` without moving ids."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, ids, decoded = [], [], []
        for raw, text in encode_texts(batch.column(1).to_pylist(), tokenizer_path):
            n.append(len(raw) // 4)
            ids.append(hashlib.sha256(raw).hexdigest())
            decoded.append(hashlib.sha256(text.encode()).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return map_arrow(id_and_text(docs), step, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
