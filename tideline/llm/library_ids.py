"""Token ids as the tokenizers library gives them, kept per white-space-free chunk and per pre-token.

The library merges nothing across pre-tokens, so a chunk met before is one look-up, a chunk made of known
pre-tokens a few, and only pre-tokens that a worker has never met go to the library.
"""

from __future__ import annotations

import functools
import gc
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tideline.llm.chunks import BEYOND_LATIN, LETTERS, NUMBERS, SPACES, Cache, byte_alphabet, chunks, spaced_chunks, text_slices

# The split patterns of the published files, for a chunk below U+0180.
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
_WORD = re.compile(f"[{LETTERS}]+|[{NUMBERS}]|{_ENDINGS}|[^{LETTERS}{NUMBERS}]+")
_SPACED = re.compile(f"{_ENDINGS}| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+")
# Text that is cut at once; a worker holds about fifteen bytes for each of them while it does.
_SLICE_BYTES = 2_000_000
# Signs that often end a chunk; together they are one pre-token.
_STOPS = ".,;:!?#*$%&|<>()[]\"-"
# A word and its signs, in Arrow's regular expressions. U+0130 alone becomes two characters in lower case.
_WORD_AND_SIGNS = (
    "^(?P<word>[a-zA-Z\\x{aa}\\x{b5}\\x{ba}\\x{c0}-\\x{d6}\\x{d8}-\\x{f6}\\x{f8}-\\x{12f}\\x{131}-\\x{17f}]+)(?P<signs>["
    + re.escape(_STOPS)
    + "]*)$"
)


def _strings(column: pa.Array) -> list:
    return column.to_numpy(zero_copy_only=False).tolist()


def _joined(pool: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries ``which`` of a pool that holds entries of ``sizes`` one after another, and the size of each."""
    n = sizes[which]
    place = np.repeat((np.cumsum(sizes) - sizes)[which] - (np.cumsum(n) - n), n)
    place += np.arange(len(place))
    return pool[place], n


class LibraryIds:
    """Ids of whole texts.

    ``spaced``: a byte-level file that keeps white space; else one of lower-case words that drops it.
    ``specials``: strings of special tokens inside a text are these tokens; else plain text.
    """

    def __init__(self, path: str, owner: str, spaced: bool = False, specials: bool = True, bound: int = 80_000, word_bound: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = not specials
        found = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("(" + "|".join(map(re.escape, found)) + ")") if specials and found else None
        self.spaced, self.chunks = spaced, spaced_chunks if spaced else chunks
        self.cache, self.words = Cache(owner, bound), Cache(owner, word_bound or bound)
        self.model, self.byte = self.library.model, byte_alphabet()
        # Caches hold many small objects and no circles, which frequent collections would walk for nothing.
        gc.set_threshold(500_000, 20, 50)

    def _split(self, chunk: str) -> str | list[str] | None:
        """The pre-token that a chunk is, or its pre-tokens; none for one that goes to the library as it is."""
        if not chunk.isascii() and BEYOND_LATIN.search(chunk) or (self.special and "<|" in chunk and self.special.fullmatch(chunk)):
            return None
        if self.spaced:
            # Most chunks are a blank and a word, and perhaps signs after it.
            bare = chunk[chunk[0] == " " :]
            if bare.isalpha():
                return chunk
            word = bare.rstrip(_STOPS)
            if word.isalpha():
                return [chunk[: len(chunk) - len(bare) + len(word)], bare[len(word) :]]
            return _SPACED.findall(chunk)
        lower = chunk.lower()
        if lower.isalpha():
            return lower
        word = lower.rstrip(_STOPS)
        return [word, lower[len(word) :]] if word.isalpha() else _WORD.findall(lower)

    def _merged(self, word: str) -> bytes:
        """Ids of a pre-token by the library's model alone, which takes the byte alphabet."""
        if word.isascii() and word.isprintable():
            word = word.replace(" ", self.byte[32])
        else:
            word = "".join([self.byte[b] for b in word.encode()])
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _cut(self, text: str) -> list[str]:
        if self.special and "<|" in text and self.special.search(text):
            # A special string is a chunk of its own; the library reads it as one token.
            return [c for i, s in enumerate(self.special.split(text)) for c in ([s] if i % 2 else self.chunks(s))]
        return self.chunks(text)

    def _learn(self, chunks: list[str]) -> None:
        """Ids of chunks that are not known yet."""
        split = list(map(self._split, chunks))
        whole = [c for c, words in zip(chunks, split) if words is None]
        for c, got in zip(whole, self.library.encode_batch_fast(whole, add_special_tokens=False)):
            self.cache[c] = array("I", got.ids).tobytes()
        words: list[str] = []
        for row in split:
            if type(row) is str:
                words.append(row)
            elif row is not None:
                words += row
        got = self._known(words)
        at, cache = 0, self.cache
        for c, row in zip(chunks, split):
            if type(row) is str:
                cache[c] = got[at]
                at += 1
            elif row is not None:
                cache[c] = b"".join(got[at : at + len(row)])
                at += len(row)

    def of(self, texts: list[str]):
        """Ids of each text as little-endian unsigned 32-bit integers."""
        for _, part in text_slices(texts, 500_000):
            rows = [self._cut(text) for text in part]
            got, holes, fresh = self.cache.values(rows)
            self._learn(fresh)
            self.cache.fill(rows, got, holes)
            yield from map(b"".join, got)

    def of_column(self, texts: pa.StringArray):
        """``of`` for an Arrow column without nulls: chunks are cut and told apart by Arrow, so each word is looked up once a slice."""
        if self.spaced:
            yield from self.of(texts.to_pylist())
            return
        size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False) + 8)
        start = 0
        while start < len(texts):
            stop = max(start + 1, int(np.searchsorted(size, (size[start - 1] if start else 0) + _SLICE_BYTES)))
            yield from self._of_slice(texts.slice(start, stop - start))
            start = stop

    def _known(self, words: list[str]) -> list[bytes]:
        """Ids of pre-tokens."""
        (got,), (holes,), fresh = self.words.values([words])
        self.words.update((w, self._merged(w)) for w in fresh)
        self.words.fill([words], [got], [holes])
        return got

    def _of_chunks(self, told: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks one after another, and the number of each chunk's.

        Most are a word and perhaps signs after it. Arrow splits these, so nothing but a word never met costs a call of its own.
        """
        parts = pc.extract_regex(told, _WORD_AND_SIGNS)
        words = pc.utf8_lower(pc.struct_field(parts, "word")).dictionary_encode()
        signs = pc.struct_field(parts, "signs").dictionary_encode()
        other = parts.is_null().to_numpy(zero_copy_only=False)
        rest = _strings(told.filter(pa.array(other)))
        (odd,), (holes,), fresh = self.cache.values([rest])
        self._learn(fresh)
        self.cache.fill([rest], [odd], [holes])
        entries = [*self._known(_strings(words.dictionary) + _strings(signs.dictionary)), *odd, b""]
        sizes = np.fromiter(map(len, entries), dtype=np.int64, count=len(entries)) // 4
        first = words.indices.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        second = signs.indices.fill_null(0).to_numpy(zero_copy_only=False) + len(words.dictionary)
        first[other] = np.arange(len(entries) - 1 - len(odd), len(entries) - 1)
        second[other] = len(entries) - 1
        pool, n = _joined(np.frombuffer(b"".join(entries), dtype="<u4"), sizes, np.c_[first, second].ravel())
        return pool, n.reshape(-1, 2).sum(axis=1)

    def _of_slice(self, texts: pa.StringArray):
        # Arrow also cuts at the four separator controls, and knows no special strings.
        odd = pc.match_substring_regex(texts, "[\\x1c-\\x1f]|<\\|").to_numpy(zero_copy_only=False)
        rows = pc.utf8_split_whitespace(texts)
        told = rows.flatten().dictionary_encode()
        ids, n = _joined(*self._of_chunks(told.dictionary), told.indices.to_numpy())
        raw = memoryview(ids.tobytes())
        cuts = rows.offsets.to_numpy()
        at = (4 * np.r_[0, np.cumsum(n)][cuts - cuts[0]]).tolist()
        for k, special in enumerate(odd.tolist()):
            yield next(self.of([texts[k].as_py()])) if special else bytes(raw[at[k] : at[k + 1]])


@functools.cache
def library_ids(path: str, owner: str, spaced: bool = False, specials: bool = True) -> LibraryIds:
    """One per worker and use."""
    return LibraryIds(path, owner, spaced, specials, word_bound=250_000)
