"""Cutting texts into whitespace-free chunks, the unit that the tokenizers never merge across."""

from __future__ import annotations

import re
from itertools import chain, filterfalse

# The white space of the published tokenizer files' patterns.
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# Below U+0180 the pattern's letters and numbers can be listed.
LETTERS = "a-zA-Z\\xaa\\xb5\\xba\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u017f"
NUMBERS = "0-9\\xb2\\xb3\\xb9\\xbc-\\xbe"
BEYOND_LATIN = re.compile("[^\\x00-\\u017f]")

_CHUNK = re.compile(f"[^{SPACES}]+")
_SPACED_CHUNK = re.compile(f" ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
_SEPARATORS = "\x1c\x1d\x1e\x1f"


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 stands for itself, the other bytes follow from U+0100 in order.
    """
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


def chunks(text: str) -> list[str]:
    """Runs without white space. ``str.split`` also cuts at the four separator controls."""
    return _CHUNK.findall(text) if any(map(text.__contains__, _SEPARATORS)) else text.split()


def spaced_chunks(text: str) -> list[str]:
    """Runs with at most one leading blank, and the white space left between them: they join to the text."""
    return _SPACED_CHUNK.findall(text)


class Cache(dict):
    """Values for the life of a Python worker, in two generations of at most ``bound`` entries each.

    A worker serves several operators one after another. Once the caches of one ``owner`` are read, those
    of the others are emptied, so a worker holds no more than one operator needs.
    """

    _all: list[Cache] = []
    _reading = ""

    def __init__(self, owner: str, bound: int):
        super().__init__()
        self.owner, self.bound, self.older = owner, bound, {}
        Cache._all.append(self)

    def _claim(self) -> None:
        for other in Cache._all:
            if other.owner != self.owner:
                other.clear()
                other.older = {}
        Cache._reading = self.owner

    @classmethod
    def drop(cls, owner: str) -> None:
        """Empties the caches of an owner and forgets them."""
        for held in [c for c in cls._all if c.owner == owner]:
            held.clear()
            held.older = {}
            cls._all.remove(held)

    def missing(self, rows: list[list[str]]) -> list[str]:
        """The keys in ``rows`` without a value. Afterwards every other key can be read from this dict."""
        if Cache._reading != self.owner:
            self._claim()
        fresh = set(chain.from_iterable(filterfalse(self.__contains__, row) for row in rows))
        if self and len(self) + len(fresh) > self.bound:
            self.older = dict(self)
            self.clear()
            fresh = set(chain.from_iterable(rows))
        found = [k for k in fresh if k in self.older]
        self.update((k, self.older[k]) for k in found)
        return [k for k in fresh if k not in self] if found else list(fresh)


    def values(self, rows: list[list[str]]) -> tuple[list[list], list[list[int]], list[str]]:
        """Values of each row with None where one is not known, the places of these, and the keys without a value.

        Each key is looked up once. Once the caller has put the missing values in, ``fill`` completes the rows.
        """
        if Cache._reading != self.owner:
            self._claim()
        if len(self) > self.bound:
            self.older = dict(self)
            self.clear()
        get = self.get
        got = [list(map(get, row)) for row in rows]
        holes = [[i for i, x in enumerate(g) if x is None] for g in got]
        fresh = {row[i] for row, at in zip(rows, holes) for i in at}
        if self.older:
            found = {k: v for k in fresh if (v := self.older.get(k)) is not None}
            self.update(found)
            fresh -= found.keys()
        return got, holes, list(fresh)

    def fill(self, rows: list[list[str]], got: list[list], holes: list[list[int]]) -> None:
        for row, g, at in zip(rows, got, holes):
            for i in at:
                g[i] = self[row[i]]


def text_slices(texts: list[str], chars: int = 2_000_000):
    """Consecutive texts of about ``chars`` characters together, so a batch never grows with the rows."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text) + 40
        if held >= chars:
            yield start, texts[start : i + 1]
            start, held = i + 1, 0
    if start < len(texts):
        yield start, texts[start:]
