"""Spelling variants: words one edit apart, found by k-d trees over letter-count vectors.

One inserted or deleted letter moves the vector of letter counts by 1 in L1 distance, one replaced letter by
2. Words of one length are the points of one tree; words of the same length query it within distance 2 and
those one letter shorter within distance 1. The upper part of the tree, fitted on a bounded sample, deals
points to cells; a query goes to the cells whose boxes it can reach. In a cell a tree over all its points
prunes by the boxes of its nodes, and what is left is verified letter by letter.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.chunks import text_slices
from tideline.llm.frames import id_and_text, kept_table, map_arrow
from tideline.operators.joins import join_small

# Fixed values of the contract: what a word is, which runs lose a letter, which words count.
SHORTEST, FEWEST, LOSE_EVERY = 5, 3, 97
_RUN = re.compile("[A-Za-z\\u00C0-\\u00FF]{%d,}" % SHORTEST)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

DIMS = 32
# Words that a cell is meant to hold, and sampled words that the upper tree of one length is fitted on.
CELL_WORDS, SAMPLE = 8_000, 20_000
_LEAF = 48
_HELD = 300_000


def _runs(doc_id: int | None, text: str) -> Counter:
    """Words of one text with their counts; a null id counts as an empty one."""
    start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    out: Counter = Counter()
    for run, n in Counter(_RUN.findall(text.encode().translate(_LOWER).decode())).items():
        h = zlib.crc32(run.encode(), start)
        if h % LOSE_EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < SHORTEST:
                continue
        out[run] += n
    return out


def word_counts(docs: DataFrame, fewest: int = FEWEST) -> DataFrame:
    """word and n of the words of ``docs`` (doc_id, text, any other columns) that occur often enough.

    A null or empty text has no words; repeated rows count each. Counts are summed in the worker before the shuffle.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for start, part in text_slices(batch.column(1).to_pylist()):
                for doc_id, text in zip(ids[start : start + len(part)], part):
                    held.update(_runs(doc_id, text))
                if len(held) > _HELD:
                    yield rows()
        if held:
            yield rows()

    counted = id_and_text(docs).mapInArrow(step, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= fewest)


def letter_counts(words: list[str]) -> np.ndarray:
    """len(words) x DIMS counts: a to z, and the other letters folded into the rest, which never adds distance."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    code = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    dim = np.where((code >= 97) & (code <= 122), code - 97, 26 + code % (DIMS - 26))
    flat = np.repeat(np.arange(len(words)), sizes) * DIMS + dim
    return np.minimum(np.bincount(flat, minlength=len(words) * DIMS).reshape(-1, DIMS), 10_000).astype(np.int16)


def one_edit(short: list[str], long: list[str]) -> np.ndarray:
    """Whether each pair, of equal lengths or one apart, differs by exactly one letter. All ``long`` have one length, and so have all ``short``."""
    if not short:
        return np.zeros(0, dtype=bool)
    a, b = (np.frombuffer("".join(x).encode("utf-32-le"), dtype=np.uint32).reshape(len(x), -1) for x in (short, long))
    n = a.shape[1]
    if b.shape[1] == n:
        return (a != b).sum(axis=1) == 1
    prefix = np.cumprod(a == b[:, :n], axis=1, dtype=np.int64).sum(axis=1)
    suffix = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype=np.int64).sum(axis=1)
    return prefix + suffix >= n


class UpperTree:
    """Splits of the letter-count space of one length, so that a cell holds about ``cell_words``."""

    def __init__(self, sample: np.ndarray, words: int, cell_words: int):
        self.nodes: list[tuple[int, int, int, int]] = []  # dimension (-1: cell), largest count on the left, left, right or cell
        self.cells = 0
        self._grow(sample, max(1, round(len(sample) * cell_words / max(words, 1))))

    def _grow(self, rows: np.ndarray, least: int) -> int:
        here = len(self.nodes)
        self.nodes.append((-1, 0, 0, 0))
        best = None
        if len(rows) > least:
            for dim in np.argsort(-rows.var(axis=0))[:4].tolist():
                cut = int(np.median(rows[:, dim]))
                left = int((rows[:, dim] <= cut).sum())
                if left == len(rows):
                    cut, left = cut - 1, int((rows[:, dim] <= cut - 1).sum())
                if 0 < left < len(rows) and (best is None or abs(2 * left - len(rows)) < best[0]):
                    best = abs(2 * left - len(rows)), dim, cut
        if best is None:
            self.nodes[here] = (-1, 0, 0, self.cells)
            self.cells += 1
            return here
        _, dim, cut = best
        on_left = rows[:, dim] <= cut
        self.nodes[here] = (dim, cut, self._grow(rows[on_left], least), self._grow(rows[~on_left], least))
        return here

    def cell(self, rows: np.ndarray) -> np.ndarray:
        """The cell of each point."""
        out = np.zeros(len(rows), dtype=np.int64)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, at = todo.pop()
            dim, cut, left, right = self.nodes[node]
            if dim < 0:
                out[at] = right
            elif len(at):
                low = rows[at, dim] <= cut
                todo += [(left, at[low]), (right, at[~low])]
        return out

    def reach(self, rows: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) for the cells whose box is within ``radius`` of each row."""
        found = []
        free = (-1, 1 << 20)
        todo = [(0, np.arange(len(rows)), np.zeros(len(rows), dtype=np.int64), {})]
        while todo:
            node, at, far, box = todo.pop()
            dim, cut, left, right = self.nodes[node]
            if dim < 0:
                found.append((at, np.full(len(at), right)))
                continue
            low, high = box.get(dim, free)
            count = rows[at, dim].astype(np.int64)
            outside = np.maximum(low - count, 0) + np.maximum(count - high, 0)
            for child, bounds in ((left, (low, min(high, cut))), (right, (max(low, cut + 1), high))):
                now = far - outside + np.maximum(bounds[0] - count, 0) + np.maximum(count - bounds[1], 0)
                near = now <= radius
                if near.any():
                    todo.append((child, at[near], now[near], box | {dim: bounds}))
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return tuple(np.concatenate(c) for c in zip(*found))


def _leaves(rows: np.ndarray, at: np.ndarray) -> dict:
    """A k-d tree over ``rows[at]``: nodes with the box of their points, leaves with the points."""
    own = rows[at]
    node = {"low": own.min(axis=0), "high": own.max(axis=0)}
    dim = int(np.argmax(node["high"] - node["low"]))
    if len(at) <= _LEAF or node["low"][dim] == node["high"][dim]:
        return node | {"at": at}
    by = np.argsort(own.var(axis=0))[-1]
    cut = np.median(own[:, by])
    left = own[:, by] <= cut
    if left.all():
        left = own[:, by] < cut
    return node | {"parts": [_leaves(rows, at[left]), _leaves(rows, at[~left])]}


def within(points: np.ndarray, queries: np.ndarray, radius: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, point) numbers within each query's L1 ``radius``, a bounded number at a time."""
    if not len(points):
        return
    todo = [(_leaves(points, np.arange(len(points))), np.arange(len(queries)))]
    while todo:
        node, at = todo.pop()
        own = queries[at]
        far = (np.maximum(node["low"] - own, 0) + np.maximum(own - node["high"], 0)).sum(axis=1)
        at = at[far <= radius[at]]
        if not len(at):
            continue
        if "parts" in node:
            todo += [(part, at) for part in node["parts"]]
            continue
        for p in range(0, len(node["at"]), 256):
            some = node["at"][p : p + 256]
            for k in range(0, len(at), 2_000):
                q = at[k : k + 2_000]
                gap = np.abs(queries[q][:, None, :] - points[some][None, :, :]).sum(axis=2)
                i, j = np.nonzero(gap <= radius[q][:, None])
                yield q[i], some[j]


def _deal(words: DataFrame, trees: dict[int, UpperTree]) -> DataFrame:
    """Each word as a point of its length's tree (side 0) and as queries (side 1): tree, cell, side, own, word, n.

    A pair of one length is met in the cell with the larger number; ``own`` marks queries of the query's own cell.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, counts = batch.column(0).to_pylist(), np.asarray(batch.column(1))
        length = np.array([len(w) for w in words], dtype=np.int64)
        parts: list[tuple[np.ndarray, ...]] = []  # row, tree, cell, side, own

        def add(at, tree, cell, side, own):
            parts.append((at, np.full(len(at), tree), cell, np.full(len(at), side), own))

        for size in np.unique(length).tolist():
            at = np.flatnonzero(length == size)
            zero = np.zeros(len(at), dtype=np.int64)
            vectors = letter_counts([words[i] for i in at]) if size in trees or size + 1 in trees else None
            cell = trees[size].cell(vectors) if size in trees else zero
            add(at, size, cell, 0, zero)
            if size in trees:
                row, other = trees[size].reach(vectors, 2)
                later = other >= cell[row]
                row, other = row[later], other[later]
                add(at[row], size, other, 1, (other == cell[row]).astype(np.int64))
            else:
                add(at, size, zero, 1, zero + 1)
            row, other = trees[size + 1].reach(vectors, 1) if size + 1 in trees else (np.arange(len(at)), zero)
            add(at[row], size + 1, other, 1, np.zeros(len(row), dtype=np.int64))
        row, tree, cell, side, own = (np.concatenate(c) for c in zip(*parts))
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (tree, cell, side, own)] + [batch.column(0).take(pa.array(row)), pa.array(counts[row])],
            ["tree", "cell", "side", "own", "word", "n"],
        )

    return map_arrow(words.select("word", "n"), step, "tree long, cell long, side long, own long, word string, n long")


def _search(group: pd.DataFrame) -> pd.DataFrame:
    """Near words among the points and queries of one cell, in both directions."""
    points, queries = (group[group["side"] == side] for side in (0, 1))
    empty = pd.DataFrame({"word": pd.Series(dtype=object), "near": pd.Series(dtype=object), "near_n": pd.Series(dtype="int64")})
    if not len(points) or not len(queries):
        return empty
    p, q = points["word"].to_numpy(), queries["word"].to_numpy()
    size = int(group["tree"].iloc[0])
    same = np.array([len(w) == size for w in q])
    own = queries["own"].to_numpy() == 1
    n_p, n_q = points["n"].to_numpy(), queries["n"].to_numpy()
    at_once = max(1, 4_000_000 // (size + 1))
    out = []
    for i, j in within(letter_counts(p.tolist()), letter_counts(q.tolist()), np.where(same, 2, 1)):
        # A pair of one cell is met from both sides.
        kept = ~own[i] | (q[i] < p[j])
        i, j = i[kept], j[kept]
        for equal in (True, False):
            a, b = i[same[i] == equal], j[same[i] == equal]
            for k in range(0, len(a), at_once):
                x, y = a[k : k + at_once], b[k : k + at_once]
                good = one_edit(q[x].tolist(), p[y].tolist())
                x, y = x[good], y[good]
                out += [(q[x], p[y], n_p[y]), (p[y], q[x], n_q[x])]
    if not out:
        return empty
    word, near, near_n = (np.concatenate(c) for c in zip(*out))
    return pd.DataFrame({"word": word, "near": near, "near_n": near_n})


def near_words(words: DataFrame, cell_words: int = CELL_WORDS, sample: int = SAMPLE) -> DataFrame:
    """word, near and near_n for each ordered pair of ``words`` (word, n; distinct) that are one edit apart, once each.

    Lengths with more than ``cell_words`` words are split by a tree fitted on about ``sample`` of them. A cell that
    still has many words, because their letter counts are alike, is worked in blocks of points and of queries.
    """
    length = F.char_length("word")
    sizes = {r["length"]: r["n"] for r in words.groupBy(length.alias("length")).agg(F.count("*").alias("n")).where(F.col("n") > cell_words).collect()}
    trees: dict[int, UpperTree] = {}
    if sizes:
        share = F.create_map(*[x for size, n in sizes.items() for x in (F.lit(size), F.lit(int(min(1, sample / n) * (1 << 20))))])
        chosen = words.where(F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < share[length]).select("word").toArrow()
        drawn: dict[int, list[str]] = {}
        for w in chosen.column(0).to_pylist():
            drawn.setdefault(len(w), []).append(w)
        trees = {size: UpperTree(letter_counts(drawn[size]), n, cell_words) for size, n in sizes.items() if size in drawn}
    dealt = kept_table(_deal(words, trees), "cells")
    cells = dealt.groupBy("tree", "cell").agg(F.count_if(F.col("side") == 0).alias("points"), F.count_if(F.col("side") == 1).alias("queries"))
    large = cells.where((F.col("points") > 3 * cell_words) | (F.col("queries") > 12 * cell_words)).select(
        "tree", "cell", F.ceil(F.col("points") / cell_words).alias("p_blocks"), F.ceil(F.col("queries") / (4 * cell_words)).alias("q_blocks")
    )
    dealt = join_small(dealt, large, ["tree", "cell"], "left")

    def blocks(name: str, side: int):
        many = F.coalesce(F.greatest(F.col(name), F.lit(1)), F.lit(1))
        mine = F.array(F.pmod(F.xxhash64("word"), many))
        return F.when(F.col("side") == side, mine).otherwise(F.sequence(F.lit(0).cast("long"), many - 1))

    placed = dealt.withColumn("p", blocks("p_blocks", 0)).withColumn("q", blocks("q_blocks", 1))
    placed = placed.withColumn("p", F.explode("p")).withColumn("q", F.explode("q")).drop("p_blocks", "q_blocks")

    def search(group: pd.DataFrame) -> pd.DataFrame:
        return _search(group)

    return placed.groupBy("tree", "cell", "p", "q").applyInPandas(search, "word string, near string, near_n long")


def follow(links: DataFrame) -> DataFrame:
    """word and the last word that its links (word, form) lead to. Links have no circles; each round doubles the steps."""
    state = kept_table(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        joined = state.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved"))
        moved = kept_table(joined, "roots")
        state = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return state


def spelling_variants(docs: DataFrame, fewest: int = FEWEST, times: int = 2, **parameters) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words of ``docs`` (doc_id, text, any other columns).

    The form of a word is its most frequent near word (of ties the first in code-point order) if that is at least
    ``times`` as frequent; the root is where forms lead. Documents without words and empty tables give no rows.
    """
    words = kept_table(word_counts(docs, fewest), "words")
    near = near_words(words, **parameters)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    known = words.join(best, "word", "left")
    form_n = F.when(-F.col("best.less") >= times * F.col("n"), -F.col("best.less"))
    formed = kept_table(
        known.select("word", F.when(form_n.isNotNull(), F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), form_n.alias("form_n")),
        "forms",
    )
    roots = follow(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
