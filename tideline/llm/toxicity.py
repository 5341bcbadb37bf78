"""Toxicity scores of texts restored by noisy-channel decoding.

A character model counted over all documents and a channel of leetspeak, separators and repetition span a
lattice over each chunk that is not a plain word; Viterbi decoding restores it. Restored words and their beginnings feed a
logistic model learned from labelled documents.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.chunks import Cache, chunks, text_slices
from tideline.llm.frames import id_and_text, kept_table, map_arrow, whole_text

# What a sign may stand for, and the signs that may be thrown in between letters.
LEET = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c",
}
_LETTER = r"[^\W\d_]"
_WORD = re.compile(rf"{_LETTER}+")
_SIGNS = re.escape("".join(c for c in LEET if not c.isdigit()))
_REPEATED = re.compile(rf"({_LETTER})\1")
_SPACED = re.compile(rf"(?<!\S)(?:[^\W_]|[{_SIGNS}])(?:\s+(?:[^\W_]|[{_SIGNS}])){{2,}}(?!\S)")
_GAP = re.compile(r"\s+")
_SEPARATORS = re.compile(rf"[^\w{_SIGNS}]+|_+")
_HEAD, _TAIL = re.compile(r"^[\W_]+"), re.compile(r"[\W_]+$")

#: Classes of the character model: 0 for everything between words, a-z, and the letters of Latin-1.
_CLASS = np.zeros(0x110000, dtype=np.uint8)
_CLASS[ord("a") : ord("z") + 1] = _CLASS[ord("A") : ord("Z") + 1] = np.arange(1, 27)
_CLASS[0xE0:0x100] = _CLASS[0xC0:0xE0] = np.arange(27, 59)
_CLASSES = 64


def count_trigrams(docs: DataFrame) -> np.ndarray:
    """How often each three character classes follow one another in all of ``docs``: a table of fixed size."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        total = np.zeros(_CLASSES**3, dtype=np.int64)
        for _, part in text_slices(batch.column(1).to_pylist()):
            c = _CLASS[np.frombuffer("  ".join(part).encode("utf-32-le", "replace"), dtype=np.uint32)].astype(np.int64)
            total += np.bincount((c[:-2] * _CLASSES + c[1:-1]) * _CLASSES + c[2:], minlength=_CLASSES**3) if len(c) > 2 else 0
        seen = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["trigram", "n"])

    rows = map_arrow(id_and_text(docs), step, "trigram long, n long").groupBy("trigram").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(_CLASSES**3)
    table[np.asarray(rows["trigram"])] = np.asarray(rows["n"])
    return table.reshape(_CLASSES, _CLASSES, _CLASSES)


_NOTHING: list = []


@dataclass
class Restorer:
    """Viterbi decoding under the character model."""

    trigrams: np.ndarray
    leet_cost: float = 1.0
    drop_cost: float = 1.5
    double_cost: float = 1.5
    repeat_cost: float = 0.3
    cost: np.ndarray = field(init=False)

    def __post_init__(self):
        pair = self.trigrams.sum(axis=2, keepdims=True)
        single = self.trigrams.sum(axis=(0, 1)) + 1.0
        backed = 4.0 * single / single.sum()
        self.cost = -np.log((self.trigrams + backed) / (pair + 4.0)).astype(np.float32)

    def decode(self, token: str, keep: bool = False) -> str:
        """The cheapest reading of a lower-cased token: each place emits a letter, a letter it stands for, or nothing.

        With ``keep`` every sign that may stand for a letter does.
        """
        # state: last two classes -> (cost, last letter, back pointer)
        paths: dict[tuple[int, int], tuple[float, str, tuple | None]] = {(0, 0): (0.0, "", None)}
        before, run = "", 0
        for c in token:
            run = run + 1 if c == before else 1
            before = c
            letters = [(c, 0.0)] if c.isalpha() else [(x, self.leet_cost) for x in LEET.get(c, "")]
            if not c.isalpha():
                skip = 0.2 if c not in LEET else None if keep else self.drop_cost
            else:
                skip = None if run == 1 else self.double_cost if run == 2 else self.repeat_cost
            new: dict[tuple[int, int], tuple[float, str, tuple | None]] = {}
            for (a, b), entry in paths.items():
                base = entry[0]
                if skip is not None:
                    held = new.get((a, b))
                    if held is None or base + skip < held[0]:
                        new[(a, b)] = (base + skip, entry[1], entry[2]) if entry[2] else (base + skip, "", None)
                for letter, price in letters:
                    k = int(_CLASS[ord(letter)])
                    total = base + price + float(self.cost[a, b, k])
                    held = new.get((b, k))
                    if held is None or total < held[0]:
                        new[(b, k)] = (total, letter, entry)
            paths = new
        best = min(((e[0] + float(self.cost[a, b, 0]), e) for (a, b), e in paths.items()), key=lambda x: x[0])[1]
        out = []
        while best is not None and best[2] is not None:
            out.append(best[1])
            best = best[2]
        return "".join(reversed(out))

    def readings(self, written: str) -> list[str]:
        """The cheapest reading, and the one without signs thrown in: short words are cheaper to drop than to restore."""
        keep = any(map(LEET.__contains__, written))
        return list(dict.fromkeys(filter(None, [self.decode(written), self.decode(written, True) if keep else ""])))

    def words(self, chunk: str) -> list[str]:
        """Words of a chunk as written, and its decoded readings: signs at the ends may be letters or punctuation."""
        low = chunk.lower()
        if low.isalpha() and not _REPEATED.search(low):
            return [low]
        found = _WORD.findall(low)
        inner = _SEPARATORS.sub("", low)
        for written in dict.fromkeys([inner, _HEAD.sub("", inner), _TAIL.sub("", inner), _HEAD.sub("", _TAIL.sub("", inner))]):
            if len(written) > 1 and (written not in found or _REPEATED.search(written)):
                found += [x for x in self.readings(written) if x not in found]
        return found

    def spaced(self, text: str) -> list[str]:
        """Words written letter by letter: whole runs, and their parts between signs and between wider gaps."""
        found = []
        for m in _SPACED.finditer(text):
            letters, gaps = _GAP.split(m.group().lower()), _GAP.findall(m.group())
            widths = [("\n" in g, g.strip(" ") != "", len(g)) for g in gaps]
            places = {}
            for start, stop in [(0, len(letters)), *(x.span() for x in _WORD.finditer("".join(x[0] for x in letters)))]:
                for widest in set(widths[start : stop - 1]):
                    at = start
                    for k in range(start + 1, stop + 1):
                        if k == stop or widths[k - 1] > widest:
                            if k - at > 2:
                                places[at, k] = 0
                            at = k
            found += [x for at, k in sorted(places) for x in self.readings("".join(letters[at:k]))]
        return found


def features_of(word: str) -> list[str]:
    return ["=" + word, *["^" + word[:k] for k in (4, 5, 6, 7) if len(word) > k]]


@functools.lru_cache(maxsize=1)
def _restorer(raw: bytes) -> tuple[Restorer, Cache]:
    shape = (_CLASSES, _CLASSES, _CLASSES)
    Cache.drop("toxicity")  # of the restorer before
    return Restorer(np.frombuffer(raw, dtype=np.float32).reshape(shape)), Cache("toxicity", 0)


def counted_features(texts: list[str], trigrams: bytes, index: dict[str, int] | None):
    """Counter of features of each text: of all, or of those in ``index`` by their number."""
    restorer, cache = _restorer(trigrams)
    space = None if index is None else tuple(index.items())  # models of one size differ in their features

    def looked_up(words: list[str]) -> list:
        every = [f for w in words for f in features_of(w)]
        found = every if index is None else [index[f] for f in every if f in index]
        return found or _NOTHING

    if getattr(cache, "space", ()) != space:  # the cached features are those of one index
        cache.clear()
        cache.older, cache.space = {}, space
        cache.bound = 40_000 if index is None else 200_000  # lists of names are long, those of numbers mostly empty
    for _, part in text_slices(texts):
        cut = [chunks(t) for t in part]
        for c in cache.missing(cut):
            cache[c] = looked_up(restorer.words(c))
        for text, row in zip(part, cut):
            found = Counter([f for hit in map(cache.__getitem__, row) if hit for f in hit])
            found.update(looked_up(restorer.spaced(text)))
            yield found


@dataclass(frozen=True)
class Model:
    index: dict[str, int]
    weights: np.ndarray
    bias: float
    trigrams: bytes

    def score(self, found: Counter) -> float:
        total = self.bias + sum(self.weights[k] * math.log2(1 + n) for k, n in found.items())
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, total))))


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from."""
    return F.crc32(doc_id.cast("string")) % 5 == 0


def _fit(rows: list[list[tuple[int, int]]], labels: np.ndarray, size: int, ridge: float = 0.02, steps: int = 15) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps over the bounded sample."""
    x = np.zeros((len(rows), size + 1), dtype=np.float32)
    x[:, size] = 1.0
    for r, row in enumerate(rows):
        for k, n in row:
            x[r, k] = math.log2(1 + n)
    scale = np.append(np.maximum(x[:, :size].std(axis=0), 0.05), 1.0)
    x /= scale
    penalty = np.append(np.full(size, ridge), 1e-6)
    w = np.zeros(size + 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32), -30, 30)))
        slope = x.T @ (labels - p) - penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        w += np.linalg.solve(curve.astype(float), slope)
    w /= scale
    return w[:size], float(w[size])


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = 10_000, most_features: int = 1000, least_toxic: int = 4) -> Model:
    """A model from labelled rows that are not held out; ``sample_rows`` bounds them (by a hash of the id, about that many ids, one text of each).

    The character model is counted over all of ``docs``. ``most_features`` bounds the features: those with the
    strongest excess among toxic documents. Without labelled toxic rows every score is the base rate.
    """
    trigrams = count_trigrams(docs).astype(np.float32).tobytes()
    wanted = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    wanted = wanted.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, sample_rows / max(1, wanted.count()))
    wanted = wanted.where(F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1_000_000)) < int(share * 1_000_000))
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).join(wanted, "doc_id")
    # One text of an id, so that repeated rows do not outgrow the bound.
    sample = sample.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic")
    sample = kept_table(sample.repartition(12), "sample")

    def partial(batch: pa.RecordBatch) -> pa.RecordBatch:
        total: Counter = Counter()
        for found in counted_features(batch.column(1).to_pylist(), trigrams, None):
            total.update(found.keys())
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["feature", "n"])

    def documents_with(rows: DataFrame) -> DataFrame:
        return map_arrow(rows.select("doc_id", "text"), partial, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))

    # Features seen in too few toxic rows are dropped before the others are counted.
    toxic = kept_table(documents_with(sample.where("toxic = 1")).where(F.col("n") >= least_toxic), "features")
    clean = documents_with(sample.where("toxic = 0")).withColumnRenamed("n", "others")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return Model({}, np.zeros(0), math.log((n1 + 1) / (n0 + 1)), trigrams)
    both = toxic.join(clean, "feature", "left").fillna(0, ["others"])
    expected = F.lit(n1 / (n1 + n0)) * (F.col("n") + F.col("others"))
    excess = both.withColumn("z", (F.col("n") - expected) / F.sqrt(expected)).where("z >= 3")
    names = [r["feature"] for r in excess.orderBy(F.desc("z"), "feature").limit(most_features).collect()]
    index = {f: k for k, f in enumerate(names)}

    def sparse(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [sorted(c.items()) for c in counted_features(batch.column(1).to_pylist(), trigrams, index)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array([[k for k, _ in c] for c in found], pa.list_(pa.int32())), pa.array([[n for _, n in c] for c in found], pa.list_(pa.int32()))],
            ["doc_id", "toxic", "features", "counts"],
        )

    rows = map_arrow(sample, sparse, "doc_id long, toxic int, features array<int>, counts array<int>").orderBy("doc_id").toArrow()
    pairs = [list(zip(k, n)) for k, n in zip(rows["features"].to_pylist(), rows["counts"].to_pylist())]
    weights, bias = _fit(pairs, np.asarray(rows["toxic"]).astype(np.float32), len(index))
    return Model(index, weights, bias, trigrams)


def toxicity_scores(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of ``docs`` (doc_id, text, any other columns).

    ``labels`` (doc_id, toxic) may lack rows, hold nulls or repeat ids. A null or empty text gets the score of
    a text without features; repeated rows and ids give a row each; an empty table none.
    """
    model = learn(docs, labels, **parameters)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by most_features and the character classes

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        scores = [model.score(c) for c in counted_features(batch.column(1).to_pylist(), model.trigrams, model.index)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = map_arrow(id_and_text(docs), step, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """``docs`` without the rows that the model rejects; all columns stay as they are.

    A null or empty text has the score of a text without features, which is that of the base rate; repeated rows stay
    or go together; without labels of both kinds nothing goes but by the base rate; an empty table stays empty.
    """
    model = learn(docs, labels, **parameters)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        texts = [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
        keep = [model.score(c) < 0.5 for c in counted_features(texts, model.trigrams, model.index)]
        return batch.filter(pa.array(keep, pa.bool_()))

    return map_arrow(docs, step, docs.schema)
