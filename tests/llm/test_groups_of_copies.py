"""Large groups of near copies, whose members meet by their differences from a leader, and models in one worker."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import brute_classes, same_rows
from tideline.llm import probminhash, toxicity


def edited(words, share, rng, tag):
    out = list(words)
    for i in rng.sample(range(len(words)), max(1, int(share * len(words)))):
        out[i] = f"{tag}{i}"
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_far_copies_meet_by_their_differences(spark, seed):
    """Copies of one base from close to just too far, and families that share far edits but lie apart from the base."""
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(150)]
    texts = [" ".join(edited(base, 0.001 * k, rng, f"c{k}_")) for k in range(0, 40)]
    for family in range(4):
        far = edited(base, 0.04 + 0.01 * family, rng, f"f{family}_")
        texts += [" ".join(edited(far, 0.008, rng, f"m{family}_{k}_")) for k in range(6)]
    # Lines that repeat give shingles more than one weight.
    texts += [" ".join(base[:40] * 3 + edited(base, 0.01 * k, rng, f"r{k}_")) for k in range(8)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = [tuple(r) for r in probminhash.near_duplicate_classes(docs).collect()]
    want = brute_classes(docs)
    same_rows(got, want)
    assert len({c for _, c in want}) > 4


def test_pairs_of_far_copies_share_a_difference():
    """The bound by excesses and common differences never rules out a similar pair."""
    rng = np.random.default_rng(4)
    for _ in range(2000):
        n = int(rng.integers(10, 60))
        lead, x, y = (np.unique(rng.integers(0, 40, n)) for _ in range(3))
        wx, wy = (rng.integers(1, 3, len(v)) for v in (x, y))
        similar = probminhash.probability_jaccard((x, wx), (y, wy))
        for threshold in (0.3, 0.5, 0.8):
            far = (1 - threshold) / (1 + threshold)
            dx, dy = np.setxor1d(x, lead), np.setxor1d(y, lead)
            excess = sum(len(d) - far * (2 * w.sum() - len(w)) for d, w in ((dx, wx), (dy, wy)))
            assert similar < threshold or excess <= 2 * len(np.intersect1d(dx, dy)) + 1e-9


def test_far_copies_make_few_pairs(spark):
    """A star of copies with edits of their own: those too far from the leader do not meet the whole group."""
    rng = random.Random(8)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(200)]
    texts = [edited(base, 0.005, rng, f"n{k}_") for k in range(120)] + [edited(base, 0.025, rng, f"o{k}_") for k in range(60)]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    coded = []
    elements = {}
    for k, text in [(-1, " ".join(base)), *rows]:
        _, element, weight, _ = probminhash.shingles([text])
        elements[k] = set(element.tolist()), float(2 * weight.sum() - len(weight))
    far = 0.2 / 1.8
    for k, _ in rows:
        apart = elements[k][0] ^ elements[-1][0]
        similar = len(elements[k][0] & elements[-1][0]) / len(elements[k][0] | elements[-1][0]) >= 0.8
        coded.append((k, -1, 0 if similar else k + 1000, not similar, len(apart) - far * elements[k][1], len(apart), [e - (1 << 63) if e >= 1 << 63 else e for e in apart]))
    assert 20 < sum(c[3] for c in coded) < 120
    frame = spark.createDataFrame(coded, "node long, lead long, part long, open boolean, excess double, size long, shingles array<long>")
    pairs = probminhash.sharing_a_difference(frame).count()
    opened = sum(c[3] for c in coded)
    assert pairs < 0.2 * opened * len(coded)


def test_differences_from_a_weighed_centre_rule_out_no_similar_pair():
    """The bounds by what the centre holds and what each text has over it, whatever the centre's shingles and weights."""
    rng = np.random.default_rng(5)
    similar_ones = 0
    for _ in range(4000):
        base = np.unique(rng.integers(0, 40, int(rng.integers(10, 60))))
        weights = rng.choice([1, 1, 2, 30], 40)

        def near():
            e = np.setxor1d(base, rng.integers(0, 40, int(rng.integers(0, 6))))
            return e, np.maximum(weights[e] + rng.integers(-1, 2, len(e)), 1)

        (x, wx), (y, wy) = near(), near()
        if not len(x) or not len(y):
            continue
        centre, held = near()[0], rng.integers(0, 3, 40) * weights
        similar = probminhash.probability_jaccard((x, wx), (y, wy))
        dx, dy = np.setxor1d(x, centre), np.setxor1d(y, centre)
        shared = len(np.intersect1d(dx, dy))
        for threshold in (0.5, 0.8):
            similar_ones += similar >= threshold
            room = (1 - threshold) * (held.sum() + sum(np.maximum(w - held[e], 0).sum() for e, w in ((x, wx), (y, wy))))
            mass = sum(len(d) + (w[np.isin(e, d)] - 1).sum() for d, e, w in ((dx, x, wx), (dy, y, wy)))
            assert similar < threshold or len(dx) + len(dy) - room <= 2 * shared + 1e-9
            assert similar < threshold or shared or mass - room <= 1e-9
    assert similar_ones > 500


def test_a_passage_that_many_texts_repeat_makes_few_pairs(spark, monkeypatch):
    """Texts that are mostly one repeated passage, each with a body of its own, are not compared pair by pair."""
    compared = []
    real = probminhash.verified

    def counted(pairs, texts, threshold):
        compared.append(pairs.count())
        return real(pairs, texts, threshold)

    monkeypatch.setattr(probminhash, "verified", counted)
    rng = random.Random(6)
    # Parts of a body are found in other bodies too, so no text is ruled out for what it holds alone.
    blocks = [" ".join(f"b{k}_{i}" for i in range(20)) for k in range(50)]
    bodies = [rng.sample(blocks, 1) for _ in range(8)] + [rng.sample(blocks, 3) for _ in range(40)]
    texts = [" ".join(["is onhe"] * 150 + body) for body in bodies]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [tuple(r) for r in probminhash.near_duplicate_classes(docs).collect()]
    same_rows(got, brute_classes(docs))
    assert 1 < len({c for _, c in got}) < len(texts)
    # The first comparison is of bucket members with their leaders.
    assert sum(compared[1:]) <= 4 * len(texts)


def test_models_of_one_size_keep_their_own_features(spark):
    text = ["alpha beta", "gamma beta"]
    trigrams = np.zeros((toxicity._CLASSES,) * 3, dtype=np.float32).tobytes()
    first = [dict(c) for c in toxicity.counted_features(text, trigrams, {"=alpha": 0})]
    second = [dict(c) for c in toxicity.counted_features(text, trigrams, {"=gamma": 0})]
    assert first == [{0: 1}, {}] and second == [{}, {0: 1}]


def test_repeated_rows_do_not_outgrow_the_sample(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("words "), F.col("id")).alias("text"))
    docs = docs.unionAll(docs.where("doc_id = 7").crossJoin(spark.range(500)).select("doc_id", "text"))
    labels = spark.range(40).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    scored = toxicity.toxicity_scores(docs, labels)
    assert scored.count() == 540 and scored.where("score is null").count() == 0
