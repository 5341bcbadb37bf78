"""Near-duplicate classes by ProbMinHash over weighted five-word shingles.

A shingle weighs as often as it occurs. Every shingle is a Poisson process whose rate is its weight; each
arrival falls into one of the signature's components, which keeps the shingle that arrived first. Two
signatures agree in a component with the probability Jaccard similarity of the texts. A process stops once
its next arrival is later than every component's first one. Bands of the signature propose pairs, and the
exact similarity of the two texts decides.

No group is compared pair by pair: texts with the same words are one node; a node whose own shingles (found
in no other candidate) weigh too much cannot reach the threshold with anyone and is left out; the members of
a bucket are compared with one leader; and members that are still in different classes are coded by their
difference from that leader and compared with the one that differs least. What is left meets only if two differences
are small enough together, or share a shingle among their rarest ones.
"""

from __future__ import annotations

import functools
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.chunks import Cache, text_slices
from tideline.llm.frames import id_and_text, kept_table, map_arrow

WORDS = 5
THRESHOLD = 0.8
BANDS, BAND_ROWS = 28, 7

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15 * (2 * i + 1) % (1 << 64) | 1 for i in range(16)], dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A finalizer over 64 bits: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@functools.cache
def _word_hashes() -> Cache:
    return Cache("minhash", 250_000)


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes | None]]:
    """Row, 48-bit shingle and its count, sorted by both, and a fingerprint of each text's words.

    Words are lower-cased runs without white space. A text of fewer than five words is one shingle; one
    without words has no shingle and no fingerprint.
    """
    cut = [t.lower().split() for t in texts]
    cache = _word_hashes()
    for w in cache.missing(cut):
        cache[w] = xxhash.xxh3_64_intdigest(w)
    sizes = np.array([len(row) for row in cut], dtype=np.int64)
    flat = np.fromiter((cache[w] for row in cut for w in row), dtype=np.uint64, count=int(sizes.sum()))
    prints = [xxhash.xxh3_128_digest(" ".join(row)) if row else None for row in cut]
    row = np.repeat(np.arange(len(cut)), sizes)
    begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.arange(len(flat))
    total = np.zeros(len(flat), dtype=np.uint64)
    for k in range(WORDS):
        here = at + k
        inside = here < begin + sizes[row]
        total[inside] += flat[here[inside]] * _MULTIPLIERS[k]
    first = (at - begin <= sizes[row] - WORDS) | (at == begin)
    key = (row[first].astype(np.uint64) << np.uint64(48)) | (_mix(total[first]) >> np.uint64(16))
    key.sort()
    new = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, dtype=bool)
    starts = np.flatnonzero(new)
    weight = np.diff(np.r_[starts, len(key)])
    key = key[starts]
    return (key >> np.uint64(48)).astype(np.int64), key & np.uint64((1 << 48) - 1), weight, prints


def signatures(row: np.ndarray, element: np.ndarray, weight: np.ndarray, rows: int, size: int) -> np.ndarray:
    """rows x size: the element that arrives first in each component (0 in rows without elements)."""
    best = np.full(rows * size, np.inf)
    who = np.zeros(rows * size, dtype=np.uint64)
    time = np.zeros(len(row))
    step, at_once = 0, 1
    while len(row):
        n = np.arange(step + 1, step + at_once + 1, dtype=np.uint64)
        drawn = _mix(element[:, None] + n[None, :] * np.uint64(0x9E3779B97F4A7C15))
        gap = -np.log(((drawn >> np.uint64(24)).astype(np.float64) + 0.5) / 2.0**40) / weight[:, None]
        arrival = time[:, None] + np.cumsum(gap, axis=1)
        slot = row[:, None] * size + (drawn & np.uint64(0xFFFFFF)).astype(np.int64) % size
        earlier = arrival < best[slot]
        t, s = arrival[earlier], slot[earlier]
        e = np.broadcast_to(element[:, None], arrival.shape)[earlier]
        np.minimum.at(best, s, t)
        won = t == best[s]
        who[s[won]] = e[won]
        time = arrival[:, -1]
        step += at_once
        alive = time < best.reshape(rows, size).max(axis=1)[row]
        row, element, weight, time = row[alive], element[alive], weight[alive], time[alive]
        # Few processes are left when many arrivals each are needed, so they are drawn in larger steps.
        at_once = int(min(max(1, 200_000 // max(len(row), 1)), 2 * at_once))
    return who.reshape(rows, size)


def band_keys(signature: np.ndarray, bands: int, band_rows: int) -> np.ndarray:
    parts = signature.reshape(len(signature), bands, band_rows)
    return _mix((_mix(parts) * _MULTIPLIERS[:band_rows]).sum(axis=2, dtype=np.uint64)).astype(np.int64)


def probability_jaccard(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard of two (sorted elements, weights)."""
    (xe, xw), (ye, yw) = x, y
    _, i, j = np.intersect1d(xe, ye, assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    a, b = xw[i].astype(float), yw[j].astype(float)
    only_x, only_y = float(xw.sum()) - a.sum(), float(yw.sum()) - b.sum()
    total = 0.0
    for ratio in np.unique(a / b):
        mine = a / b == ratio
        total += a[mine].sum() / (only_x + ratio * only_y + np.maximum(a, ratio * b).sum())
    return float(total)


def sketch(docs: DataFrame, bands: int = BANDS, band_rows: int = BAND_ROWS) -> DataFrame:
    """doc_id, fingerprint of the words and band keys of each row; both null for a text without words."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints, keys = [], []
        for _, part in text_slices(batch.column(1).to_pylist()):
            row, element, weight, own = shingles(part)
            who = signatures(row, element, weight, len(part), bands * band_rows)
            prints += own
            keys += [k if p else None for k, p in zip(band_keys(who, bands, band_rows), own)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(prints, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "print", "bands"]
        )

    return map_arrow(id_and_text(docs), step, "doc_id long, print binary, bands array<long>")


def _weighed_shingles(texts: DataFrame) -> DataFrame:
    """node, shingle and its weight, with the weight and the number of all shingles of the text.

    One more row of each text, under a negative number of its own, carries these two alone.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple[np.ndarray, ...]] = []
        nodes = np.asarray(batch.column(0))
        for start, part in text_slices(batch.column(1).to_pylist()):
            row, element, weight, _ = shingles(part)
            total = np.bincount(row, weights=weight, minlength=len(part))
            count = np.bincount(row, minlength=len(part))
            own = nodes[start : start + len(part)]
            out.append((own[row], element.astype(np.int64), weight.astype(float), total[row], count[row]))
            out.append((own, -1 - own, np.zeros(len(part)), total, count))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c)) for c in zip(*out)], ["node", "shingle", "weight", "total", "kinds"]
        )

    return map_arrow(texts.select("node", "text"), step, "node long, shingle long, weight double, total double, kinds long")


def _shares(texts: DataFrame) -> DataFrame:
    """node; own: weight of the shingles that no other text holds; total: weight of all; extra: of repetitions."""
    return (
        _weighed_shingles(texts)
        .groupBy("shingle")
        .agg(F.count("*").alias("n"), *[F.max(c).alias(c) for c in ("node", "weight", "total", "kinds")])
        .where("n = 1 or shingle < 0")
        .groupBy("node")
        .agg(*[F.max(c).alias(c) for c in ("n", "total", "kinds")], F.sum("weight").alias("own"))
        # An id with several texts is bounded by none of them.
        .select(
            "node",
            F.when(F.col("n") == 1, F.col("own")).otherwise(0.0).alias("own"),
            F.when(F.col("n") == 1, F.col("total")).otherwise(1e12).alias("total"),
            F.when(F.col("n") == 1, F.col("total") - F.col("kinds")).otherwise(1e12).alias("extra"),
        )
    )


def _shares_within(a: Column, b: Column, threshold: float) -> Column:
    """Whether texts with these shares of shingles of their own can be that similar.

    A collision needs a common shingle: with x and y scaled to 1 the similarity is at most (1-a)(1-b)/(1-ab).
    """
    return (1 - a) * (1 - b) >= F.lit(threshold - 1e-9) * (1 - a * b)


def _within_bound(x: str, y: str, threshold: float) -> Column:
    """Whether two nodes can be that similar, by shares and by absolute weights.

    No term of the similarity exceeds max(x, y) / sum of max(x, y), so with m at least the sum of max(x, y)
    over common shingles, it is at most m / (m + what x holds alone + what y holds alone).
    """
    own_a, total_a, extra_a = (F.col(f"{x}.{c}") for c in ("own", "total", "extra"))
    own_b, total_b, extra_b = (F.col(f"{y}.{c}") for c in ("own", "total", "extra"))
    held = _weights_within((own_a, total_a, total_a - own_a, extra_a), (own_b, total_b, total_b - own_b, extra_b), threshold)
    return held & _shares_within(own_a / total_a, own_b / total_b, threshold)


def _weights_within(a: tuple[Column, ...], b: tuple[Column, ...], threshold: float) -> Column:
    """The bound by weights. Each side: own, total, what it can share, extra.

    It grows with the last two and falls with the first two, so for two sets of nodes the least own and total
    and the most of the others bound every pair.
    """
    common = F.least(a[2] + b[3], b[2] + a[3])
    alone = F.greatest(a[0], a[1] - common) + F.greatest(b[0], b[1] - common)
    return common >= F.lit(threshold - 1e-9) * (common + alone)


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [np.asarray(batch.column(k)) for k in (0, 1)]
        held: dict[str, tuple] = {}
        rows = [batch.column(k).to_pylist() for k in (2, 3)]
        good = np.zeros(batch.num_rows, dtype=bool)
        for i, (x, y) in enumerate(zip(*rows)):
            fresh = [t for t in dict.fromkeys((x, y)) if t not in held]
            if len(held) > 200:
                held.clear()
                fresh = list(dict.fromkeys((x, y)))
            if fresh:
                row, element, weight, _ = shingles(fresh)
                for k, t in enumerate(fresh):
                    held[t] = (element[row == k], weight[row == k])
            good[i] = probability_jaccard(held[x], held[y]) >= threshold
        return pa.RecordBatch.from_arrays([pa.array(c[good]) for c in ids], ["a", "b"])

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return map_arrow(both, step, "a long, b long")


def differences(refs: DataFrame, texts: DataFrame) -> DataFrame:
    """How the texts of each (node, lead) differ.

    weight (of the node's shingles, repetitions twice), held (weight of the lead's), over (how much the node's shingles
    weigh more than the lead's), the shingles that only one of the two holds and their weight in the node (mine) and in
    the lead (theirs), 0 where it does not hold them.
    """
    own = texts.select("node", F.col("text").alias("text_node"))
    led = texts.select(F.col("node").alias("lead"), F.col("text").alias("text_lead"))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        known: dict[str, tuple] = {}
        out: list[tuple] = []
        for pair in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if len(known) > 200:
                known.clear()
            fresh = [t for t in dict.fromkeys(pair) if t not in known]
            if fresh:
                row, element, weight, _ = shingles(fresh)
                known.update((t, (element[row == k], weight[row == k])) for k, t in enumerate(fresh))
            (xe, xw), (ye, yw) = known[pair[0]], known[pair[1]]
            _, i, j = np.intersect1d(xe, ye, assume_unique=True, return_indices=True)
            only_x, only_y = np.ones(len(xe), dtype=bool), np.ones(len(ye), dtype=bool)
            only_x[i], only_y[j] = False, False
            mine = np.r_[xw[only_x], np.zeros(int(only_y.sum()))].astype(float)
            theirs = np.r_[np.zeros(int(only_x.sum())), yw[only_y]].astype(float)
            over = float(xw[only_x].sum() + np.maximum(xw[i] - yw[j], 0).sum())
            out.append((float(2 * xw.sum() - len(xw)), float(yw.sum()), over, np.r_[xe[only_x], ye[only_y]].astype(np.int64), mine, theirs))
        kinds = [pa.float64()] * 3 + [pa.list_(pa.int64())] + [pa.list_(pa.float64())] * 2
        columns = list(zip(*out)) or [()] * 6
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
            ["node", "lead", "weight", "held", "over", "shingles", "mine", "theirs"],
        )

    both = refs.join(own, "node").join(led, "lead").select("node", "lead", "text_node", "text_lead")
    kind = "node long, lead long, weight double, held double, over double, shingles array<long>, mine array<double>, theirs array<double>"
    return map_arrow(both, step, kind)


def _often_apart(coded: DataFrame) -> DataFrame:
    """lead and the shingles in which more than half of some batch's members of it differ from it, with how many do, mine and theirs.

    What more than half of all members have, more than half of one batch's have. Rows are dealt by ranges, so a
    leader's members lie together, and those of a large group in several tasks.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        lead = np.asarray(batch.column(0), dtype=np.int64)
        apart, mine, theirs = (batch.column(k).to_pylist() for k in (1, 2, 3))
        out: list[tuple[np.ndarray, ...]] = []
        order = np.argsort(lead, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(lead[order])) + 1) if len(lead) else []:
            flat, w, c = (np.concatenate([np.array(of[r], dtype=kind) for r in rows]) for of, kind in ((apart, np.int64), (mine, float), (theirs, float)))
            shingle, place, often = np.unique(flat, return_inverse=True, return_counts=True)
            least, most = np.full(len(shingle), np.inf), np.zeros(len(shingle))
            np.minimum.at(least, place, w)
            np.maximum.at(most, place, c)
            many = 2 * often > len(rows)
            out.append((np.full(int(many.sum()), lead[rows[0]]), shingle[many], often[many], least[many], most[many]))
        columns = zip(*out) if out else [()] * 5
        kinds = [pa.int64()] * 3 + [pa.float64()] * 2
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c) if c else [], k) for c, k in zip(columns, kinds)], ["lead", "shingle", "often", "mine", "theirs"]
        )

    rows = coded.repartitionByRange("lead", "node").select("lead", "shingles", "mine", "theirs")
    return map_arrow(rows, step, "lead long, shingle long, often long, mine double, theirs double")


def centered(coded: DataFrame) -> DataFrame:
    """node, lead, weight, held, over, size, mass and shingles of ``differences`` from the centre of a leader's members.

    Shingles in which more than half of the members differ from the leader are the leader's own fault; the centre
    has them the members' way, with the least weight counted for them. It need not be a text for the bounds to hold, nor
    the very majority. ``size`` counts the shingles, ``mass`` is the least that they weigh in a text that holds them.
    """
    members = coded.groupBy("lead").agg(F.count("*").alias("members"))
    odd = _often_apart(coded).groupBy("lead", "shingle").agg(F.sum("often").alias("often"), F.min("mine").alias("mine"), F.max("theirs").alias("theirs"))
    gain = F.when(F.col("theirs") > 0, -F.col("theirs")).otherwise(F.col("mine"))
    flips = odd.join(members, "lead").where("2 * often > members").groupBy("lead").agg(F.collect_list(F.struct("shingle", gain.alias("gain"))).alias("flips"))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        held, over, apart, mine, flipped, gains = (batch.column(k).to_pylist() for k in range(3, 9))
        for h, o, x, w, f, g in zip(held, over, apart, mine, flipped, gains):
            x, w, f, g = np.array(x, dtype=np.int64), np.array(w), np.array(f or [], dtype=np.int64), np.array(g or [], dtype=float)
            differs, stays = np.isin(f, x), ~np.isin(x, f)
            # What the centre takes from the leader is all over it now; what it holds instead is not, as far as the text has it.
            o -= float(g[(g < 0) & ~differs].sum())
            weights = dict(zip(x[~stays].tolist(), w[~stays].tolist()))
            o -= sum(min(weights[i], y) for i, y in zip(f[(g > 0) & differs].tolist(), g[(g > 0) & differs].tolist()))
            own = np.r_[x[stays], f[~differs]]
            out.append((h + float(g.sum()), o, len(own), len(own) + float(np.maximum(w[stays] - 1, 0).sum()), own))
        kinds = [pa.float64(), pa.float64(), pa.int64(), pa.float64(), pa.list_(pa.int64())]
        columns = list(zip(*out)) or [()] * 5
        return pa.RecordBatch.from_arrays(
            [batch.column(k) for k in range(3)] + [pa.array(c, k) for c, k in zip(columns, kinds)],
            ["node", "lead", "weight", "held", "over", "size", "mass", "shingles"],
        )

    joined = coded.join(flips, "lead", "left").select(
        "node", "lead", "weight", "held", "over", "shingles", "mine", F.col("flips.shingle").alias("flipped"), F.col("flips.gain").alias("gains")
    )
    return map_arrow(joined, step, "node long, lead long, weight double, held double, over double, size long, mass double, shingles array<long>")


def meeting_the_nearest(coded: DataFrame) -> DataFrame:
    """Pairs (a, b) of a node and that of its leader whose difference is the least, if the two may be similar without a common one.

    ``coded``: node, lead, part, apart. What two nodes may differ by is a sum over both, so whoever may be similar to any node
    may be to this one: a group of near nodes is linked through it, and not pair by pair.
    """
    nearest = coded.where("apart > -1e11").groupBy("lead").agg(F.min(F.struct("apart", "node", "part")).alias("nearest"))
    met = coded.join(nearest, "lead").where((F.col("part") != F.col("nearest.part")) & (F.col("apart") + F.col("nearest.apart") <= 1e-6))
    return met.select(F.least("node", "nearest.node").alias("a"), F.greatest("node", "nearest.node").alias("b")).distinct()


def sharing_a_difference(coded: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes of different parts that can be similar for what they share of their differences from one centre.

    ``coded``: node, lead, part, open (not of the part that most are in), excess, surplus (if known), size and shingles
    of the difference. The texts x and y differ by |dx| + |dy| - 2 |dx & dy| shingles, so they need 2 |dx & dy| >= excess of x +
    excess of y, and so for the surplus, and of two texts at least one is open. They can share only what another difference
    has too. Shingles are taken rarest first; two sets that share k of theirs share one of the first |set| - k + 1 of each.
    """
    bounds = [c for c in ("excess", "surplus") if c in coded.columns]
    least = coded.groupBy("lead").agg(
        *[F.min(c).alias(f"any_{c}") for c in bounds], *[F.min(F.when(F.col("open"), F.col(c))).alias(f"open_{c}") for c in bounds]
    )
    each = coded.select("lead", "node", "part", "open", *bounds, "size", F.explode("shingles").alias("shingle"))
    often = each.groupBy("lead", "shingle").agg(F.count("*").alias("often")).where("often > 1")
    own = Window.partitionBy("lead", "node")
    # A shingle of one text alone meets nobody, but takes its place among the first.
    ranked = each.join(often, ["lead", "shingle"], "left").select(
        "*", F.count("often").over(own).alias("common"), F.row_number().over(own.orderBy(F.coalesce("often", F.lit(1)), "shingle")).alias("rank")
    )
    # What the easiest partner asks for: any text for an open one, an open one for the others.
    asked = F.greatest(
        *[F.ceil((F.col(c) + F.when(F.col("open"), F.col(f"any_{c}")).otherwise(F.col(f"open_{c}"))) / 2 - F.lit(1e-6)) for c in bounds], F.lit(1)
    )
    first = ranked.join(least, "lead").where(
        F.col("often").isNotNull() & (asked <= F.col("common")) & (F.col("rank") <= F.col("size") - asked + 1)
    ).select("lead", "shingle", "node", "part", "open", *bounds, "common")
    x, y = first.where("open").alias("x"), first.alias("y")
    met = x.join(y, [F.col("x.lead") == F.col("y.lead"), F.col("x.shingle") == F.col("y.shingle")]).where(
        (F.col("x.part") != F.col("y.part")) & reduce(lambda a, b: a & b, [F.col(f"x.{c}") + F.col(f"y.{c}") <= 2 * F.least("x.common", "y.common") + F.lit(1e-6) for c in bounds])
    )
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _in_parts(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    return nodes.join(labels, "node", "left").withColumn("part", F.coalesce("label", "node")).drop("label")


def components(links: DataFrame) -> DataFrame:
    """node and the smallest node of its component, for the nodes of ``links`` (a, b)."""
    edges = kept_table(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "edges")
    labels = kept_table(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("label")), "labels")
    while True:
        # The least label among the neighbours, then the label of that label.
        near = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        low = labels.join(near, "node").select("node", F.least("label", "near").alias("to"), F.col("label").alias("was"))
        jump = labels.select(F.col("node").alias("to"), F.col("label").alias("next"))
        new = kept_table(low.join(jump, "to", "left").select("node", F.least("to", F.coalesce("next", "to")).alias("label"), "was"), "labels")
        labels = new.select("node", "label")
        if new.where(F.col("label") != F.col("was")).limit(1).count() == 0:
            return labels


def near_duplicate_classes(
    docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, band_rows: int = BAND_ROWS
) -> DataFrame:
    """doc_id and class_id (the smallest doc_id of the class) of each row of ``docs`` (doc_id, text, any other columns).

    Rows with the same words always share a class, and so do rows with the same id. A null text, an empty one
    or one without words is alone in its class, and so is a row without an id, whose class is null. An empty
    table gives no rows.
    """
    docs = id_and_text(docs)
    sketched = kept_table(sketch(docs, bands, band_rows), "sketch")
    nodes = kept_table(
        sketched.where(F.col("print").isNotNull() & F.col("doc_id").isNotNull()).groupBy("print").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands")),
        "nodes",
    )
    keyed = nodes.select("node", F.posexplode("bands").alias("band", "value")).select(
        "node", F.xxhash64("band", "value").alias("bucket")
    )
    shared = keyed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members = kept_table(keyed.join(shared, "bucket"), "members")
    candidates = members.select("node").distinct()
    texts = kept_table(docs.withColumnRenamed("doc_id", "node").join(candidates, "node").distinct(), "texts")

    known = ["own", "total", "extra"]
    shares = kept_table(_shares(texts).where(F.col("own") <= (1 - threshold + 1e-9) * F.col("total")), "shares")
    members = kept_table(members.join(shares, "node").select("bucket", "node", *known), "members")

    lead = members.groupBy("bucket").agg(F.min(F.struct(F.col("own") / F.col("total"), "node", *known)).alias("lead"))
    leaders = lead.select("bucket", *[F.col(f"lead.{c}").alias(c) for c in ("node", *known)])
    stars = (
        members.alias("x")
        .join(leaders.alias("y"), "bucket")
        .where((F.col("x.node") != F.col("y.node")) & _within_bound("x", "y", threshold))
        .select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        .distinct()
    )
    links = kept_table(verified(stars, texts, threshold), "links")
    labels = components(links)

    placed = members.join(labels, "node", "left").select("bucket", "node", *known, F.coalesce("label", "node").alias("part"))
    mixed = placed.groupBy("bucket").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("bucket")
    led = leaders.select("bucket", F.col("node").alias("lead"), F.col("total").alias("lead_total"))
    placed = kept_table(placed.join(mixed, "bucket").join(led, "bucket"), "placed")
    # Members still apart are coded by their difference from the leader of their bucket.
    refs = placed.select("node", "lead", F.greatest("total", "lead_total").alias("most")).distinct()
    coded = centered(kept_table(differences(refs.select("node", "lead"), texts), "differences")).join(refs, ["node", "lead"])
    # With x and y at least as heavy in sum as what either holds alone by 1 / (1 - threshold): by the texts' own weights, and
    # by what the centre holds and either has over it. ``apart`` weighs the differences, which bounds those without a common one.
    far = F.lit((1 - threshold) / (1 + threshold))
    room = F.lit(1 - threshold) * (F.col("held") / 2 + F.col("over"))
    bounds = {"excess": F.col("size") - far * F.col("weight"), "surplus": F.col("size") - room, "apart": F.col("mass") - room}
    # An id with several texts is bounded by none of them.
    bounds = [F.when(F.col("most") >= 1e12, F.lit(-1e12)).otherwise(c).alias(name) for name, c in bounds.items()]
    coded = kept_table(coded.select("node", "lead", *bounds, "size", "shingles"), "coded")
    close = kept_table(verified(meeting_the_nearest(_in_parts(coded, labels)), texts, threshold), "links")
    if close.limit(1).count():
        links = links.unionByName(close)
        labels = components(links)
    coded = _in_parts(coded, labels)
    most = coded.where("apart > -1e11").groupBy("lead").agg(F.min_by("part", F.struct("apart", "node")).alias("most"))
    coded = coded.join(most, "lead", "left").withColumn("open", F.coalesce(F.col("part") != F.col("most"), F.lit(True))).drop("most")
    coded = kept_table(coded, "coded")
    known += ["excess", "apart"]
    lows = coded.groupBy("node", "lead").agg(F.min("part").alias("part"), *[F.min(c).alias(c) for c in ("excess", "apart")])
    placed = kept_table(placed.drop("part").join(lows, ["node", "lead"]), "placed")
    parts = placed.groupBy("bucket", "part").agg(
        F.min(F.col("own") / F.col("total")).alias("least"),
        F.min("own").alias("own"),
        F.min("total").alias("total"),
        F.max(F.col("total") - F.col("own")).alias("shared"),
        F.max("extra").alias("extra"),
        F.min("excess").alias("excess"),
        F.min("apart").alias("apart"),
    )
    parts = kept_table(parts, "parts")
    # Pairs that may be similar without any common difference; all others share one.
    near = (F.col("x.excess") + F.col("y.excess") <= 1e-6) & (F.col("x.apart") + F.col("y.apart") <= 1e-6)
    meet = (
        parts.alias("x")
        .join(parts.alias("y"), "bucket")
        .where(
            (F.col("x.part") < F.col("y.part"))
            & near
            & _shares_within(F.col("x.least"), F.col("y.least"), threshold)
            & _weights_within(*[tuple(F.col(f"{s}.{c}") for c in ("own", "total", "shared", "extra")) for s in "xy"], threshold)
        )
        .select("bucket", F.col("x.part").alias("part_a"), F.col("y.part").alias("part_b"))
    )
    side_a = placed.select("bucket", F.col("part").alias("part_a"), F.struct("node", *known).alias("a"))
    side_b = placed.select("bucket", F.col("part").alias("part_b"), F.struct("node", *known).alias("b"))
    across = (
        meet.join(side_a, ["bucket", "part_a"])
        .join(side_b, ["bucket", "part_b"])
        .where((F.col("a.excess") + F.col("b.excess") <= 1e-6) & (F.col("a.apart") + F.col("b.apart") <= 1e-6) & _within_bound("a", "b", threshold))
        .select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))
        .union(sharing_a_difference(coded))
        .distinct()
    )
    more = kept_table(verified(across, texts, threshold), "links")
    if more.limit(1).count():
        labels = components(links.union(more))

    classes = nodes.select("print", "node").join(labels, "node", "left").select("print", F.coalesce("label", "node").alias("class_id"))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id")
    return sketched.select("doc_id", "print").join(classes, "print", "left").select("doc_id", own)


def one_of_each(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with the row of the smallest doc_id of each class; repeated rows of it are left once.

    Rows without an id all stay.
    """
    classes = near_duplicate_classes(docs, **parameters)
    chosen = classes.where("doc_id = class_id").groupBy(F.col("doc_id").alias("id")).agg(F.count("*").alias("n"))
    # The whole row travels as one field, so no name of its columns can clash.
    rows = docs.select(docs["doc_id"].cast("long").alias("id"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    kept = rows.join(chosen, "id")
    parts = [kept.where("n = 1"), kept.where("n > 1").dropDuplicates(["id"]), rows.where("id is null")]
    return reduce(DataFrame.unionAll, [p.select("row") for p in parts]).select("row.*")
