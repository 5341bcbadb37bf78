"""Spelling variants, the token store and token alignment against brute force, and on odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import sys
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.conftest import SF_SMALL
from tests.llm.test_operators import BYTE, WORD, none_of, odd_docs, texts_of
from tideline.llm import alignment, library_ids, spelling, token_store
from tideline.llm.queries import QUERIES

PIECE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.mark.parametrize("path, spaced, specials", [(WORD, False, True), (BYTE, True, False), (BYTE, True, True)])
def test_library_ids_equal_the_library(spark, small, path, spaced, specials):
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = not specials
    texts = [t for _, t in texts_of(odd_docs(spark)) + texts_of(small)] + [" " * 40 + "a b", "it's!!'s", "ſa İ x́"]
    got = list(library_ids.LibraryIds(path, "test", spaced, specials).of(texts))
    for text, raw in zip(texts, got):
        assert np.frombuffer(raw, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_library_ids_hold_little_at_once():
    """Beside an earlier stage's memory there is room for a few megabytes a worker, whatever the size of a batch."""
    ids = library_ids.LibraryIds(WORD, "test")
    texts = pa.array(["the quick brown fox jumps over the lazy dog, again and again. " * 30] * 7000)
    one = next(ids.of_column(texts[:1]))
    tracemalloc.start()
    try:
        assert all(raw == one for raw in ids.of_column(texts))
        assert tracemalloc.get_traced_memory()[1] < 30_000_000
    finally:
        tracemalloc.stop()
    words = pa.array([" ".join(f"{k:040}" for k in range(start, start + 1000)) for start in range(0, 300_000, 1000)])
    assert sum(1 for _ in ids.of_column(words)) == 300
    # A slice may come on top of the bound, in both generations.
    assert len(ids.cache) + len(ids.cache.older) < 270_000


def test_library_ids_of_a_column_equal_the_library(spark, small):
    library = Tokenizer.from_file(WORD)
    signs = ".,;:!?#*$%&|<>()[]\"-"
    latin = [chr(c) for c in range(0x180)]
    texts = [t for _, t in texts_of(odd_docs(spark)) + texts_of(small)]
    texts += [f"{c} a{c} {c}B {c}.{c} {c}{c}{s} É{c}É{s}{s}" for c in latin for s in signs[ord(c) % 7 :: 7]]
    texts += ["", " ", "...", "İ İ. Aİ, ŉ. ß ẞ ſ.", "x́ x́. é. ﬁ. Σς. K.", "it's It'S. don't- a'b.", "a1. 1a. ½.", "日本. 語, ǅ.", "x\x1cy <|endoftext|>. z"]
    column = pa.array(["not read", *texts])[1:]
    got = list(library_ids.LibraryIds(WORD, "test").of_column(column))
    assert len(got) == len(texts)
    for text, raw in zip(texts, got):
        assert np.frombuffer(raw, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_library_ids_cost_a_call_per_word_not_per_chunk():
    """Words return in capitals and before signs, and from slice to slice; only a word never met may cost Python calls."""
    letters = "abcdefghijklmnopqrst"
    words = [a + b + c + d for a in letters for b in letters for c in letters for d in letters][:120_000]
    forms = [words, *([w.capitalize() + s for w in words[:5000]] for s in ["", ".", ",", "!", "?", ";", ":", "..."]), words]
    texts = pa.array([" ".join(f[k : k + 1000]) for f in forms for k in range(0, len(f), 1000)])
    ids = library_ids.library_ids(WORD, "calls")
    calls = Counter()
    sys.setprofile(lambda frame, event, _: calls.update([frame.f_code.co_name] if event == "call" else []))
    try:
        got = list(ids.of_column(texts))
    finally:
        sys.setprofile(None)
    assert got[:120] == got[-120:]
    assert calls["_merged"] < 121_000
    assert calls.total() < 260_000


# ---- spelling ----
def brute_variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    holes, near = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            holes[w[:i] + "\0" + w[i + 1 :]].add(w)
            short = w[:i] + w[i + 1 :]
            if short in n:
                near[w].add(short)
                near[short].add(w)
    for words in holes.values():
        for w in words:
            near[w] |= words - {w}
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= 2 * n[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


@pytest.mark.parametrize("parameters", [{}, {"cell_words": 20, "sample": 60}, {"cell_words": 5, "sample": 10}])
def test_spelling_variants(spark, small, parameters):
    got = {r["word"]: tuple(r) for r in spelling.spelling_variants(small, **parameters).collect()}
    assert got == brute_variants(texts_of(small)) and len(got) > 1000


def test_spelling_of_odd_rows(spark):
    random.seed(5)
    letters = "abcçé"
    words = ["".join(random.choices(letters, k=random.choice((5, 6, 7)))) for _ in range(300)]
    words += ["y" * 30_000, "y" * 29_999, "angle", "angel", "Àbcde", "àbcde"]
    texts = [" ".join(random.choices(words, k=60)) for _ in range(40)] + [" ".join(words[-6:])] * 4 + [None, "", "1 2 3"]
    docs = odd_docs(spark, texts)
    want = brute_variants(texts_of(docs))
    # Small cells of words with like letter counts are worked in blocks.
    for parameters in ({}, {"cell_words": 3, "sample": 40}):
        assert {r["word"]: tuple(r) for r in spelling.spelling_variants(docs, **parameters).collect()} == want
    assert spelling.spelling_variants(none_of(docs)).count() == 0


def test_one_edit_is_exact():
    random.seed(1)

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    for extra in (0, 1):
        a = ["".join(random.choices("ab", k=5)) for _ in range(400)]
        b = ["".join(random.choices("ab", k=5 + extra)) for _ in range(400)]
        assert spelling.one_edit(a, b).tolist() == [near(x, y) for x, y in zip(a, b)]


# ---- token store ----
def brute_store(rows):
    library, out, start = Tokenizer.from_file(WORD), [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text, add_special_tokens=False).ids + [1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("parameters", [{}, {"shard_bytes": 20_000, "segment_keys": 16}])
def test_token_store(spark, small, parameters):
    got = token_store.stored_digests(small, WORD, **parameters).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == sorted(brute_store(texts_of(small)))


def test_token_store_of_odd_rows(spark):
    docs = odd_docs(spark)
    hot = docs.where("doc_id = 5").limit(1)
    for _ in range(6):
        hot = hot.unionAll(hot)
    docs = docs.unionAll(hot).repartition(8)
    store = token_store.write_store(docs, WORD, shard_bytes=500, segment_keys=3)
    rows = store.read(docs).collect()
    want = brute_store(texts_of(docs))
    digest = lambda doc_id, raw: (repr(doc_id), len(raw) // 4, zlib.crc32(raw))
    assert sorted(digest(r["doc_id"], r["ids"]) for r in rows) == sorted((repr(a), n, crc) for a, _, n, crc in want)
    # Places follow each other without gaps, in doc_id order.
    placed = sorted((r["start"], len(r["ids"]) // 4, r["doc_id"]) for r in rows)
    assert [s for s, _, _ in placed] == np.cumsum([0] + [n for _, n, _ in placed[:-1]]).tolist()
    keys = [k for _, _, k in placed]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    # The hot key lies in several shards and is read whole; keys that were never stored give nothing.
    assert store.runs().where("key = 5").count() > 1 and len(store.get(5)) == sum(1 for k in keys if k == 5)
    assert all(store.get(k) == [] for k in range(1000, 1400))
    asked = spark.createDataFrame([(1,), (1,), (999,)], "doc_id long")
    assert sorted(r["doc_id"] for r in store.read(asked).collect()) == [1, 1]
    empty = token_store.write_store(none_of(docs), WORD)
    assert empty.read(docs).count() == 0 and empty.get(1) == []


def test_perfect_hash_is_minimal():
    random.seed(3)
    for n in (0, 1, 2, 1000, 30_000):
        hashes = np.array(random.sample(range(1 << 62), n), dtype=np.uint64)
        built = token_store.PerfectHash.build(hashes)
        read, _ = token_store.PerfectHash.read(memoryview(b"".join(built.parts())))
        assert sorted(read.number(hashes).tolist()) == list(range(n))
        assert 64 * sum(map(len, built.levels)) <= 5 * n + 64 * len(built.levels)


def test_perfect_hash_keeps_what_no_level_parts(monkeypatch):
    monkeypatch.setattr(token_store, "_LEVELS", 1)
    hashes = np.arange(500, dtype=np.uint64)
    built = token_store.PerfectHash.build(hashes)
    assert len(built.rest) and sorted(built.number(hashes).tolist()) == list(range(500))


# ---- alignment ----
def brute_alignment(rows):
    a, b = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    a.encode_special_tokens = True
    of_a, of_b = alignment.byte_level_tokens(BYTE), alignment.piece_tokens(PIECE)
    found, counts = [], Counter()
    for doc_id, text in rows:
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw = (" " + text).encode()
        if not text or b"".join(of_a[i] for i in x) != raw or b"".join(of_b[i] for i in y) != raw:
            found.append((doc_id, [], [], [], ""))
            continue
        ends = [np.cumsum([len(of[i]) for i in ids]).tolist() for of, ids in ((of_a, x), (of_b, y))]
        common = sorted(set(ends[0]) & set(ends[1]))
        links = [(x[ends[0].index(p)], y[ends[1].index(p)]) for p in common] if len(common) < 3000 else None
        at = [dict(zip(e, ids)) for e, ids in zip(ends, (x, y))]
        links = [(at[0][p], at[1][p]) for p in common] if links is None else links
        counts.update(links)
        groups, start = [], 0
        for stop in common:
            groups.append("|".join(",".join(str(i) for e, i in zip(e_, ids) if start < e <= stop) for e_, ids in zip(ends, (x, y))) if len(common) < 3000 else None)
            start = stop
        found.append((doc_id, x, y, links, hashlib.sha256(";".join(groups).encode()).hexdigest() if None not in groups else None))
    most = defaultdict(int)
    for (_, i), n in counts.items():
        most[i] = max(most[i], n)
    return [
        (d, len(x), len(y), len(links), len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links), sha)
        for d, x, y, links, sha in found
    ]


def test_alignment(spark, small):
    for docs in (odd_docs(spark, [None, "", " \n\t ", "é ü 😀 <|endoftext|> don't 1 22  333\n\n a", "<s>x</s>▁a", "á Σ \x00", "   lead", "word " * 20_000]), small):
        got = {repr(tuple(r)[:7]): r["groups_sha256"] for r in alignment.alignment_digests(docs, BYTE, PIECE).collect()}
        want = brute_alignment(texts_of(docs))
        assert set(got) == {repr(w[:7]) for w in want}
        assert all(w[7] is None or got[repr(w[:7])] == w[7] for w in want)


def test_alignment_of_no_rows(spark):
    assert alignment.alignment_digests(none_of(odd_docs(spark)), BYTE, PIECE).count() == 0


def test_overlaps_share_bytes(spark):
    docs = odd_docs(spark, ["", "don't stop  the unbelievable   façade", "x", None, "a b", "naïve coöperation"])
    for row in alignment.align_tokens(docs, BYTE, PIECE).collect():
        pairs = [(o["a_start"], o["a_end"], o["b_start"], o["b_end"]) for o in row["overlaps"]]
        a, b = {p[:2] for p in pairs}, {p[2:] for p in pairs}
        assert set(pairs) == {(*x, *y) for x in a for y in b if x[0] < y[1] and y[0] < x[1]}
        for o in row["overlaps"]:
            assert o["a_group"] == o["b_group"]


def test_pairs_stay_within_the_vocabularies(spark, small):
    held = alignment.aligned(small, BYTE, PIECE)
    of_a, of_b = alignment.byte_level_tokens(BYTE), alignment.piece_tokens(PIECE)
    pairs = [divmod(r["link"], len(of_b)) for r in alignment.pair_counts(held, len(of_b)).collect()]
    assert all(of_a[i].endswith(of_b[j]) or of_b[j].endswith(of_a[i]) for i, j in pairs)
    assert len(pairs) <= alignment.most_pairs(BYTE, PIECE)


def test_registered():
    assert {"op11_spelling", "op12_token_store", "op13_alignment"} <= set(QUERIES)
