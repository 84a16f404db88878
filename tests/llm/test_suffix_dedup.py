"""Removal of long repeats against a brute-force count of all strings of the wanted length."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tabwright.llm import suffix_dedup
from tabwright.llm.hot_keys import join_hot_apart, least_hot


def brute(texts, length):
    """Each text's maximal removed stretches and what is left."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        edges = [i for i in range(len(r) + 1) if (gone[i] if i < len(r) else 0) != (gone[i - 1] if i else 0)]
        out.append((len(r), sum(gone), list(zip(edges[::2], edges[1::2], strict=True)), bytes(b for b, g in zip(r, gone, strict=True) if not g)))
    return out


def found(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(docs, **options).collect()}
    return [(r["n_bytes"], r["n_removed"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for _, r in sorted(rows.items())]


def corpus(seed):
    rng = random.Random(seed)
    say = lambda n: "".join(rng.choice("abcdéfgh 中ij") for _ in range(n))
    passage, other = say(60), say(25)
    texts = [None, "", "x", say(19), "a" * 200, "ab" * 90, say(40) * 3]
    for _ in range(30):  # one passage in most texts, with few ways to go on: many equal and many different neighbours
        texts.append(say(rng.randint(0, 30)) + passage[rng.randint(0, 8) : rng.randint(40, 60)] + rng.choice(["", other, say(10)]) + rng.choice("abc"))
    copy = say(150)
    texts += [copy] * 4 + [copy[:70] + "!" + copy[71:], copy + say(5), say(7) + copy]
    return texts


@pytest.mark.parametrize(("seed", "options"), [(1, {"seed_length": 5}), (2, {"seed_length": 20}), (3, {"seed_length": 8, "block": 4}), (4, {"seed_length": 3, "block": 2})])
def test_against_brute_force(spark, seed, options, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CONTEXTS_A_TASK", 60)
    texts = corpus(seed)
    want = brute(texts, 20)
    assert found(spark, texts, length=20, **options) == want
    assert sum(bool(w[1]) for w in want) > 20 and any(0 < w[1] < w[0] for w in want)


def test_long_texts_come_in_pieces():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 4, 5000).astype(np.uint8)
    whole = suffix_dedup.contexts_of(data, [(0, 0, 5000)], 50, 10)
    parts = [p for ps in _pieces_of(5000, 700) for p in ps]
    cut = suffix_dedup.contexts_of(data, parts, 50, 10)
    starts = lambda c: {(s, a + o) for a, b, o in zip(c["low"], c["high"], c["offset"], strict=True) for s in range(a, b - 49)}
    assert starts(whole) == starts(cut) and len(starts(whole)) == 4951


def _pieces_of(n, size):
    kept, suffix_dedup.PIECE = suffix_dedup.PIECE, size
    try:
        return list(suffix_dedup._pieces(np.array([0, n]), 50))
    finally:
        suffix_dedup.PIECE = kept


def test_suffix_order_is_lexicographic():
    rng = random.Random(5)
    data = np.frombuffer(("".join(rng.choice("ab") for _ in range(400)) + "ab" * 100).encode(), np.uint8)
    start, length = np.arange(len(data) - 29), 30
    kind = np.array([rng.randint(0, 2) for _ in start])
    order, ties = suffix_dedup.suffix_order(suffix_dedup.PrefixHashes(data), data, start, kind, length)
    key = [(kind[i], data[i : i + length].tobytes()) for i in order]
    assert key == sorted(key) and ties.tolist() == [i > 0 and key[i] == key[i - 1] for i in range(len(key))]


def test_a_collision_is_seen():
    data = np.frombuffer(b"abcdabce", np.uint8)
    assert not suffix_dedup._verified(data, np.array([0, 4]), np.array([0, 1]), np.array([False, True]), 4)
    assert suffix_dedup._verified(data, np.array([0, 4]), np.array([0, 1]), np.array([False, True]), 3)


def test_heads_that_tie_share_their_core():
    text = bytes(random.Random(2).choice(b"ab") for _ in range(60))
    length, seed = 20, 6
    for a, b, anchor in ((5, 45, 12), (9, 50, 20), (3, 31, 8)):
        first, last = max(0, anchor + length - b), min(length - seed, anchor - a)  # offsets of the heads that fit
        cores = suffix_dedup.cores_of(text[a:b], anchor - a, length, seed)
        for q, core in enumerate(cores):
            low, high = q * suffix_dedup.RANGE, min((q + 1) * suffix_dedup.RANGE, length - seed + 1) - 1
            assert (core is not None) == (low <= last and high >= first)
            if core is not None:
                assert a <= anchor - low and anchor - high + length <= b
                assert core == xxhash.xxh3_64_intdigest(text[anchor - low : anchor - high + length]) - 2**63


def test_edges(spark):
    text = "lorem ipsum dolor sit amet " * 40_000
    docs = spark.createDataFrame([(1, text), (None, "é" * 150), (None, "é" * 150), (1, "short"), (2, None), (3, "")], "doc_id long, text string")
    docs = docs.withColumns({c: F.lit("x") for c in ("h", "g", "d1", "found", "packed", "whole", "a.b")})
    rows = suffix_dedup.remove_repeats(docs).collect()
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"], len(r["spans"])) for r in rows) == [(0, 300, 300, 1), (0, 300, 300, 1), (1, 5, 0, 0), (1, len(text), len(text), 1), (2, 0, 0, 0), (3, 0, 0, 0)]
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_join_hot_apart(spark):
    rows = spark.createDataFrame([(k % 7 if k % 3 else 99, k) for k in range(9000)], "k long, v long")
    keyed = rows.groupBy("k").agg(F.count("*").alias("times")).where("k != 2")
    got = join_hot_apart(rows, keyed, ["k"], "times", 9000)
    assert least_hot(9000) == 5 and sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.join(keyed, "k").collect()))
