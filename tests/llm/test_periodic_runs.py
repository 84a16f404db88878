"""Runs of words against a brute-force search over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabwright.llm import periodic_runs, queries
from tabwright.llm.words import as_text, words_of

SF = "/root/testdata/sf0.001"


def brute(w, least):
    """(start, length, period) of every run, by start and period."""
    best, codes = {}, np.unique(w, return_inverse=True)[1]
    for q in range(1, len(w) // 2 + 1):
        edge = np.diff(np.concatenate([[0], codes[q:] == codes[:-q], [0]]))
        for s, e in zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) + q).tolist(), strict=True):
            if e - s >= max(2 * q, least):
                best.setdefault((s, e), q)
    return sorted((s, e - s, q) for (s, e), q in best.items())


def kept(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def texts(seed):
    rng = random.Random(seed)
    draw = lambda n, k: [rng.choice("abcdefghij"[:k]) for _ in range(n)]
    out = [[], ["a"], ["a"] * 11, ["a"] * 12, ["a"] * 50, draw(3, 3) * 20, draw(200, 2), draw(300, 3), draw(100, 10)]
    for _ in range(40):
        w = draw(rng.randint(0, 20), 4)
        for _ in range(rng.randint(1, 4)):
            part = draw(rng.randint(1, 9), rng.randint(1, 9))
            w += (part * 9)[: rng.randint(1, 9 * len(part))] + draw(rng.randint(0, 6), 5)
        out.append(w)
    line = draw(9, 9)
    out.append([x for k in range(30) for x in (*line, str(k))])  # a line between numbers: repeats, but no run
    fib = ["a"], ["a", "b"]
    for _ in range(9):
        fib = fib[1], fib[1] + fib[0]
    return [*out, fib[1]]


@pytest.mark.parametrize(("seed", "least"), [(1, 12), (2, 12), (3, 5), (4, 2), (5, 30)])
def test_against_brute_force(seed, least):
    data = texts(seed)
    bounds, _, codes = words_of(as_text(pa.array([" ".join(w) for w in data])), lower=False)
    found = periodic_runs.find(codes.astype(np.int64), bounds, least)
    got = [[tuple(r[1:]) for r in found.tolist() if r[0] == k] for k in range(len(data))]
    assert got == [brute(w, least) for w in data] and len(found) > 20


def test_suffix_array_and_lcp():
    w = "a b a b a b c a b a b d a b c".split()
    codes = np.unique(w, return_inverse=True)[1].astype(np.int64)
    positions, lcp = periodic_runs.suffix_array(codes, np.array([0, len(w)]), 2)
    share = lambda i, j: next(k for k in range(len(w) + 1) if max(i, j) + k >= len(w) or w[i + k] != w[j + k])
    assert sorted(positions.tolist()) == [i for i in range(len(w)) if any(share(i, j) >= 2 for j in range(len(w)) if j != i)]
    want = [0] + [n if (n := share(i, j)) >= 2 else 0 for i, j in zip(positions[:-1], positions[1:], strict=True)]
    assert lcp.tolist() == want


def test_maximal_pairs_skip_same_left_words():
    w = [0, 1, 2, 1, 2, 1, 2, 3]
    positions, lcp = periodic_runs.suffix_array(np.array(w), np.array([0, len(w)]), 2)
    pairs = set()
    for part in np.split(np.arange(len(lcp)), np.flatnonzero(lcp == 0)[1:]):
        pairs |= {(min(i, j), max(i, j), n) for i, j, n in periodic_runs.maximal_pairs(positions[part].tolist(), lcp[part].tolist(), [-1, *w[:-1]])}
    assert pairs == {(1, 3, 4)}  # (2, 4) has the same word before, (1, 5) is further apart than it is long


def test_operator_and_edges(spark, monkeypatch):
    long = "one two three " * 30_000
    docs = spark.createDataFrame([(1, "A a " * 8 + "x"), (None, "b " * 12), (1, "b " * 12), (2, None), (3, ""), (4, " \n\t"), (5, long), (6, "é\x1cx " * 6)], "doc_id long, text string")
    docs = docs.withColumns({c: F.lit("x") for c in ("runs", "collapsed", "w", "n", "a.b")})
    rows = periodic_runs.find_runs(docs.coalesce(1)).collect()
    got = sorted((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in rows)
    assert got == [(0, 12, [(0, 12, 1)], "b"), (1, 12, [(0, 12, 1)], "b"), (1, 17, [(0, 16, 2)], "A a x"), (2, 0, [], ""), (3, 0, [], ""), (4, 0, [], ""), (5, 90_000, [(0, 90_000, 3)], "one two three"), (6, 6, [], " ".join(["é\x1cx"] * 6))]
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0
    monkeypatch.setattr(periodic_runs, "BYTES_AT_ONCE", 10)
    assert [b - a for a, b in periodic_runs._pieces(as_text(pa.array(["", "x" * 50, "abc", None, "defg", "h" * 9, "i"])))] == [1, 1, 3, 2]


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in queries.op12_periodic_runs(spark, SF).collect()}
    planted = 0
    for doc in docs:
        w = re.findall("[^\x20\x09-\x0d]+", doc["text"] or "")
        n, h = len(w), zlib.crc32(str(doc["doc_id"]).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
            planted += 1
        runs = brute(w, 12)
        first = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        want = (len(runs), *first, runs and 1000 * first[1] // first[2] or None)
        row = got[doc["doc_id"]]
        assert (row["n_runs"], row["start"], row["length"], row["period"], row["exponent_milli"]) == want
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        assert row["runs_sha256"] == sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)) and row["collapsed_sha256"] == sha(kept(w, runs))
    assert planted > 10 and len(got) == len(docs)
