"""The most frequent values against plain counts, and how many rows are moved to find them."""

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pytest

from tabwright.operators import frequent


def best(values, k):
    return sorted(sorted(Counter(v for v in values if v is not None and v == v).items()), key=lambda x: -x[1])[:k]


def run(spark, values, kind, k=1, parts=4):
    df = spark.createDataFrame([(v,) for v in values], f"`a b` {kind}").repartition(parts)
    return frequent.frequent_values(df, ["a b"], k)["a b"]


@pytest.mark.parametrize("k", [1, 3])
@pytest.mark.parametrize("few", [0, 1000])
def test_kinds(spark, k, few, monkeypatch):
    monkeypatch.setattr(frequent, "FEW", few)
    rng = random.Random(k)
    for kind, pool in {
        "string": ["", "é", "b", "Z", None],
        "double": [0.0, -0.0, float("nan"), 1.5, None],
        "decimal(9,2)": [Decimal("1.00"), Decimal("2.50"), None],
        "date": [dt.date(2020, 1, d) for d in (1, 2, 3)],
        "timestamp": [dt.datetime(2020, 1, 1, h) for h in range(5)],
        "boolean": [True, False, None],
        "binary": [b"a", b"", None],
    }.items():
        values = [rng.choice(pool) for _ in range(200)]
        got = [(bytes(v) if isinstance(v, bytearray) else v, n) for v, n in run(spark, values, kind, k)]
        assert got == best(values, k), kind


def one_by_one(monkeypatch):
    seen = []
    plain = frequent._counted_one_by_one
    monkeypatch.setattr(frequent, "_counted_one_by_one", lambda cells, k: seen.append(cells.count()) or plain(cells, k))
    return seen


def test_a_value_that_stands_out_moves_no_column(spark, monkeypatch):
    """120,000 rows, nearly all different: sketches and buckets are all that is sent."""
    seen = one_by_one(monkeypatch)
    values = [f"v{i}" for i in range(119_000)] + ["hot"] * 600 + ["warm"] * 400
    random.Random(1).shuffle(values)
    assert run(spark, values, "string", 2) == [("hot", 600), ("warm", 400)] and not seen
    assert run(spark, values[:900], "string") and seen  # few values are counted


def test_no_value_stands_out(spark, monkeypatch):
    """All values once but one: every bucket may hold a winner, so values are counted."""
    seen = one_by_one(monkeypatch)
    values = [f"v{i:05}" for i in range(30_000)] + ["v20000", "v10000"]
    assert run(spark, values, "string", 3) == [("v10000", 2), ("v20000", 2), ("v00000", 1)] and seen


def test_only_near_buckets_are_counted(spark, monkeypatch):
    monkeypatch.setattr(frequent, "LISTED", 4)
    monkeypatch.setattr(frequent, "TRACKED", 16)
    monkeypatch.setattr(frequent, "FEW", 0)
    seen = one_by_one(monkeypatch)
    rng = random.Random(4)
    values = [int(rng.paretovariate(0.7)) % 5000 for _ in range(20_000)]
    assert run(spark, values, "bigint", 2) == best(values, 2)
    assert run(spark, values, "bigint", 40) == best(values, 40)
    assert all(n < 20_000 for n in seen)


def test_edges(spark):
    df = spark.createDataFrame([(None, None, 1)] * 3, "a string, b double, c int")
    assert frequent.frequent_values(df, ["a", "b", "c", "c"], 2) == {"a": [], "b": [], "c": [(1, 3)]}
    assert frequent.frequent_values(df.limit(0), ["a", "c"]) == {"a": [], "c": []}
    assert frequent.modes(df, ["c", "a"]).first() == (1, None) and frequent.top_values(df, "a", 5).count() == 0
    assert [tuple(r) for r in frequent.top_values(df, "c", 5).collect()] == [(1, 3, 1)]
