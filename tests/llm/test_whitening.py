"""Whitening against plain integer sums and a dense eigendecomposition."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import queries, whitening

SF = "/root/testdata/sf0.001"


def plain(vectors, scale=64.0, shift=1_000_000):
    x = [[int(np.floor(scale * c)) + shift for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    sums = [sum(r[d] for r in x) for d in range(dims)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in x]
    exact = [[sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in x) for j in range(dims)] for i in range(dims)]
    covariance = np.array([[c / n**3 for c in row] for row in exact])
    return np.array(x, float) - np.array(sums) / n, deviation, covariance


def check(rows, vectors, wanted, **options):
    gap, deviation, covariance = plain(vectors, **options)
    values, columns = np.linalg.eigh(covariance)
    values, columns = values[::-1], columns[:, ::-1]
    by = {(r["vec_id"], r["component"]): r for r in rows}
    assert set(by) == {(i, c) for i in range(len(vectors)) for c in range(1, wanted + 1)}
    assert [by[i, 1]["deviation"] for i in range(len(vectors))] == deviation
    for c in range(1, wanted + 1):
        got = np.array([by[i, c]["whitened"] for i in range(len(vectors))])
        want = gap @ columns[:, c - 1] / np.sqrt(values[c - 1])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-6
        assert by[0, c]["explained"] == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
    assert {r["n"] for r in rows} == {len(vectors)} and max(r["identity_error"] for r in rows) < 1e-6


def test_against_plain_sums(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(150, 6)) @ rng.normal(size=(6, 6)) + 3).tolist()
    table = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").repartition(5)
    check(whitening.whiten(table).collect(), vectors, 6)
    check(whitening.whiten(table, components=2, scale=1000.0, shift=-7).collect(), vectors, 2, scale=1000.0, shift=-7)


def test_numbers_beyond_64_bits_stay_exact(spark):
    vectors = [[1e12, 3.0], [-2e12, 5.0], [7e11, -1e12], [0.5, 0.25]]
    rows = whitening.whiten(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")).collect()
    assert sorted(r["deviation"] for r in rows)[::2] == sorted(plain(vectors)[1]) and max(plain(vectors)[1]) > 2**64
    with pytest.raises(Exception, match="64-bit"):
        whitening.whiten(spark.createDataFrame([(1, [1e300]), (2, [0.0])], "vec_id long, embedding array<double>"))


def test_planes_and_products():
    rng = np.random.default_rng(1)
    y = rng.integers(0, [1, 9, 200, 2], (130, 4))
    widths = np.array([int(m).bit_length() for m in y.max(axis=0)])
    weigh = np.array([1 << a for w in widths for a in range(w)], object)
    i, j = np.triu_indices(4)
    assert whitening.cross_products(whitening.bit_planes(y, widths), widths, weigh) == (y.T @ y)[i, j].tolist()


def test_edges(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 2.0]), (1, [0.0, 2.0]), (None, [3.0, 1.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("-inf"), 1.0]), (6, [1.0]), (7, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("v", "n", "dim", "whitened", "component", "a.b")})
    white = whitening.whiten(table).collect()
    assert sorted((r["vec_id"] or -1, r["component"]) for r in white) == [(-1, 1), (-1, 1), (-1, 2), (-1, 2), (1, 1), (1, 1), (1, 2), (1, 2)]
    assert {r["n"] for r in white} == {4}
    assert whitening.whiten(table.limit(0)).count() == 0 and whitening.whiten(table.where("vec_id = 1")).count() == 0
    assert whitening.whiten(table.where("vec_id = 7")).count() == 0 and whitening.fit(table.limit(0)) is None
    flat = spark.createDataFrame([(k, [float(k), 5.0]) for k in range(4)], "vec_id long, embedding array<double>")
    assert {r["component"] for r in whitening.whiten(flat).collect()} == {1}


def test_query(spark):
    rows = queries.op13_whitening(spark, SF).toArrow()
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").toArrow().to_pandas()
    gap, deviation, covariance = plain(vectors["embedding"].tolist())
    got = rows.to_pandas().pivot(index="vec_id", columns="component", values="whitened").loc[vectors["vec_id"]].to_numpy()
    assert got.shape == (len(vectors), 32) and np.abs(np.cov(got.T, bias=True) - np.eye(32)).max() < 1e-9
    values, columns = np.linalg.eigh(covariance)
    want = gap @ columns[:, ::-1][:, :32] / np.sqrt(values[::-1][:32])
    assert np.abs(np.abs(got) - np.abs(want)).max() < 1e-6
    assert dict(rows.to_pandas().groupby("vec_id")["deviation"].first()) == dict(zip(vectors["vec_id"], deviation, strict=True))
