"""Trees on cells: the same sums as on rows, drawn as rows are drawn."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tabwright.operators import cells, models


@pytest.fixture(autouse=True)
def small_tables_too(monkeypatch):
    monkeypatch.setattr(cells, "FROM", 0)


def rows_of_vectors(spark, x, y, w):
    rows = [(Vectors.dense(a), int(b), float(c)) for a, b, c in zip(x.tolist(), y, w, strict=True)]
    return spark.createDataFrame(rows, ["features", "y", "weight"])


def test_every_row_is_in_a_cell(spark):
    """40 times the rows are 40 times the counts and no more cells; edges part neighbouring values."""
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.integers(0, 3, 200), rng.integers(0, 2, 200) * 5.0])
    once = rows_of_vectors(spark, x, rng.integers(0, 2, 200), np.ones(200))
    many = once.crossJoin(spark.range(40)).drop("id")
    own, all_rows = cells.cells_of(once, "y"), cells.cells_of(many, "y")
    assert own.bins.getOrDefault("edges") == all_rows.bins.getOrDefault("edges") == "[[0.5, 1.5], [2.5]]"
    counts = [{(r["y"], tuple(r["binned"])): r["_n"] for r in c.rows.collect()} for c in (own, all_rows)]
    assert sum(counts[0].values()) == 200 and counts[1] == {k: 40 * n for k, n in counts[0].items()}
    assert own.size == all_rows.size == len(counts[0]) <= 12


def test_bins_hold_equal_shares_of_skewed_rows(spark):
    x = np.exp(np.random.default_rng(5).normal(size=(3200, 1)) * 4)
    ready = rows_of_vectors(spark, x, np.zeros(3200), np.ones(3200))
    binned = cells.fit_bins(ready, 1).transform(ready).select(vector_to_array("binned")[0].alias("b"))
    sizes = {r["b"]: r["count"] for r in binned.groupBy("b").count().collect()}
    assert sorted(sizes) == [float(b) for b in range(cells.BINS)] and all(99 <= n <= 101 for n in sizes.values())


def test_draws_are_those_of_the_rows(spark):
    """A cell of n rows draws a Poisson number of mean n, the same in any partitioning; a cell's draws vary by tree."""
    rows = [(i % 2, 1.0, Vectors.dense(float(i)), n) for i, n in enumerate([1, 1, 9, 400])]
    df = spark.createDataFrame(rows, ["y", "_weight", "binned", "_n"])
    names = [f"_d{t}" for t in range(500)]
    got = [{r["binned"][0]: [r[n] for n in names] for r in cells._drawn(df.repartition(p), "y", 500, 42).collect()} for p in (1, 3)]
    assert got[0] == got[1] and got[0][0.0] != got[0][1.0]
    for place, n in ((0.0, 1), (2.0, 9), (3.0, 400)):
        draws = np.array(got[0][place])
        assert abs(draws.mean() - n) < 5 * (n / 500) ** 0.5 and 0.75 * n < draws.var() < 1.3 * n


def test_boosting_on_cells_is_boosting_on_rows(spark):
    """Features of few values: the plain trees split at the same places, so all chances agree."""
    rng = np.random.default_rng(6)
    x = rng.integers(0, 5, (600, 3)).astype(float)
    y = (x[:, 0] + x[:, 1] + rng.normal(size=600) > 4.5).astype(int)
    ready = rows_of_vectors(spark, x, y, np.ones(600))
    ours = models.gradient_boosting("y", rounds=4, depth=3).fit(ready)
    plain = GBTClassifier(labelCol="y", maxIter=4, stepSize=0.1, maxDepth=3, seed=models.SEED).fit(ready)
    chances = [{tuple(r["features"]): r["probability"][1] for r in m.transform(ready).select("features", "probability").collect()} for m in (ours, plain)]
    assert chances[0].keys() == chances[1].keys() and all(chances[0][k] == pytest.approx(chances[1][k], abs=1e-9) for k in chances[0])


def test_a_forest_on_cells_weighs_its_rows_and_survives_a_reload(spark, tmp_path):
    """The chance at a place is the weighted share of label 1 there, whatever the number of rows; a rare class stays a class."""
    counts = {(0, 0): 300, (0, 1): 100, (1, 0): 40, (1, 1): 160, (2, 2): 1}
    one = spark.createDataFrame([(Vectors.dense(float(v)), y, 2.0 if y else 1.0, n) for (v, y), n in counts.items()], ["features", "y", "weight", "n"])
    ready = one.withColumn("_r", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("n", "_r")
    model = models.random_forest("y", trees=40, depth=3).fit(ready)
    chances = {r["features"][0]: list(r["probability"]) for r in model.transform(one).collect()}
    assert len(model.stages[1].trees) == 40 and all(len(p) == 3 for p in chances.values())
    assert chances[0.0][1] == pytest.approx(200 / 500, abs=0.05) and chances[1.0][1] == pytest.approx(320 / 360, abs=0.05)
    models.save_model(model, str(tmp_path / "m"))
    again = models.load_model(str(tmp_path / "m")).transform(one).collect()
    assert {r["features"][0]: list(r["probability"]) for r in again} == chances


def test_many_features_are_left_as_rows(spark):
    x = np.random.default_rng(7).normal(size=(60, cells.WIDEST + 1))
    ready = rows_of_vectors(spark, x, (x[:, 0] > 0).astype(int), np.ones(60))
    assert cells.cells_of(ready, "y") is None
    for build in (models.random_forest("y", trees=3, depth=2), models.gradient_boosting("y", rounds=2, depth=2)):
        assert models.accuracy(build.fit(ready).transform(ready), "y").first()[0] > 0.6
