import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tabwright.operators import features, models, newton
from tabwright.sources.synthetic import survey_of_size


@pytest.mark.parametrize(("sizes", "share"), [((75, 25), 0.2), ((7, 5, 3), 0.3), ((40, 1), 0.2), ((1, 1, 1), 0.5)])
def test_split_is_exact_and_stratified(spark, sizes, share):
    n = sum(sizes)
    edges = [sum(sizes[: i + 1]) for i in range(len(sizes))]
    y = F.lit(len(sizes) - 1)
    for i in reversed(range(len(sizes) - 1)):
        y = F.when(F.col("id") < edges[i], F.lit(i)).otherwise(y)
    df = spark.range(n).withColumn("y", y)
    out = features.stratified_split(df, "y", "id", share, digits=1)
    got = {r["y"]: r["t"] for r in out.groupBy("y").agg(F.count_if("is_test").alias("t")).collect()}
    assert out.count() == n and sum(got.values()) == math.ceil(share * n)
    total = math.ceil(share * n)
    for i, size in enumerate(sizes):
        assert abs(got[i] - total * size / n) < 1
    again = features.stratified_split(df.repartition(3), "y", "id", share, digits=1)
    assert sorted(out.collect()) == sorted(again.collect())


def test_features_fill_scale_and_ignore_the_unseen(spark):
    train = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (3.0, "b"), (10.0, None), (None, "b")], "x double, c string")
    test = spark.createDataFrame([(None, "zzz"), (math.nan, None)], "x double, c string")
    out = features.fit_features(train, ["x"], ["c"]).transform(test)
    values = [r[0] for r in out.select(vector_to_array("features")).collect()]
    filled = [1.0, 2.0, 3.0, 10.0, 2.5]
    mean = sum(filled) / 5
    std = math.sqrt(sum((v - mean) ** 2 for v in filled) / 5)
    z = (2.5 - mean) / std
    assert values == [[pytest.approx(z), 0.0, 0.0], [pytest.approx(z), 0.0, 1.0]]


def test_quotes_survive_in_fitted_stages(spark):
    df = spark.createDataFrame([("No, and I don't plan to",), (None,), ("back\\slash",), ("No, and I don't plan to",)], "c string")
    out = features.fit_features(df, [], ["c"]).transform(df)
    assert [r["c_filled"] for r in out.collect()] == ["No, and I don't plan to"] * 2 + ["back\\slash", "No, and I don't plan to"]


def test_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    got = {r["y"]: r["weight"] for r in features.balanced_weights(df, "y").collect()}
    assert got == {0: pytest.approx(4 / 6), 1: pytest.approx(2.0)}


def test_scores_by_hand(spark):
    pairs = [(1, 1.0)] * 3 + [(1, 0.0)] * 2 + [(0, 1.0)] + [(0, 0.0)] * 4
    df = spark.createDataFrame(pairs, "y int, prediction double")
    b = models.binary_scores(df, "y").first()
    assert (b["accuracy"], b["precision"], b["recall"], b["f1"]) == (0.7, 0.75, 0.6, pytest.approx(2 / 3))
    f0 = 2 * 4 / (5 + 6)
    assert models.weighted_f1(df, "y").first()[0] == pytest.approx((f0 * 5 + 2 / 3 * 5) / 10)
    report = {r["row"]: r for r in models.classification_report(df, "y").collect()}
    assert set(report) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert report["macro avg"]["recall"] == pytest.approx((0.6 + 0.8) / 2) and report["accuracy"]["f1"] == 0.7


def test_scores_without_positive_predictions(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 0.0)], "y int, prediction double")
    assert tuple(models.binary_scores(df, "y").first()) == (0.5, 0.0, 0.0, 0.0)
    rows = {r["row"]: r["f1"] for r in models.classification_report(df, "y").collect()}
    assert rows["1"] == 0.0


def test_best_model_beats_the_majority_and_survives_a_reload(spark, tmp_path):
    df = survey_of_size(spark, 600).where("ConvertedCompYearly IS NOT NULL").dropDuplicates()
    edge = df.agg(F.percentile("ConvertedCompYearly", F.lit(0.75))).first()[0]
    df = df.withColumn("high", F.when(F.col("ConvertedCompYearly") >= edge, 1).otherwise(0))
    split = features.stratified_split(df, "high", ["YearsCodePro", "ConvertedCompYearly"])
    picked = models.compare_and_select(
        split.where("not is_test"), split.where("is_test"), "high", ["YearsCodePro", "JobSat"],
        ["AISelect", "RemoteWork", "EdLevel"], candidates=("LogisticRegression",),
    )
    row = picked.results.first()
    assert picked.best_name == "LogisticRegression" and row["recall"] > 0.5 and row["accuracy"] > 0.6
    models.save_model(picked.best_model, str(tmp_path / "m"))
    kept = picked.best_scored.select("YearsCodePro", "JobSat", "AISelect", "RemoteWork", "EdLevel", F.col("prediction").alias("was"))
    again = models.batch_predict(models.load_model(str(tmp_path / "m")), kept)
    assert again.where("was != prediction").count() == 0


def test_trees_learn_a_step(spark):
    df = spark.range(200).select((F.col("id") > 100).cast("int").alias("y"), F.col("id").cast("double").alias("x"))
    ready = features.fit_features(df, ["x"], []).transform(features.balanced_weights(df, "y"))
    for build in (models.random_forest("y", trees=5, depth=3), models.gradient_boosting("y", rounds=3, depth=2)):
        assert models.accuracy(build.fit(ready).transform(ready), "y").first()[0] > 0.98


def test_regression_recovers_known_weights(spark):
    df = spark.range(100).select(
        F.col("id").cast("double").alias("a"), F.pmod("id", F.lit(7)).cast("double").alias("b")
    ).withColumn("y", F.lit(5.0) + 2 * F.col("a") - 3 * F.col("b") + F.when(F.col("a") % 2 == 0, 0.1).otherwise(-0.1))
    terms = {r["term"]: r for r in models.interpret_ols(models.ols(df, "y", ["a", "b"])).collect()}
    assert terms["a"]["coefficient"] == pytest.approx(2, abs=0.01) and terms["a"]["effect"] == "raises"
    assert terms["b"]["effect"] == "lowers" and terms["intercept"]["r2"] > 0.999
    model = models.ridge(df, "y", ["a", "b"], alpha=1e-9)
    scored = models.score_and_convert(model, df, rate=1350, unit=10)
    assert scored.agg(F.max(F.abs(F.col("prediction") - F.col("y")))).first()[0] < 0.2
    assert scored.where("a = 0").first()["converted"] == pytest.approx(5 * 135, abs=20)


def test_split_counts_rows_without_a_label(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 != 0, F.col("id") % 2).alias("y"))
    out = features.stratified_split(df, "y", "id")
    got = {r["y"]: (r["n"], r["t"]) for r in out.groupBy("y").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert got == {None: (100, 20), 0: (400, 80), 1: (500, 100)}
    weights = features.balanced_weights(df, "y")
    assert weights.count() == 1000 and weights.where("y is null").first()["weight"] == pytest.approx(1000 / 300)


def test_split_narrows_until_few_are_ranked(spark):
    df = spark.range(3000).select("id", (F.col("id") % 3).alias("y"))
    plain = {r["id"] for r in features.stratified_split(df, "y", "id").where("is_test").collect()}
    narrow = {r["id"] for r in features.stratified_split(df, "y", "id", digits=1, ranked=5).where("is_test").collect()}
    assert plain == narrow and len(plain) == 600


def test_split_keys_do_not_run_together(spark):
    df = spark.createDataFrame([("a|b", "c", 0), ("a", "b|c", 0), ("a", None, 0), (None, "a", 0)], "k string, j string, y int")
    assert features.stratified_split(df, "y", ["k", "j"], 0.5).where("is_test").count() == 2


def test_a_dictionary_gives_the_features_of_the_model(spark, tmp_path):
    """The same vectors whichever side of the line a column falls on; saved and read again too."""
    values = ["b", "a", "é", "Z", "a'b", " ", "a\\b", None, "a", "b", "b"]
    train = spark.createDataFrame([(i, v, v and v * 2, float(i)) for i, v in enumerate(values * 3)], "k int, c string, d string, x double")
    new = spark.createDataFrame([(100, "nowhere", "bb", 0.0), (101, None, None, None), (102, "é", "ZZ", 5.0)], "k int, c string, d string, x double")
    model = features.fit_features(train, ["x"], ["c", "d"])
    table = features.fit_features(train, ["x"], ["c", "d"], max_categories=0)
    for df in (train, new):
        want, got = model.transform(df), table.transform(df)
        assert {r["k"]: r["features"].toArray().tolist() for r in got.collect()} == {r["k"]: r["features"].toArray().tolist() for r in want.collect()}
        assert got.columns == want.columns and got.schema["features"].metadata["ml_attr"] == {"num_attrs": 15}
    models.save_model(table, str(tmp_path / "m"))
    again = models.load_model(str(tmp_path / "m"))
    assert str(tmp_path) in again.stages[2].getOrDefault("table")
    assert {r["k"]: r["features"] for r in again.transform(new).collect()} == {r["k"]: r["features"] for r in table.transform(new).collect()}


def test_an_empty_category(spark):
    df = spark.createDataFrame([("",), ("b",), ("",), (None,)], "c string")
    out = features.fit_features(df, [], ["c"]).transform(df)
    assert sorted((r["c"] or "", r["features"].toArray().tolist()) for r in out.collect()) == [("", [1.0, 0.0])] * 3 + [("b", [0.0, 1.0])]


def test_300_000_categories(spark):
    """A near-unique column beside a value that half the rows hold."""
    n = 300_000
    df = spark.range(2 * n).select("id", F.when(F.col("id") < n, F.concat(F.lit("v"), F.md5(F.col("id").cast("string")))).otherwise("hot").alias("c"))
    prepare = features.fit_features(df, [], ["c"])
    out = prepare.transform(df).select("id", "c", "c_index", "features")
    assert out.schema["features"].metadata["ml_attr"] == {"num_attrs": n + 1}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 1 and "CartesianProduct" not in plan
    ranked = df.select("c").distinct().toPandas()["c"].sort_values().reset_index(drop=True)
    places = dict(zip(ranked, ranked.index, strict=True))
    got = out.where("id % 1000 = 0 or id in (0, 299999)").collect()
    assert len(got) == 601 and all(r["c_index"] == places[r["c"]] == r["features"].indices[0] for r in got)
    checks = out.agg(F.count("*"), F.countDistinct("c_index"), F.max("c_index"), F.count_if(F.col("c_index") == places["hot"])).first()
    assert tuple(checks) == (2 * n, n + 1, n, n)


def plain_newton(x, y, w, penalty):
    x1 = np.column_stack([np.ones(len(x)), x])
    ridge, beta = np.diag([0.0] + [penalty] * x.shape[1]), np.zeros(x.shape[1] + 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-x1 @ beta))
        beta = beta - np.linalg.solve((x1.T * (w * p * (1 - p))) @ x1 + ridge, x1.T @ (w * (p - y)) + ridge @ beta)
    return beta


def labelled(spark, x, y, w):
    rows = [(Vectors.dense(a), int(b), float(c)) for a, b, c in zip(x.tolist(), y, w, strict=True)]
    return spark.createDataFrame(rows, ["features", "y", "weight"])


def test_newton_finds_the_minimum(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 5)) * [1, 10, 0.1, 1, 1]
    y = (x @ [2, -0.1, 5, 0, 1] + rng.logistic(size=400) > 0.7).astype(int)
    w = rng.uniform(0.2, 3, 400)
    for c in (1.0, 0.01):
        model = models.logistic_regression("y", w.sum(), c=c).fit(labelled(spark, x, y, w))
        want = plain_newton(x, y, w, 1 / c)
        assert isinstance(model, newton.LogisticModel)
        assert [model.intercept, *model.coefficients] == pytest.approx(want.tolist(), rel=1e-7, abs=1e-9)
    slow = models.logistic_regression("y", w.sum(), c=0.01).fallback().fit(labelled(spark, x, y, w))
    assert [slow.intercept, *slow.coefficients] == pytest.approx(want.tolist(), abs=2e-3)


def test_a_sample_only_moves_the_start(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 3))
    y = (x @ [3, -2, 1] + rng.logistic(size=3000) > 0).astype(int)
    passes, plain = [], newton._pass
    monkeypatch.setattr(newton, "_pass", lambda *a: passes.append(1) or plain(*a))
    found, counts = [], []
    for sampled in (0, 1500):
        monkeypatch.setattr(newton, "SAMPLED", sampled)
        model = models.logistic_regression("y", 3000.0).fit(labelled(spark, x, y, np.ones(3000)))
        found.append([model.intercept, *model.coefficients])
        counts.append(len(passes))
        passes.clear()
    assert found[0] == pytest.approx(found[1], rel=1e-6, abs=1e-8) and counts[1] < counts[0]


def test_newton_on_labels_that_a_plane_parts(spark):
    x = np.arange(-20, 20).reshape(-1, 1) + 0.5
    y = (x[:, 0] > 0).astype(int)
    model = models.logistic_regression("y", 40.0).fit(labelled(spark, x, y, np.ones(40)))
    assert [model.intercept, *model.coefficients] == pytest.approx(plain_newton(x, y, np.ones(40), 1.0).tolist(), abs=1e-7)


def test_newton_gives_way(spark):
    """One label only, columns that repeat each other without a penalty, too many features."""
    x = np.column_stack([np.arange(30.0), np.arange(30.0)])
    y = (np.arange(30) % 3 == 0).astype(int)
    one = models.logistic_regression("y", 30.0).fit(labelled(spark, x, np.ones(30, int), np.ones(30)))
    assert not isinstance(one, newton.LogisticModel) and one.transform(labelled(spark, x, y, np.ones(30))).where("prediction = 1").count() == 30
    rows = labelled(spark, x, y, np.ones(30)).select(vector_to_array("features").alias("x"), F.col("y").cast("double").alias("y"), F.col("weight").alias("w"))
    beta = newton.minimise(rows, 2, 0.0)
    assert beta is None or np.isfinite(beta).all()


def test_predictions_and_a_saved_newton_model(spark, tmp_path):
    df = labelled(spark, np.array([[1.0, 0.0], [0.0, 1.0], [2.0, 1.0]]), [1, 0, 1], [1.0, 1.0, 1.0])
    model = PipelineModel([newton.LogisticModel(weights=[1.0, -2.0], bias=0.5)])
    models.save_model(model, str(tmp_path / "m"))
    rows = models.load_model(str(tmp_path / "m")).transform(df).collect()
    assert [r["prediction"] for r in rows] == [1.0, 0.0, 1.0]
    assert [r["probability"] for r in rows] == pytest.approx([1 / (1 + math.exp(-s)) for s in (1.5, -1.5, 0.5)])


def test_forests_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4))
    df = labelled(spark, x, (x[:, 0] * x[:, 1] > 0).astype(int), np.ones(300))
    scores = []
    for parts in (1, 5):
        model = models.random_forest("y", trees=5, depth=4).fit(models.in_fixed_order(df.repartition(parts), "y"))
        scores.append(sorted((tuple(r["features"]), tuple(r["probability"])) for r in model.transform(df).collect()))
    assert scores[0] == scores[1]
