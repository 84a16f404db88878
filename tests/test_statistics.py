import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabwright.functions.tails import two_sided_t, upper_f
from tabwright.operators import hypothesis, summary
from tabwright.sources.synthetic import survey_of_size


def groups(spark, a, b):
    rows = [(g, None if x is None else float(x)) for g, xs in (("a", a), ("b", b)) for x in xs]
    return spark.createDataFrame(rows, "g string, x double")


def test_tail_constants(spark):
    row = spark.range(1).select(
        two_sided_t(F.lit(2.228138852), F.lit(10.0)).alias("t"),
        two_sided_t(F.lit(None).cast("double"), F.lit(10.0)).alias("n"),
        upper_f(F.lit(4.1028210151), F.lit(2), F.lit(10)).alias("f"),
    )
    got = row.first()
    assert got["t"] == pytest.approx(0.05, abs=1e-9)
    assert got["n"] is None
    assert got["f"] == pytest.approx(0.05, abs=1e-9)


def test_welch_by_hand(spark):
    a, b = [27.5, 21.0, 19.0, 23.6, 17.0, 17.9], [27.1, 22.0, 20.8, 23.4, 23.4, 23.5, 25.8, 22.0]
    got = hypothesis.welch_t_test(groups(spark, [*a, math.nan], [*b, None]), "g", "x", "a", "b").first()
    va, vb = np.var(a, ddof=1) / len(a), np.var(b, ddof=1) / len(b)
    assert (got["n_a"], got["n_b"]) == (6, 8)
    assert got["t"] == pytest.approx((np.mean(a) - np.mean(b)) / math.sqrt(va + vb))
    assert got["dof"] == pytest.approx((va + vb) ** 2 / (va**2 / 5 + vb**2 / 7))
    assert 0 < got["p"] < 1


@pytest.mark.parametrize(
    ("a", "b"), [([], [1.0, 2.0]), ([1.0], [1.0, 2.0]), ([1.0, 2.0], [3.0]), ([2.0, 2.0], [5.0, 5.0, 5.0])]
)
def test_welch_without_enough_to_go_on(spark, a, b):
    got = hypothesis.interpret_test(hypothesis.welch_t_test(groups(spark, a, b), "g", "x", "a", "b")).first()
    assert (got["t"], got["p"], got["verdict"]) == (0.0, 1.0, "not_significant")


def test_welch_with_one_flat_group(spark):
    got = hypothesis.welch_t_test(groups(spark, [2.0, 2.0], [5.0, 6.0, 7.0]), "g", "x", "a", "b").first()
    assert got["t"] == pytest.approx(-4 / math.sqrt(1 / 3)) and got["p"] < 0.05


def test_three_verdicts(spark):
    df = spark.createDataFrame([(3.0, 0.01), (-3.0, 0.01), (3.0, 0.05)], "t double, p double")
    assert [r["verdict"] for r in hypothesis.interpret_test(df).collect()] == ["higher", "lower", "not_significant"]


def test_planted_effect_is_found(spark):
    from tabwright.operators.clean import clean_survey

    df = survey_of_size(spark, 1200)
    assert df.count() == 1225
    cleaned = clean_survey(df, "AISelect", "ConvertedCompYearly", ["AISelect", "RemoteWork", "EdLevel"], "JobSat")
    assert 1000 < cleaned.count() < 1150
    tests = hypothesis.interpret_test(
        hypothesis.welch_t_test(cleaned, "AI_Status", ["ConvertedCompYearly", "JobSat"], "Yes", "No")
    )
    assert {r["measure"]: r["verdict"] for r in tests.collect()} == {"ConvertedCompYearly": "higher", "JobSat": "higher"}


def test_survey_rows_do_not_depend_on_partitions(spark):
    from tabwright.sources.synthetic import synthetic_survey

    one = synthetic_survey(spark.range(0, 300, 1, 1), "id").orderBy("id").collect()
    many = synthetic_survey(spark.range(0, 300, 1, 7), "id").orderBy("id").collect()
    assert one == many


def test_describe_agrees_with_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"a": rng.normal(5, 2, 200), "b": rng.integers(0, 9, 200).astype(float)})
    pdf.loc[::7, "a"] = np.nan
    got = {r["variable"]: r for r in summary.describe(spark.createDataFrame(pdf)).collect()}
    want = pdf.describe()
    for c in pdf:
        for ours, theirs in [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")]:
            assert got[c][ours] == pytest.approx(want[c][theirs])


def test_correlation_agrees_with_pandas(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(size=(100, 3)), columns=list("abc"))
    pdf["b"] += pdf["a"]
    pdf.loc[::5, "a"] = np.nan
    pdf.loc[::3, "c"] = np.nan
    pdf["flat"], pdf["gone"] = 3.0, np.nan
    want = pdf.corr()
    for r in summary.corr_matrix(spark.createDataFrame(pdf), list(pdf)).collect():
        expected = want.loc[r["var1"], r["var2"]]
        if np.isnan(expected):
            assert r["r"] is None
        else:
            assert r["r"] == pytest.approx(expected)


def test_box(spark):
    df = groups(spark, [1, 2, 3, 4, 5, 100, math.nan], [7.0])
    got = {r["g"]: r for r in summary.box_summary(df, "g", "x").collect()}
    a = got["a"]
    assert (a["n"], a["whisker_low"], a["whisker_high"], a["outliers"]) == (6, 1.0, 5.0, 1)
    assert (a["q25"], a["q50"], a["q75"]) == (2.25, 3.5, 4.75)
    assert got["b"]["whisker_low"] == got["b"]["whisker_high"] == 7.0
    assert [tuple(r) for r in summary.box_points(df, "g", "x").collect()] == [("a", 100.0)]


def test_anova_and_levene_by_hand(spark):
    data = {"a": [6, 8, 4, 5, 3, 4], "b": [8, 12, 9, 11, 6, 8], "c": [13, 9, 11, 8, 7, 12]}
    df = spark.createDataFrame([(g, float(x)) for g, xs in data.items() for x in xs], "g string, x double")
    got = hypothesis.anova_oneway(df, "g", "x").first()
    assert (got["k"], got["n"], got["ss_between"], got["ss_within"]) == (3, 18, pytest.approx(84), pytest.approx(68))
    assert got["f"] == pytest.approx(9.264705882) and got["p"] == pytest.approx(0.0023987773, rel=1e-6)
    spread = [(g, abs(x - float(np.median(xs)))) for g, xs in data.items() for x in xs]
    want = hypothesis.anova_oneway(spark.createDataFrame(spread, "g string, x double"), "g", "x").first()
    assert hypothesis.levene_test(df, "g", "x").first()["f"] == pytest.approx(want["f"])


def test_pearson(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (3.0, 4.0), (4.0, 3.0), (None, 9.0)], "a double, b double")
    got = hypothesis.pearson_test(df, "a", "b").first()
    assert (got["n"], got["r"], got["t"]) == (4, pytest.approx(0.6), pytest.approx(0.6 * math.sqrt(2 / 0.64)))
    assert got["p"] == pytest.approx(0.4)
    line = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (4.0, 8.0)], "a double, b double")
    assert hypothesis.pearson_test(line, "a", "b").first()["p"] == pytest.approx(0.0, abs=1e-6)


def test_correlation_of_many_columns_with_gaps(spark):
    rng = np.random.default_rng(4)
    n, p = 600, 200
    data = rng.normal(size=(n, 20)) @ rng.normal(size=(20, p)) + rng.normal(size=(n, p)) + rng.integers(0, 1000, p) * 1e3
    data[rng.random((n, p)) < 0.1] = np.nan
    data[:, 3], data[:, 4] = 5.0, np.nan
    data[:, 5] = np.where(np.arange(n) < 300, 7e8, np.nan)
    data[:, 6] = np.where(np.arange(n) < 300, data[:, 6], np.nan)
    data[300:, 7], data[:300, 7] = np.arange(300), 0.1  # constant where columns 5 and 6 are present, not elsewhere
    pdf = pd.DataFrame(data, columns=[f"c{i}" for i in range(p)])
    want = pdf.corr().to_numpy()
    want[7, 5:7] = want[5:7, 7] = np.nan
    got = np.full((p, p), np.nan)
    for r in summary.corr_matrix(spark.createDataFrame(pdf).repartition(6), list(pdf)).collect():
        got[int(r["var1"][1:]), int(r["var2"][1:])] = np.nan if r["r"] is None else r["r"]
    want[[3, 4, 5]] = want[:, [3, 4, 5]] = np.nan
    assert np.allclose(got, want, rtol=0, atol=1e-9, equal_nan=True) and np.isfinite(got).sum() > 38_000


def test_correlation_of_nothing(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert [tuple(r) for r in summary.corr_matrix(df, ["a", "b"]).collect()] == [("a", "a", None), ("a", "b", None), ("b", "a", None), ("b", "b", None)]
    one = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert {r["r"] for r in summary.corr_matrix(one, ["a", "b"]).collect()} == {None}
