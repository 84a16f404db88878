import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabwright.operators import quantiles as q
from tabwright.operators.quantiles import median_point, quantile_row, quantiles


def frame(spark, xs, **extra):
    return spark.createDataFrame(pd.DataFrame({"x": np.array(xs, dtype="float64"), **extra}))


def as_dict(df):
    return {r["q"]: r["value"] for r in df.collect()}


def test_known_values(spark):
    df = frame(spark, [1, 2.5, 4, 7, 11])
    got = as_dict(quantiles(df, ["x"], [0.01, 0.25, 0.5]))
    assert got[0.01] == pytest.approx(1.06)
    assert got[0.25] == 2.5 and got[0.5] == 4


@pytest.mark.parametrize("xs", [[3.0], [1.0, 2.0], [5.0] * 40, [1.0, 2.0, 3.0, 10.0]])
def test_tiny_inputs(spark, xs):
    got = as_dict(quantiles(frame(spark, xs), ["x"], [0.0, 0.5, 1.0]))
    assert got == {q: pytest.approx(float(np.quantile(xs, q))) for q in (0.0, 0.5, 1.0)}


def test_missing_is_skipped_and_empty_is_null(spark):
    df = frame(spark, [1.0, math.nan, 3.0, math.nan])
    assert as_dict(quantiles(df, ["x"], [0.5])) == {0.5: 2.0}
    assert quantile_row(df.where("false"), "x", {"m": 0.5}).first()["m"] is None
    assert spark.range(1).select(median_point(df, "x").alias("m")).first()["m"] == 2.0


def test_extreme_and_infinite_values(spark):
    xs = [-1.7e308, 1.7e308, 0.0, -0.0, math.inf, -math.inf, 5e-324, 1.0, 2.0]
    got = as_dict(quantiles(frame(spark, xs), ["x"], [0.0, 0.5, 1.0]))
    assert got == {0.0: -math.inf, 0.5: 5e-324, 1.0: math.inf}


def test_one_group_with_most_rows(spark):
    rng = np.random.default_rng(7)
    xs = rng.lognormal(3, 3, 3000)
    g = np.where(np.arange(3000) % 3 < 2, "hot", rng.integers(0, 9, 3000).astype(str))
    pdf = pd.DataFrame({"x": xs, "g": g})
    want = pdf.groupby("g").x.quantile([0.01, 0.5, 0.99])
    got = quantiles(spark.createDataFrame(pdf), ["x"], [0.01, 0.5, 0.99], by=["g"]).collect()
    assert len(got) == len(want)
    for r in got:
        assert r["value"] == pytest.approx(want[r["g"], r["q"]], rel=1e-12)


def test_null_groups(spark):
    pdf = pd.DataFrame({"g": [1, 1, 1, 2, 2, None], "x": [1.0, 5.0, 2.0, 8.0, 9.0, 4.0]})
    df = spark.createDataFrame(pdf).withColumn("g", F.nanvl("g", F.lit(None)).cast("int"))
    got = {r["g"]: r["value"] for r in quantiles(df, ["x"], [0.5], by=["g"]).collect()}
    assert got == {1: 2.0, 2: 8.5, None: 4.0}


def test_several_columns_in_one_call(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 3.0], "b": [10.0, math.nan, 30.0]})
    got = {(r["variable"], r["q"]): r["value"] for r in quantiles(spark.createDataFrame(pdf), ["a", "b"], [0.25, 0.5]).collect()}
    assert got == {("a", 0.25): 1.5, ("a", 0.5): 2.0, ("b", 0.25): 15.0, ("b", 0.5): 20.0}


SHAPES = {
    "log-uniform": lambda rng: 10 ** rng.uniform(-300, 300, 40_000),
    "one value": lambda rng: np.full(20_000, 7.0),
    "two values": lambda rng: np.where(np.arange(20_001) % 2 == 0, 1.0, 2.0),
    "far outliers": lambda rng: np.concatenate([rng.normal(0, 1, 30_000), [1e300, -1e300, math.inf]]),
    "a hot value": lambda rng: np.where(rng.random(30_000) < 0.4, 5.0, rng.normal(5, 2, 30_000)),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_few_values_are_ranked_whatever_the_shape(spark, monkeypatch, shape):
    xs = SHAPES[shape](np.random.default_rng(5))
    seen = []
    ranked = q._ranked
    monkeypatch.setattr(q, "_ranked", lambda counted, *a: seen.append(counted.count()) or ranked(counted, *a))
    qs = [0.0, 0.01, 0.5, 0.75, 1.0]
    got = as_dict(quantiles(frame(spark, xs), ["x"], qs))
    assert got == {k: pytest.approx(float(np.sort(xs)[[math.floor(k * (len(xs) - 1)), math.ceil(k * (len(xs) - 1))]].mean() if k in (0.0, 1.0) else np.quantile(xs, k)), rel=1e-12) for k in qs}
    assert len(seen) == 1 and seen[0] <= 0.02 * len(xs) + 10


@pytest.mark.parametrize("by", [(), ("g",)])
def test_many_values_are_narrowed_before_they_are_ranked(spark, by):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"x": rng.normal(0, 1, 30_000), "g": rng.integers(0, 2, 30_000)})
    got = quantiles(spark.createDataFrame(pdf), ["x"], [0.25, 0.5], by=by, ranked=60).collect()
    for r in got:
        own = pdf.x if not by else pdf.x[pdf.g == r["g"]]
        assert r["value"] == pytest.approx(np.quantile(own, r["q"]), rel=1e-12)
    assert len(got) == (4 if by else 2)


def test_refuses_bad_arguments(spark):
    with pytest.raises(ValueError):
        quantiles(frame(spark, [1.0]), ["x"], [1.5])
    with pytest.raises(ValueError):
        quantiles(frame(spark, [1.0]), ["x"], [0.5], method="other")


def test_sketch_is_close(spark):
    df = spark.range(100_001).select(F.col("id").cast("double").alias("x"))
    assert as_dict(quantiles(df, ["x"], [0.5], method="approx"))[0.5] == pytest.approx(50_000, abs=50)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(xs=st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60), q=st.sampled_from([0.0, 0.1, 0.5, 0.9, 1.0]))
def test_agrees_with_linear_interpolation(spark, xs, q):
    got = as_dict(quantiles(frame(spark, xs), ["x"], [q]))[q]
    assert got == pytest.approx(float(np.quantile(xs, q)), rel=1e-9, abs=1e-9)
