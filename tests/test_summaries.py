"""Kept summaries: merged they are those of the whole, and only new parts are read for them."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabwright.operators import quantiles as q
from tabwright.operators import summaries
from tabwright.session import scratch_path


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(7)
    n = 9000
    pdf = pd.DataFrame({"part": [f"{i % 7:03}" for i in range(n)], "g": rng.choice(["a", "b", None], n), "x": 1e9 + rng.lognormal(size=n), "y": rng.normal(size=n)})
    pdf.loc[pdf.index % 11 == 0, "y"] = np.nan
    return spark.createDataFrame(pdf).withColumn("z", F.lit(None).cast("double")), pdf


def check(rows, pdf, cols):
    assert sorted(r["variable"] for r in rows) == sorted(cols)
    for r in rows:
        x = pdf[r["variable"]].dropna()
        assert r["count"] == len(x) and r["min"] == x.min() and r["max"] == x.max()
        assert [r["q25"], r["q50"], r["q75"]] == pytest.approx(np.quantile(x, [0.25, 0.5, 0.75]), rel=1e-15)
        assert r["mean"] == pytest.approx(x.mean(), rel=1e-12) and r["std"] == pytest.approx(x.std(), rel=1e-6)


def test_merged_parts_are_the_whole(spark, table):
    df, pdf = table
    store = summaries.SummaryStore(spark, scratch_path(spark, "store"), ["x", "y", "z"])
    assert store.rows() is None
    store.add_all(df.where("part < '005'"), "part")
    store.add("005", df.where("part = '005'"))
    store.add("006", df.where("part = '001'"))
    store.add("006", df.where("part = '006'"))  # added again, it replaces its rows
    check(summaries.describe_summaries(df, store.merged(), ["x", "y"]).collect(), pdf, ["x", "y"])
    some = pdf[(pdf.part >= "002") & (pdf.part <= "004")]
    part = df.where("part between '002' and '004'")
    check(summaries.describe_summaries(part, store.merged("002", "004"), ["y"]).collect(), some, ["y"])
    assert sorted({r["part"] for r in store.rows().collect()}) == [f"{i:03}" for i in range(7)]


def test_groups_and_sketched_quartiles(spark, table):
    df, pdf = table
    store = summaries.SummaryStore(spark, scratch_path(spark, "store"), ["y"], by=["g"])
    store.add_all(df, "part")
    rows = summaries.describe_summaries(df, store.merged(), ["y"], by=["g"]).collect()
    assert len(rows) == 3
    for r in rows:
        check([r], pdf[pdf.g.isna() if r["g"] is None else pdf.g == r["g"]], ["y"])
    near = summaries.describe_summaries(df, summaries.summarise(df, ["x"]), ["x"], method="sketch").first()
    ranks = [(pdf.x <= near[k]).mean() for k in ("q25", "q50", "q75")]
    assert ranks == pytest.approx([0.25, 0.5, 0.75], abs=0.002)


def test_the_first_scan_is_spared(spark, table, monkeypatch):
    df, pdf = table
    kept = summaries.merged(summaries.summarise(df, ["x"], by=["part"]))
    monkeypatch.setattr(q, "sketched", lambda *a: pytest.fail("sketched again"))
    check(summaries.describe_summaries(df, kept, ["x"]).collect(), pdf, ["x"])
    with pytest.raises(ValueError, match="not of these rows"):
        summaries.describe_summaries(df, summaries.summarise(df.where("x > 1e9 + 1"), ["x"]), ["x"])


def test_empty(spark, table):
    df, _ = table
    none = df.limit(0)
    (row,) = summaries.describe_summaries(none, summaries.summarise(none, ["x"]), ["x"]).collect()
    assert tuple(row) == ("x", 0, None, None, None, None, None, None, None)
    assert summaries.merged(summaries.summarise(none, ["x"])).count() == 0
    with pytest.raises(ValueError, match="no summaries"):
        summaries.SummaryStore(spark, scratch_path(spark, "store"), ["x"]).merged()
