import math
import os

import pytest
from pyspark.sql import functions as F

from tabwright import session
from tabwright.functions import numbers as num
from tabwright.functions.text import follows_policy
from tabwright.operators import clean, groups, numbering, rows


@pytest.fixture(scope="module")
def sales(spark):
    data = [
        (0, "서울", "전자", 1500, "2024-01"), (1, "부산", "의류", 800, "2024-01"), (2, "서울", "의류", 1200, "2024-02"),
        (3, "대구", "전자", 950, "2024-01"), (4, "", "전자", 1500, "2024-05"), (5, "서울", "의류", -500, "2024-05"),
        (6, "   ", "식품", 300, "2024-05"),
    ]
    return spark.createDataFrame(data, "n long, region string, category string, amount long, month string")


def test_sums_keep_blank_keys_apart(sales):
    got = dict(map(tuple, groups.sum_by(sales, "region", "amount").collect()))
    assert got == {"서울": 2200, "부산": 800, "대구": 950, "": 1500, "   ": 300}
    assert dict(map(tuple, groups.key_lookup_sum(sales, "region", "amount").collect())) == got


def test_sum_by_two_keys_in_order(sales):
    got = [tuple(r) for r in groups.sum_by_keys_sorted(sales, ["month", "category"], "amount").collect()]
    assert got == [
        ("2024-01", "의류", 800), ("2024-01", "전자", 2450), ("2024-02", "의류", 1200), ("2024-05", "식품", 300),
        ("2024-05", "의류", -500), ("2024-05", "전자", 1500),
    ]


def test_filters(sales):
    assert rows.filter_ge(sales, "amount", 1000).count() == 3
    assert rows.filter_gt(sales, "amount", 1200).count() == 2


def test_lists_keep_input_order_in_pieces(sales):
    whole = {(r["category"], r["piece"]): r["values"] for r in groups.collect_by(sales, "category", "amount", "n").collect()}
    assert whole == {("전자", 0): [1500, 950, 1500], ("의류", 0): [800, 1200, -500], ("식품", 0): [300]}
    pieces = groups.collect_by(sales, "category", "amount", "n", width=3).orderBy("category", "piece").collect()
    assert max(len(r["values"]) for r in pieces) <= 3
    joined = {}
    for r in pieces:
        joined.setdefault(r["category"], []).extend(r["values"])
    assert joined == {k: v for (k, _), v in whole.items()}


def test_frequency_ties(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "c"), (3, "c")], "n int, x string")
    assert [r["x"] for r in groups.frequency_rank(df, "x").collect()] == ["c", "a", "b"]
    assert [r["x"] for r in groups.frequency_rank(df, "x", "n").collect()] == ["c", "b", "a"]


def test_mode_takes_the_smallest_tie_and_skips_missing(spark):
    df = spark.createDataFrame([("b", 2.0), ("a", 10.0), (None, None), (None, 10.0), (None, 2.0)], "s string, x double")
    assert tuple(groups.modes(df, ["s", "x"]).first()) == ("a", 2.0)
    assert tuple(groups.modes(df.where("false"), ["s", "x"]).first()) == (None, None)


def test_number_text(spark):
    texts = ["Less than 1 year", " 7.5 ", "1e3", "", "7d", "NaN", "inf", "-.5", None, "1_000", "٣"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(num.parse_number("t"))
    assert [r[0] for r in df.collect()] == [None, 7.5, 1000.0, None, None, None, math.inf, -0.5, None, None, None]


def test_clip_and_rounding(spark):
    df = spark.createDataFrame([(-1.0,), (2.5,), (3.5,), (99.0,), (None,), (math.nan,)], "x double")
    assert [r[0] for r in df.select(num.clip("x", 0, 10)).collect()] == [0.0, 2.5, 3.5, 10.0, None, None]
    assert [r[0] for r in df.select(num.round_half_even("x")).collect()[1:3]] == [2.0, 4.0]


def test_formats(spark):
    row = spark.range(1).select(
        num.money(F.lit(75031.3)), num.fixed(F.lit(-11.46573)), num.scientific(F.lit(2.5099e-30)),
        num.percent(F.lit(0.863706)), num.one_line(F.lit("a\nb")), num.safe_ratio(F.lit(1.0), F.lit(0.0)),
    ).first()
    assert tuple(row) == ("75,031.30", "-11.4657", "2.5099e-30", "86.37%", "a b", 1.0)


def test_text_policy(spark):
    cases = {"aA1!": True, "aA1": False, "": False, "aA1\n!": False, "aA1!\n": True, "a\rA1!": True, "aA1!\n\n": False, "aA٣!": True, "가A1!": False}
    df = spark.createDataFrame([(t,) for t in cases], "t string").select("t", follows_policy("t"))
    assert dict(map(tuple, df.collect())) == cases


def test_missing_never_passes_a_range(spark):
    df = spark.createDataFrame([(1.0,), (math.nan,), (None,), (5.0,)], "x double")
    assert [r[0] for r in rows.filter_range(df, "x", 1, 1e9).collect()] == [1.0, 5.0]
    assert rows.drop_duplicates(df.union(df)).count() == 4


def test_status_is_derived_before_the_answer_is_filled(spark):
    data = [(i, "Yes", float(i), 5.0) for i in range(100)] + [(100, None, 50.0, None)]
    df = spark.createDataFrame(data, "id int, answer string, pay double, score double")
    out = clean.clean_survey(df.union(df), "answer", "pay", ["answer", "absent"], "score", status="status")
    row = out.where("id = 100").first()
    assert (row["answer"], row["status"], row["score"]) == ("Yes", "No", 5.0)
    assert out.count() == 99 and out.where("pay < 1 or pay > 98").count() == 0


def test_trim_drops_missing(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,), (math.nan,)], "x double")
    assert clean.percentile_trim(df, "x").agg(F.min("x"), F.max("x"), F.count("x")).first() == (1.0, 99.0, 99)
    assert clean.impute_median(df, "x").where("x = 50").count() == 3


def test_row_position_over_gaps_and_negative_keys(spark):
    keys = [-7, -1, 0, 3, 4, 250, 10**12]
    df = spark.createDataFrame([(k,) for k in reversed(keys)], "k long")
    got = numbering.row_position(df, "k").orderBy("k").collect()
    assert [tuple(r) for r in got] == [(k, i) for i, k in enumerate(keys)]


def test_scalar_attach_refuses_two_rows(spark, sales):
    one = sales.agg(F.max("amount").alias("top"))
    assert rows.attach_scalar(sales, one).where("top = 1500").count() == 7
    with pytest.raises(Exception, match="(?i)more than one row"):
        rows.attach_scalar(sales, sales.select(F.col("amount").alias("top"))).collect()


def test_argmax_first_of_equals_and_none_at_zero(spark):
    df = spark.createDataFrame([(0, "a", 0.5), (1, "b", 0.9), (2, "c", 0.9)], "n int, m string, s double")
    assert rows.argmax(df, "s", "n").first()["m"] == "b"
    assert rows.argmax(df.withColumn("s", F.lit(0.0)), "s", "n").count() == 0


def test_shapes(spark, sales):
    got = groups.shapes({"read": sales, "big": rows.filter_ge(sales, "amount", 1000)}).orderBy("step_no").collect()
    assert [tuple(r) for r in got] == [(0, "read", 7, 5, 0), (1, "big", 3, 5, 4)]


def test_labels_and_ranges(spark):
    df = spark.createDataFrame([("Republic of Korea", 10_000.0), ("France", 10_001.0), (None, 500_000.0)], "c string, x double")
    merged = clean.normalise_label(df, "c", {"Republic of Korea": "South Korea"})
    assert [r["c"] for r in merged.collect()] == ["South Korea", "France", None]
    assert [r["k"] for r in clean.group_flag(merged, "c", "South Korea", "k").collect()] == [1, 0, 0]
    assert clean.range_clean(df, "x").count() == 1


def test_missing_is_last_never_passes_and_is_no_mode(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 2.0), (4, 5.0), (5, float("nan"))], "k long, x double")
    assert [r["k"] for r in rows.sort_rows(df, ["x"], descending=True, tiebreak=["k"]).collect()] == [4, 3, 1, 2, 5]
    assert [r["k"] for r in rows.filter_ge(df, "x", 1).collect()] == [3, 4] and rows.argmax(df, "x", "k").first()["k"] == 4
    assert groups.modes(df, ["x"]).first()["x"] == 2.0
    assert [r["x"] for r in clean.impute_mode(df, ["x"]).orderBy("k").collect()] == [2.0, 2.0, 2.0, 5.0, 2.0]
    ratios = df.select(num.safe_ratio("x", F.lit(0.0)).alias("z"), num.safe_ratio(F.lit(1.0), "x").alias("r")).where("k = 2").first()
    assert ratios["z"] is None and ratios["r"] is None


def test_scratch_is_released(spark, monkeypatch):
    kept = session.materialise(spark.range(3))
    monkeypatch.setattr(session, "_WRITTEN", {})
    gone = session.materialise(spark.range(3))
    folder = gone.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert os.path.isdir(folder) and session.release_scratch(spark) == 1
    assert not os.path.exists(folder) and kept.count() == 3


def test_file_positions_are_of_the_whole_table(spark, tmp_path):
    spark.range(90).repartition(3).write.parquet(str(tmp_path / "t"))
    placed = numbering.file_position(spark.read.parquet(str(tmp_path / "t")))
    assert sorted(r["position"] for r in placed.collect()) == list(range(90)) and placed.columns == ["id", "position"]
