"""Tables that grow by landings: running totals, joint publication, repeats, differences, and samples."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tabwright.operators import clean, differences, seen
from tabwright.operators.validate import Contract, Field, check
from tabwright.session import scratch_path
from tabwright.sources.publish import Publication
from tabwright.streaming import totals


def land(spark, base, rows):
    spark.createDataFrame(rows, "ts timestamp, k string, x double").coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema("ts timestamp, k string, x double").parquet(f"{base}/in")
    query = totals.start_totals(totals.period_totals(stream, "ts", ["k"], "x", "1 hour", "2 hours"), f"{base}/out", f"{base}/checkpoint")
    query.awaitTermination()
    return query


def total(spark, base):
    return {(r["period"].hour, r["k"]): (r["n"], r["total"]) for r in totals.read_totals(spark, f"{base}/out", ["k"]).collect()}


def test_totals_are_brought_up_to_date_and_old_periods_closed(spark):
    base = scratch_path(spark, "t")
    at = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    land(spark, base, [(at(1), "a", 1.0), (at(1, 5), "a", 2.0), (at(1), "b", 4.0), (None, "a", 9.0)])
    assert total(spark, base) == {(1, "a"): (2, 3.0), (1, "b"): (1, 4.0)}
    land(spark, base, [(at(2), "a", 5.0), (at(1, 59), "a", 6.0)])
    assert total(spark, base) == {(1, "a"): (3, 9.0), (1, "b"): (1, 4.0), (2, "a"): (1, 5.0)}
    land(spark, base, [(at(9), "c", 1.0)])
    land(spark, base, [(at(9, 10), "c", 1.0)])
    query = land(spark, base, [(at(1), "a", 100.0), (at(9, 30), "c", 1.0)])  # hour 1 is closed
    assert total(spark, base)[1, "a"] == (3, 9.0) and total(spark, base)[9, "c"] == (3, 3.0)
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 1  # only the open hour is held


def test_a_repeated_batch_changes_nothing(spark):
    base = scratch_path(spark, "t")
    land(spark, base, [(dt.datetime(2024, 1, 1), "a", 1.0)])
    first = spark.read.parquet(f"{base}/out").where("n is not null")
    batch = first.agg(F.max("batch")).first()[0]
    rows = first.where(F.col("batch") == batch).drop("batch").toPandas()
    spark.createDataFrame(rows).write.mode("overwrite").parquet(f"{base}/out/batch={batch:010d}")
    assert total(spark, base) == {(0, "a"): (1, 1.0)}


def checked(spark, rows):
    return check(spark.createDataFrame(rows, "id long, name string"), Contract((Field("id", "integer"), Field("name", min_length=1))))


def test_tables_appear_together(spark):
    shelf = Publication(spark, scratch_path(spark, "p"))
    with pytest.raises(ValueError, match="nothing is published"):
        shelf.read("a")
    good, other, bad = checked(spark, [(1, "x"), (2, "y")]), checked(spark, [(3, "z")]), checked(spark, [(4, "")])

    def killed(name):
        if name == "b":
            raise InterruptedError

    with pytest.raises(InterruptedError):
        shelf.publish_checked("one", {"a": good, "b": other}, written=killed)
    with pytest.raises(ValueError, match="nothing is published"):
        shelf.read("a")
    assert shelf.publish_checked("one", {"a": good, "b": other}) and not shelf.publish_checked("one", {"a": other, "b": good})
    assert shelf.publish_checked("two 2/é", {"a": good, "b": bad})
    assert sorted(tuple(r) for r in shelf.read("a").collect()) == [(1, "x", "one"), (2, "y", "one")]
    assert [tuple(r) for r in shelf.read("b").collect()] == [(3, "z", "one")]
    assert [(r["feed"], r["batch"]) for r in shelf.read("rejected").collect()] == [("b", "two 2/é")]
    assert sorted(shelf.entry("one")) == ["a", "b", "rejected"] and shelf.entry("three") is None
    with pytest.raises(ValueError, match="no table"):
        shelf.read("c")


def test_repeats_across_landings(spark):
    rng = random.Random(1)
    kept, whole, compared = seen.SeenRows(spark, scratch_path(spark, "s")), set(), []
    draw = lambda n, top: [(rng.randint(0, top), rng.choice(["x", None]), rng.choice([0.5, None])) for _ in range(n)]
    assert kept.rows() is None
    for k, rows in enumerate([draw(300, 100), draw(300, 200), [(i, "new", None) for i in range(1000, 1400)]]):
        df = spark.createDataFrame(rows, "a int, b string, c double")
        compared.append(kept.add(f"l{k}", df))
        whole |= set(rows)
        assert sorted(map(tuple, kept.rows().collect()), key=repr) == sorted(whole, key=repr)
    assert compared[0] == 0 and 0 < compared[1] <= 300 and compared[2] == 0  # new rows are not compared
    files = set(kept.rows().inputFiles())
    kept.add("l3", df)
    assert kept.add("l2", df) == 0 and files >= {f for f in kept.rows().inputFiles() if "l2" not in f}
    assert sorted(map(tuple, kept.rows().collect()), key=repr) == sorted(whole, key=repr)


def test_a_shared_bit_loses_no_row(spark, monkeypatch):
    monkeypatch.setattr(seen, "BITS", 4)
    kept = seen.SeenRows(spark, scratch_path(spark, "s"))
    kept.add("a", spark.range(40))
    assert kept.add("b", spark.range(20, 80)) == 60 and sorted(r["id"] for r in kept.rows().collect()) == list(range(80))


def test_differences(spark):
    left = spark.range(20_000).select("id", (F.col("id") % 7).alias("x"), F.when(F.col("id") % 5 > 0, F.lit("s")).alias("y"))
    right = left.where("id <> 11").union(spark.createDataFrame([(-1, 1, "n")], "id long, x long, y string"))
    right = right.withColumns({"x": F.when(F.col("id") == 500, -1).otherwise(F.col("x")), "y": F.when(F.col("id").isin(500, 700), F.lit(None)).otherwise(F.col("y"))})
    right = right.withColumn("y", F.when(F.col("id") == 703, "t").otherwise(F.col("y")))
    seen_rows = []
    got = differences.differing_rows(left, right.select("y", "id", "x"), ["id"], compared=lambda *s: seen_rows.extend(x.count() for x in s))
    want = {(11, "removed", None), (-1, "added", None), (500, "changed", ("x",)), (703, "changed", ("y",))}
    assert {(r["id"], r["status"], r["columns"] and tuple(r["columns"])) for r in got.collect()} == want
    assert all(n < 40 for n in seen_rows)  # of 20,000 rows a side
    assert differences.differing_rows(left, left.repartition(3), ["id"]).count() == 0


def test_differences_of_repeated_and_missing_keys(spark):
    left = spark.createDataFrame([(None, 1), (1, 1), (1, 2), (2, 5)], "k int, x int")
    right = spark.createDataFrame([(None, 2), (1, 2), (1, 1), (2, 5), (2, 5)], "k int, x int")
    got = {(r["k"], r["status"]) for r in differences.differing_rows(left, right, ["k"]).collect()}
    assert got == {(None, "changed"), (2, "changed")}
    assert differences.differing_rows(left.limit(0), right, ["k"]).count() == 3
    with pytest.raises(ValueError, match="different columns"):
        differences.differing_rows(left, right.drop("x"), ["k"])


def test_scatter_sample_is_of_the_whole(spark):
    df = spark.range(30_000).select("id", (F.col("id") % 50).cast("string").alias("x"), F.rand(1).alias("y"), F.when(F.col("id") % 100 == 0, "rare").when(F.col("id") % 3 > 0, "often").alias("g"))
    whole = sorted(r["id"] for r in clean.scatter_sample(df, "x", "y", "g", "id", 40).collect())
    assert len(whole) == 120
    halves = [clean.scatter_sample(df.where(F.col("id") % 2 == h), "x", "y", "g", "id", 40) for h in (0, 1)]
    merged = halves[0].union(halves[1]).withColumnRenamed("x_Num", "x")
    assert sorted(r["id"] for r in clean.scatter_sample(merged.withColumn("x", F.col("x").cast("string")), "x", "y", "g", "id", 40).collect()) == whole
    assert clean.scatter_sample(df.where("id < 5"), "x", "y", "g", "id", 40).count() == 5 and clean.scatter_sample(df.limit(0), "x", "y", "g", "id", 4).count() == 0
