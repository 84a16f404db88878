"""The most frequent values of columns, exact, from summaries of bounded size.

Columns of few values are counted, value by value: tasks send a row for each. Counting every value of a near-unique
column would shuffle the column, so there each task keeps a frequent-items sketch of at most ``TRACKED`` values, and the
merged sketch only proposes candidates. A second pass counts the candidates
exactly, and all other values together by the bucket of their hash. A bucket's rows bound the count of every value in
it, so a bucket with fewer rows than the last wanted candidate holds no winner: that is the proof. Values of the
buckets that are left, none where some value stands out, are counted one by one.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.numbers import missing_as_null

TRACKED = 4_096  # values in a sketch
BUCKETS = 4_096  # buckets of the other values
LISTED = 64  # candidates of a column, more if more values are asked for
FEW = 1_000  # columns of about so many values are counted at once
#: Kinds without a sketch: each of their values is counted.
_BARE = (T.BinaryType, T.ArrayType, T.StructType, T.NullType, T.VariantType)


def _value(df: DataFrame, c: str) -> Column:
    """The column with NaN as missing and one zero."""
    fractional = isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))
    return (missing_as_null(df, c) + F.lit(0.0)).cast(df.schema[c].dataType) if fractional else F.col(c)


def _best(counts: list[tuple[Any, int]], k: int) -> list[tuple[Any, int]]:
    return sorted(sorted(counts), key=lambda x: -x[1])[:k]


def _counted_one_by_one(cells: DataFrame, k: int) -> list[tuple[Any, int]]:
    """The ``k`` most frequent of the given values, each counted."""
    counted = cells.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    return [(r["x"], r["n"]) for r in counted.orderBy(F.desc("n"), "x").limit(k).collect()]


def frequent_values(df: DataFrame, cols: Sequence[str], k: int = 1) -> dict[str, list[tuple[Any, int]]]:
    """For each column its ``k`` most frequent values and their counts, smaller values first among ties, missing skipped.

    Computed now. At most ``k`` values a column, candidates and bucket counts reach the driver, and no task sends more
    than ``LISTED`` + ``BUCKETS`` rows a column, unless so many values are as frequent as the winners that they have to
    be counted to tell them apart.
    """
    cols = list(dict.fromkeys(cols))
    clean = df.select(*[_value(df, c).alias(c) for c in cols])
    plain = [c for c in cols if not isinstance(df.schema[c].dataType, _BARE)]
    distinct = clean.agg(*[F.approx_count_distinct(F.col(c)).alias(c) for c in plain]).first().asDict() if plain else {}
    few = [c for c in cols if distinct.get(c, 0) <= FEW]
    out = {c: _counted_one_by_one(clean.where(F.col(c).isNotNull()).select(F.col(c).alias("x")), k) for c in few}
    open_ = [c for c in cols if c not in out]
    if not open_:
        return out
    listed = max(LISTED, 2 * k)
    tracked = max(TRACKED, 4 * listed)
    names = {c: "`" + c.replace("`", "``") + "`" for c in open_}
    sketches = [F.expr(f"approx_top_k({names[c]}, {listed}, {tracked}) FILTER (WHERE {names[c]} IS NOT NULL)").alias(f"s{i}") for i, c in enumerate(open_)]
    sketched = clean.agg(*sketches).first()
    candidates = {c: [x["item"] for x in sketched[f"s{i}"] or ()] for i, c in enumerate(open_)}
    kinds = T.StructType([T.StructField(c, T.ArrayType(df.schema[c].dataType)) for c in open_])
    held = df.sparkSession.createDataFrame([tuple(candidates[c] for c in open_)], kinds)
    cells = []
    for i, c in enumerate(open_):
        place = F.array_position(held.select(names[c]).scalar(), F.col(names[c]))  # 0 for a value that is no candidate
        bucket = F.when(place == 0, F.pmod(F.xxhash64(names[c]), F.lit(BUCKETS)).cast("int"))
        cells.append(F.when(F.col(names[c]).isNotNull(), F.struct(F.lit(i).alias("i"), place.alias("place"), bucket.alias("bucket"))))
    marked = clean.select(F.explode(F.array(*cells)).alias("_c")).where("_c is not null").select("_c.*")
    counted = marked.groupBy("i", "place", "bucket").agg(F.count(F.lit(1)).alias("n")).collect()
    for i, c in enumerate(open_):
        exact = _best([(candidates[c][r["place"] - 1], r["n"]) for r in counted if r["i"] == i and r["place"]], k)
        least = exact[k - 1][1] if len(exact) == k else 0
        near = [(r["bucket"],) for r in counted if r["i"] == i and not r["place"] and r["n"] >= least]
        if near:
            values = F.col(names[c])
            rest = clean.where(values.isNotNull() & (F.array_position(held.select(names[c]).scalar(), values) == 0)).select(values.alias("x"))
            if len(near) < BUCKETS:
                buckets = F.broadcast(df.sparkSession.createDataFrame(near, "b int"))  # at most BUCKETS rows
                rest = rest.join(buckets, F.pmod(F.xxhash64("x"), F.lit(BUCKETS)) == F.col("b"), "left_semi")
            exact = _best(exact + _counted_one_by_one(rest, k), k)
        out[c] = exact
    return {c: out[c] for c in cols}


def top_values(df: DataFrame, col: str, k: int) -> DataFrame:
    """``(col, n, place)``: the ``k`` most frequent values of a column, smaller values first among ties."""
    rows = [(v, n, i) for i, (v, n) in enumerate(frequent_values(df, [col], k)[col], 1)]
    schema = T.StructType([T.StructField(col, df.schema[col].dataType), T.StructField("n", T.LongType()), T.StructField("place", T.IntegerType())])
    return df.sparkSession.createDataFrame(rows, schema)


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: the most frequent value of each column, the smallest among ties, missing skipped."""
    found = frequent_values(df, cols)
    schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in cols])
    return df.sparkSession.createDataFrame([tuple(found[c][0][0] if found[c] else None for c in cols)], schema)
