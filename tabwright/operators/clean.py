"""Cleaning: outlier trim, imputation, coercion, label and range repair."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tabwright.functions.hashing import digest
from tabwright.functions.numbers import clip, missing_as_null, nan_to_null, parse_number
from tabwright.operators.frequent import modes
from tabwright.operators.quantiles import median_point, quantile_row
from tabwright.operators.rows import derive_binary, drop_duplicates, filter_range, sort_rows
from tabwright.session import materialise


def percentile_trim(df: DataFrame, col: str, lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """Rows whose value lies between two of the column's quantiles, inclusive; missing rows go."""
    edges = quantile_row(df, col, {"lo": lo, "hi": hi}).select(F.struct("lo", "hi").alias("e")).scalar()
    return filter_range(df, col, edges["lo"], edges["hi"])


def trim_edges(df: DataFrame, col: str, lo: float = 0.01, hi: float = 0.99) -> tuple:
    """The two quantiles as numbers, computed now. As literals they reach the scan's pushed filters."""
    return tuple(quantile_row(df, col, {"lo": lo, "hi": hi}).first())


def impute_median(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.coalesce(nan_to_null(col), median_point(df, col)))


def impute_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Every listed column filled from one shared pass."""
    fill = modes(df, cols).select(F.struct(*cols).alias("m")).scalar()
    return df.withColumns({c: F.coalesce(missing_as_null(df, c), fill[c]) for c in cols})


def coerce_numeric(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    return df.withColumn(name or f"{col}_Num", parse_number(col))


def clip_column(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    return df.withColumn(col, clip(col, lo, hi))


def nan_as_missing(df: DataFrame) -> DataFrame:
    """Every fractional column with NaN turned to NULL, as the cleaning steps expect."""
    fractional = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in fractional})


def clean_survey(
    df: DataFrame,
    answer: str,
    measure: str,
    categories: Sequence[str],
    score: str,
    yes: str = "Yes",
    status: str = "AI_Status",
    store: bool = True,
) -> DataFrame:
    """Deduplicate, derive the status, trim the measure, fill categories, fill the score, in this order.

    Columns the table lacks are skipped. The status is derived before the answer is
    filled, so a missing answer stays ``No``. Each later step needs a statistic of the
    table so far. With ``store`` the deduplicated table is written once and those passes
    read single columns of it instead of repeating the deduplication; the statistics, one
    row each, are computed now and enter the result as literals.
    """
    out = drop_duplicates(nan_as_missing(df))
    if store:
        out = materialise(out, "deduplicated")
    out = derive_binary(out, answer, yes, status)
    if measure in out.columns:
        # Missing measures fall out here, so no median fill is left to do.
        out = filter_range(out, measure, *(F.lit(e) for e in trim_edges(out, measure)))
    fills = {}
    present = [c for c in categories if c in out.columns]
    if present:
        fills.update(modes(out, present).first().asDict())
    if score in out.columns:
        fills[score] = quantile_row(out, score, {"median": 0.5}).first()["median"]
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})


def scatter_dataset(df: DataFrame, x: str, y: str, group: str, key: Sequence[str] = ()) -> DataFrame:
    """Points of a scatter plot: numeric x, missing dropped, in x order."""
    name = f"{x}_Num"
    points = coerce_numeric(df, x, name).dropna(subset=[name, y])
    return sort_rows(points.select(*key, name, y, group), [name], tiebreak=list(key))


def scatter_bins(df: DataFrame, x: str, y: str, group: str, x_step: float, y_step: float) -> DataFrame:
    """The same points counted on a grid, for tables too large to draw."""
    name = f"{x}_Num"
    points = coerce_numeric(df, x, name).dropna(subset=[name, y])
    cell = [(F.floor(F.col(c) / s) * s).cast("double").alias(f"{a}_from") for c, s, a in ((name, x_step, "x"), (y, y_step, "y"))]
    return points.groupBy(group, *cell).agg(F.count(F.lit(1)).alias("n"))


def scatter_sample(df: DataFrame, x: str, y: str, group: str, key: str, k: int, seed: int = 42) -> DataFrame:
    """Of the same points at most ``k`` a group, for drawing: those of the smallest digests of ``key``, a unique column.

    The rows are the same on any cluster and however the table is cut; samples of parts merge into the sample of the whole
    by sampling their union again. A group's size gives a digest below which its sample surely lies, but for a chance
    that the count of rows found there shows; only such rows are ranked.
    """
    name = f"{x}_Num"
    points = coerce_numeric(df, x, name).dropna(subset=[name, y]).select(key, name, y, group)
    mark = digest(key, seed, "scatter")
    sizes = materialise(points.groupBy(F.col(group).alias("_g")).agg(F.count(F.lit(1)).alias("_n")), "sizes")
    slack = 1.0
    while True:
        share = F.lit(k + slack * (6 * math.sqrt(k) + 20)) / F.col("_n")
        # The digest's first 13 digits as a share of all: exact in a double.
        below = F.conv(F.substring(mark, 1, 13), 16, 10).cast("double") < share * float(16**13)
        near = materialise(points.join(sizes, F.col(group).eqNullSafe(F.col("_g"))).where(below), "near")
        found = near.groupBy("_g", "_n").agg(F.count(F.lit(1)).alias("_c")).alias("f")
        short = sizes.alias("s").join(found, F.expr("s._g <=> f._g"), "left").where(F.coalesce("f._c", F.lit(0)) < F.least(F.lit(k), F.col("s._n")))
        if short.isEmpty():
            break
        slack *= 4
    rank = F.row_number().over(Window.partitionBy(group).orderBy(mark, key))
    return near.withColumn("_rank", rank).where(F.col("_rank") <= k).select(key, name, y, group)


def range_clean(df: DataFrame, col: str, low: float = 10_000, high: float = 500_000) -> DataFrame:
    """Strictly between the bounds."""
    x = nan_to_null(col)
    return df.where((x > low) & (x < high))


def normalise_label(df: DataFrame, col: str, names: dict[str, str]) -> DataFrame:
    """Replace spellings by their one label; other values stay."""
    table = F.create_map(*[F.lit(v) for pair in names.items() for v in pair])
    return df.withColumn(col, F.coalesce(F.try_element_at(table, F.col(col)), F.col(col)))


def group_flag(df: DataFrame, col: str, value, name: str) -> DataFrame:
    return df.withColumn(name, F.when(F.col(col) == F.lit(value), 1).otherwise(0))
