"""Row-wise operators: projection, filters, derived columns, union, order, top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.numbers import flag_equal, missing_as_null, nan_to_null
from tabwright.operators.quantiles import quantile_point


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def filter_ge(df: DataFrame, col: str, bound) -> DataFrame:
    """Missing never passes; types without NaN compare as they are, so the filter reaches the scan."""
    return df.where(missing_as_null(df, col) >= bound)


def filter_gt(df: DataFrame, col: str, bound) -> DataFrame:
    """As ``filter_ge``, strictly."""
    return df.where(missing_as_null(df, col) > bound)


def filter_range(df: DataFrame, col: str, lo: float | Column, hi: float | Column) -> DataFrame:
    """Inclusive at both ends; missing never passes."""
    return df.where(missing_as_null(df, col).between(lo, hi))


def filter_group(df: DataFrame, group: str, value, measure: str) -> DataFrame:
    """The measure of one group."""
    return df.where(F.col(group) == F.lit(value)).select(measure)


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(subset))


def derive_binary(df: DataFrame, col: str, value, name: str) -> DataFrame:
    """``Yes`` where the column equals ``value``, else ``No``; missing is ``No``."""
    return df.withColumn(name, flag_equal(col, value))


def derive_threshold_flag(df: DataFrame, col: str, q: float, name: str) -> DataFrame:
    """1 where the value reaches the column's own quantile, else 0; missing is 0."""
    edge = quantile_point(df, col, q)
    return df.withColumn(name, F.when(nan_to_null(col) >= edge, 1).otherwise(0))


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Names the table lacks are ignored."""
    return df.drop(*names)


def columns_by_type(df: DataFrame, kind: str, first: int | None = None) -> list[str]:
    """``numeric`` or ``categorical`` columns in table order."""
    wanted = {"numeric": T.NumericType, "categorical": T.StringType}[kind]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, wanted)][:first]


def select_by_type(df: DataFrame, kind: str, first: int | None = None) -> DataFrame:
    return df.select(*columns_by_type(df, kind, first))


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def attach_scalar(df: DataFrame, one_row: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Put the values of a one-row frame on every row.

    A scalar subquery: no join, and a second row is a run-time error rather than
    a silent multiplication.
    """
    cols = list(cols or one_row.columns)
    value = one_row.select(F.struct(*cols).alias("_one")).scalar()
    return df.withColumns({c: value[c] for c in cols})


def append(a: DataFrame, b: DataFrame) -> DataFrame:
    """Bag union by column name."""
    return a.unionByName(b)


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """One row of each equal set; copies collapse before the shuffle."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def sort_rows(df: DataFrame, by: Sequence[str], descending: bool = False, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Global order by range partitions; missing, NaN among it, comes last either way.

    ``tiebreak`` (a row key) lets rows that share one sort value spread over several
    partitions, and makes the order total.
    """
    keys = [missing_as_null(df, c) for c in by]
    order = [k.desc_nulls_last() if descending else k.asc_nulls_last() for k in keys]
    return df.orderBy(*order, *tiebreak)


def head(df: DataFrame, n: int, key: Sequence[str]) -> DataFrame:
    """The first ``n`` rows by ``key``: each task keeps ``n``, no full sort."""
    return df.orderBy(*key).limit(n)


def argmax(df: DataFrame, score: str, order: str) -> DataFrame:
    """The row with the highest score; the first of equals by ``order``.

    The search starts at 0.0 and needs a strictly greater score, so a table without
    a positive score yields no row.
    """
    return df.where(missing_as_null(df, score) > 0.0).orderBy(F.desc(score), order).limit(1)
