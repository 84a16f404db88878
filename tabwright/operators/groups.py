"""Grouped aggregates. All of them combine inside the task before any shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.numbers import nan_to_null
from tabwright.operators.frequent import modes  # noqa: F401


def exact_money(c: str | Column) -> Column:
    """Two-digit decimals: sums do not depend on the order of addition."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def sum_by(df: DataFrame, keys: str | Sequence[str], measure: str | Column, name: str = "total") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.sum(measure).alias(name))


def sum_by_keys_sorted(df: DataFrame, keys: Sequence[str], measure: str | Column, name: str = "total") -> DataFrame:
    return sum_by(df, keys, measure, name).orderBy(*keys)


def key_lookup_sum(df: DataFrame, key: str, measure: str | Column, name: str = "total") -> DataFrame:
    """For each distinct key the sum over its rows: one grouped pass, not a scan per key."""
    return sum_by(df, key, measure, name)


def count_by(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def frequency_rank(df: DataFrame, col: str, first_seen: str | None = None) -> DataFrame:
    """Values by falling count. Ties go by first appearance when a row key is given, else by value."""
    counted = df.groupBy(col).agg(
        F.count(F.lit(1)).alias("n"), *([F.min(first_seen).alias("first_seen")] if first_seen else [])
    )
    return counted.orderBy(F.desc("n"), *(["first_seen"] if first_seen else []), col)


def collect_by(df: DataFrame, key: str, value: str, position: str, width: int = 10_000) -> DataFrame:
    """Values per key in input order, as ``(key, piece, values)``.

    ``position`` is a unique integer row key. A list is cut where ``position`` crosses
    a multiple of ``width``, so no array holds more than ``width`` values however large
    its key is; reading a key's pieces in order gives its whole list.
    """
    piece = F.floor(F.col(position) / width).cast("bigint")
    cell = F.struct(F.col(position).alias("at"), F.col(value).alias("x"))
    listed = df.groupBy(F.col(key), piece.alias("piece")).agg(F.sort_array(F.collect_list(cell)).alias("_cells"))
    return listed.select(key, "piece", F.col("_cells.x").alias("values"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def shapes(steps: dict[str, DataFrame]) -> DataFrame:
    """``(step_no, step, row_count, column_count, removed)``: size after each step and rows it removed."""
    frames, before = [], None
    for no, (step, df) in enumerate(steps.items()):
        n = df.agg(F.count(F.lit(1)).alias("row_count"))
        removed = (before - F.col("row_count")) if before is not None else F.lit(0).cast("bigint")
        frames.append(
            n.select(
                F.lit(no).alias("step_no"),
                F.lit(step).alias("step"),
                "row_count",
                F.lit(len(df.columns)).alias("column_count"),
                removed.alias("removed"),
            )
        )
        before = n.scalar()
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def mean_by_group(df: DataFrame, key: str, measure: str, name: str = "mean") -> DataFrame:
    return df.groupBy(key).agg(F.avg(nan_to_null(measure)).alias(name))
