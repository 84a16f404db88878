"""Descriptive statistics in tidy form."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product as product_of

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.numbers import nan_to_null
from tabwright.operators.gram import gram
from tabwright.operators.quantiles import quantiles
from tabwright.operators.rows import columns_by_type
from tabwright.operators.summaries import describe_summaries, summarise
from tabwright.session import materialise

_QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def _by_name(q: DataFrame, keys: Sequence[str], names: dict[str, float]) -> DataFrame:
    picks = [F.max(F.when(F.col("q") == F.lit(float(v)), F.col("value"))).alias(k) for k, v in names.items()]
    return q.groupBy(*keys).agg(*picks)


def describe(df: DataFrame, cols: Sequence[str] | None = None, method: str = "exact") -> DataFrame:
    """One row per numeric column: count, mean, sample std, min, quartiles, max."""
    cols = list(cols or columns_by_type(df, "numeric"))
    summaries = materialise(summarise(df, cols), "summaries")
    return describe_summaries(df, summaries, cols, method=method)


def spread_samples(df: DataFrame, col: str) -> DataFrame:
    """Sample variance and standard deviation (n - 1)."""
    x = nan_to_null(col)
    return df.agg(F.var_samp(x).alias("variance"), F.stddev_samp(x).alias("std"))


def _corr_directly(df: DataFrame, pairs: Sequence[tuple[str, str]], at_once: int = 50) -> dict[tuple[str, str], float | None]:
    """The coefficient of a few pairs from their own running moments."""
    out = {}
    for k in range(0, len(pairs), at_once):
        aggs = []
        for i, (a, b) in enumerate(pairs[k : k + at_once]):
            both = F.col(a).isNotNull() & F.col(b).isNotNull()
            x, y = F.when(both, F.col(a)), F.when(both, F.col(b))
            aggs.append(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)).alias(f"r{i}"))
        row = df.agg(*aggs).first()
        out |= {pair: row[f"r{i}"] for i, pair in enumerate(pairs[k : k + at_once])}
    return out


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson ``(var1, var2, r)``, each pair over rows where both are present. Computed now, in two passes.

    The first finds every column's mean and whether it has gaps; the second adds up one Gram matrix of the centred
    columns, their squares and their presence, which holds the counts, sums and products of every pair over its own
    rows. Its size is that of the columns, and no expression is written for a pair. A pair whose variance nearly
    cancels in those sums is taken from its own moments in a pass of its own. A column without variance gives a missing r.
    """
    names = list(dict.fromkeys(cols))
    df = df.select(*[nan_to_null(c).alias(c) for c in names])
    whole = df.agg(F.count(F.lit(1)).alias("n"), *[a.alias(f"{k}{i}") for i, c in enumerate(names) for k, a in (("c", F.count(F.col(c))), ("m", F.avg(F.col(c))), ("lo", F.min(c)), ("hi", F.max(c)))]).first()
    # The centre of a constant column is its value, so that nothing is left of it.
    centre = [whole[f"lo{i}"] if whole[f"lo{i}"] == whole[f"hi{i}"] else whole[f"m{i}"] for i in range(len(names))]
    gaps = [i for i in range(len(names)) if whole[f"c{i}"] < whole["n"]]
    centred = [F.coalesce(F.col(c) - F.lit(centre[i] or 0.0), F.lit(0.0)) for i, c in enumerate(names)]
    squares = [x * x for x in centred] if gaps else []
    present = [F.col(names[i]).isNotNull().cast("double") for i in gaps]
    vector = [F.lit(1.0), *centred, *squares, *present]
    sums = gram(df, vector) if whole["n"] else np.zeros((len(vector), len(vector)))
    p = len(names)
    x, xx = np.arange(1, p + 1), np.arange(1 + p, 1 + 2 * p)
    mask = np.zeros(p, int)  # row and column 0 of the matrix stand for a column that is always present
    mask[gaps] = 1 + p + len(squares) + np.arange(len(gaps))
    n, product = sums[np.ix_(mask, mask)], sums[np.ix_(x, x)]
    total = sums[np.ix_(x, mask)]  # of a over the rows where b is present
    square = sums[np.ix_(xx, mask)] if gaps else np.repeat(np.diag(product)[:, None], p, axis=1)
    with np.errstate(all="ignore"):
        spread = square - total**2 / n
        r = (product - total * total.T / n) / np.sqrt(spread * spread.T)
        near = (spread <= 1e-9 * square) & (square > 0)
    r[(spread <= 0) | (spread.T <= 0)] = np.nan
    found = {(a, b): None if np.isnan(r[i, j]) and not np.isnan(product[i, j]) else float(r[i, j]) for i, a in enumerate(names) for j, b in enumerate(names)}
    doubtful = [(names[i], names[j]) for i in range(p) for j in range(i, p) if near[i, j] or near[j, i]]
    for (a, b), value in _corr_directly(df, doubtful).items():
        found[a, b] = found[b, a] = value
    rows = [(a, b, found[a, b]) for a, b in product_of(cols, cols)]
    return df.sparkSession.createDataFrame(rows, "var1 string, var2 string, r double")


def _fences(df: DataFrame, group: str, measure: str) -> tuple[DataFrame, DataFrame]:
    rows = df.select(F.col(group), nan_to_null(measure).alias("x")).where(
        F.col("x").isNotNull() & F.col(group).isNotNull()
    )
    q = _by_name(quantiles(rows, ["x"], list(_QUARTILES.values()), by=[group]), [group, "n"], _QUARTILES)
    reach = (F.col("q75") - F.col("q25")) * 1.5
    fences = q.withColumns({"low_fence": F.col("q25") - reach, "high_fence": F.col("q75") + reach})
    return rows, materialise(fences, "box")


def box_summary(df: DataFrame, group: str, measure: str) -> DataFrame:
    """What a box plot draws: quartiles, whiskers inside 1.5 IQR, number of points outside."""
    rows, fences = _fences(df, group, measure)
    inside = F.when(F.col("x").between(F.col("low_fence"), F.col("high_fence")), F.col("x"))
    whiskers = (
        rows.join(fences, group)
        .groupBy(group, "n", *_QUARTILES)
        .agg(
            F.min(inside).alias("whisker_low"),
            F.max(inside).alias("whisker_high"),
            F.count(F.when(inside.isNull(), 1)).alias("outliers"),
        )
    )
    return whiskers.select(group, "n", "whisker_low", *_QUARTILES, "whisker_high", "outliers")


def box_points(df: DataFrame, group: str, measure: str) -> DataFrame:
    """The points outside the whiskers."""
    rows, fences = _fences(df, group, measure)
    outside = (F.col("x") < F.col("low_fence")) | (F.col("x") > F.col("high_fence"))
    return rows.join(fences, group).where(outside).select(group, F.col("x").alias(measure))
