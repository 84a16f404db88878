"""Summaries of columns that can be kept, merged and described again.

A summary row holds a column's row count, mean, sum of squared deviations, extremes and a quantile sketch of bounded
size. Rows of several parts of a table, as files, days or shards, merge into the row of the parts together, whatever
the parts. A store keeps one set of rows for each part, so a table that grows by a day is described again from the new
day and the stored rows; quartiles are exact all the same: the merged sketch takes the place of the first scan, and the
counts that prove its brackets come from the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.numbers import nan_to_null
from tabwright.operators.quantiles import DEPTH, quantiles, sketch_of

MEASURES = ("n", "mean", "m2", "min", "max", "sketch")
_QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def summarise(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., variable, n, mean, m2, min, max, sketch)`` of every column in one aggregate; missing values are skipped.

    A column without values has n = 0 and missing measures. Without ``by`` an empty table has such rows too.
    """
    aggs = []
    for i, c in enumerate(cols):
        x = nan_to_null(c)
        own = (F.count(x), F.avg(x), F.var_pop(x) * F.count(x), F.min(x), F.max(x), sketch_of(x))
        aggs += [a.alias(f"_{m}{i}") for m, a in zip(MEASURES, own, strict=True)]
    cells = F.array(*[F.struct(F.lit(c).alias("variable"), *[F.col(f"_{m}{i}").alias(m) for m in MEASURES]) for i, c in enumerate(cols)])
    return df.groupBy(*by).agg(*aggs).select(*by, F.explode(cells).alias("_c")).select(*by, "_c.*")


def merged(summaries: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Summary rows of parts as one row for each of ``by`` and variable.

    Squared deviations are taken from the common mean before they are added, so parts of far apart means lose nothing.
    """
    keys = [*by, "variable"]
    full = summaries.where("n > 0")
    centre = full.groupBy(*keys).agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    same = reduce(Column.__and__, (F.col(f"p.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys))
    placed = full.alias("p").join(centre.alias("c"), same).select("p.*", "c._mean")
    spread = F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("_mean")) ** 2)
    return placed.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.first("_mean").alias("mean"), spread.alias("m2"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("sketch", DEPTH).alias("sketch"),
    )


def describe_summaries(df: DataFrame, summaries: DataFrame, cols: Sequence[str], by: Sequence[str] = (), method: str = "exact") -> DataFrame:
    """``(by..., variable, count, mean, std, min, q25, q50, q75, max)`` of ``df``, whose merged summaries are given.

    Only the quartiles read ``df``, for counts around the ranks that the sketches point to. ``"sketch"`` takes them from
    the sketches alone, off by about a 1,500th of the rows.
    """
    keys = [*by, "variable"]
    picked = summaries.where(F.col("variable").isin(*cols))
    std = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    moments = picked.select(*keys, F.col("n").alias("count"), "mean", std.alias("std"), "min", "max")
    if method == "sketch":
        found = F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, _QUARTILES.values())))
        quarters = picked.where("n > 0").select(*keys, *[found[i].alias(q) for i, q in enumerate(_QUARTILES)])
    else:
        asked = quantiles(df, cols, list(_QUARTILES.values()), by=by, method=method, first_cut=picked if method == "exact" else None)
        picks = [F.max(F.when(F.col("q") == F.lit(v), F.col("value"))).alias(k) for k, v in _QUARTILES.items()]
        quarters = asked.groupBy(*keys).agg(*picks)
    same = reduce(Column.__and__, (F.col(f"m.{k}").eqNullSafe(F.col(f"q.{k}")) for k in keys))
    return moments.alias("m").join(quarters.alias("q"), same, "left").select(
        *[F.col(f"m.{k}") for k in keys], "count", "mean", "std", "min", *_QUARTILES, "max"
    )


class SummaryStore:
    """Summary rows in a folder, one set for each part of a table.

    A part that is added again replaces its rows, so a repeated or restarted run counts nothing twice. Adding reads the
    rows of that part only.
    """

    def __init__(self, spark: SparkSession, path: str, cols: Sequence[str], by: Sequence[str] = ()):
        self.spark, self.path, self.cols, self.by = spark, path, list(cols), list(by)

    def add(self, part: str, rows: DataFrame) -> None:
        """Keep the summaries of a part's rows."""
        out = summarise(rows, self.cols, self.by).withColumn("part", F.lit(part))
        out.coalesce(1).write.partitionBy("part").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path)

    def add_all(self, df: DataFrame, part: str | Column) -> None:
        """Keep the summaries of every part that ``df`` holds, in one pass."""
        name = (F.col(part) if isinstance(part, str) else part).cast("string")
        out = summarise(df.withColumn("part", name), self.cols, [*self.by, "part"])
        out.repartition("part").write.partitionBy("part").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path)

    def rows(self) -> DataFrame | None:
        """All kept rows with their ``part``; None before the first."""
        try:
            found = self.spark.read.parquet(self.path).schema
        except AnalysisException:
            return None
        # Names of parts are text, even where they look like numbers or dates.
        fields = [T.StructField("part", T.StringType()) if f.name == "part" else f for f in found.fields]
        return self.spark.read.schema(T.StructType(fields)).parquet(self.path)

    def merged(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """The summary of the parts from ``first`` to ``last``, both included, in the order of their names."""
        kept = self.rows()
        if kept is None:
            raise ValueError(f"no summaries in {self.path}")
        for bound, test in ((first, F.col("part") >= first if first else None), (last, F.col("part") <= last if last else None)):
            kept = kept if bound is None else kept.where(test)
        return merged(kept, self.by)
