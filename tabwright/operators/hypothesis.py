"""Tests on group differences and correlation. Data is aggregated first; the test runs on the sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.numbers import nan_to_null
from tabwright.functions.tails import two_sided_t, upper_f
from tabwright.operators.quantiles import quantiles
from tabwright.session import materialise


def welch_t_test(df: DataFrame, group: str, measures: str | Sequence[str], a, b) -> DataFrame:
    """Unequal-variance t-test of group ``a`` against ``b``, one row per measure, one scan in all.

    ``(measure, n_a, n_b, mean_a, mean_b, var_a, var_b, t, dof, p)``. Missing values are
    dropped per measure. Fewer than two values in a group, or no variance in either,
    gives t = 0 and p = 1. The sign is that of mean(a) - mean(b).
    """
    measures = [measures] if isinstance(measures, str) else list(measures)
    aggs = []
    for i, m in enumerate(measures):
        for side, value in (("a", a), ("b", b)):
            x = F.when(F.col(group) == F.lit(value), nan_to_null(m))
            aggs += [
                F.count(x).alias(f"n_{side}{i}"),
                F.avg(x).alias(f"mean_{side}{i}"),
                F.var_samp(x).alias(f"var_{side}{i}"),
            ]
    sums = df.where(F.col(group).isin(a, b)).agg(*aggs)
    stats = ("n_a", "n_b", "mean_a", "mean_b", "var_a", "var_b")
    cells = [
        F.struct(F.lit(m).alias("measure"), *[F.col(f"{s}{i}").alias(s) for s in stats])
        for i, m in enumerate(measures)
    ]
    return _welch(sums.select(F.explode(F.array(*cells)).alias("_r")).select("_r.*"))


def _welch(sums: DataFrame) -> DataFrame:
    ea, eb = F.try_divide("var_a", "n_a"), F.try_divide("var_b", "n_b")
    undecided = (
        (F.col("n_a") < 2) | (F.col("n_b") < 2) | ((F.col("var_a") == 0) & (F.col("var_b") == 0))
    )
    t = F.try_divide(F.col("mean_a") - F.col("mean_b"), F.sqrt(ea + eb))
    spread = F.try_divide(ea * ea, F.col("n_a") - 1) + F.try_divide(eb * eb, F.col("n_b") - 1)
    out = sums.withColumn("_undecided", undecided)
    out = out.withColumns(
        {
            "t": F.when(F.col("_undecided"), 0.0).otherwise(t),
            "dof": F.when(~F.col("_undecided"), F.try_divide((ea + eb) * (ea + eb), spread)),
        }
    )
    p = F.when(F.col("_undecided"), 1.0).otherwise(two_sided_t(F.col("t"), F.col("dof")))
    return out.withColumn("p", p).drop("_undecided")


def verdict(t: str | Column = "t", p: str | Column = "p", alpha: float = 0.05) -> Column:
    """``higher``, ``lower`` or ``not_significant``."""
    t, p = (F.col(c) if isinstance(c, str) else c for c in (t, p))
    return F.when(p < alpha, F.when(t > 0, "higher").otherwise("lower")).otherwise("not_significant")


def interpret_test(tests: DataFrame, alpha: float = 0.05) -> DataFrame:
    return tests.withColumn("verdict", verdict(alpha=alpha))


def anova_oneway(df: DataFrame, group: str, measure: str) -> DataFrame:
    """One row ``(k, n, ss_between, ss_within, f, p)``; rows missing either column are left out."""
    x = nan_to_null(measure)
    per_group = (
        df.select(F.col(group).alias("g"), x.alias("x"))
        .where(F.col("g").isNotNull() & F.col("x").isNotNull())
        .groupBy("g")
        .agg(F.count("x").alias("n"), F.avg("x").alias("m"), F.var_samp("x").alias("v"))
    )
    per_group = materialise(per_group, "anova")  # a row per group, used twice
    grand = per_group.agg(F.try_divide(F.sum(F.col("n") * F.col("m")), F.sum("n"))).scalar()
    gap = F.col("m") - grand
    total = per_group.agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * gap * gap).alias("ss_between"),
        F.sum((F.col("n") - 1) * F.coalesce("v", F.lit(0.0))).alias("ss_within"),
    )
    d1, d2 = F.col("k") - 1, F.col("n") - F.col("k")
    f = F.try_divide(F.try_divide("ss_between", d1), F.try_divide("ss_within", d2))
    return total.withColumn("f", f).withColumn("p", upper_f(F.col("f"), d1, d2))


def levene_test(df: DataFrame, group: str, measure: str, center: str = "median") -> DataFrame:
    """Equality of variances: the analysis of variance of ``|x - centre of its group|``."""
    rows = df.select(F.col(group).alias("g"), nan_to_null(measure).alias("x")).dropna()
    if center == "mean":
        centres = rows.groupBy("g").agg(F.avg("x").alias("c"))
    elif center == "median":
        centres = quantiles(rows, ["x"], [0.5], by=["g"]).select("g", F.col("value").alias("c"))
    else:
        raise ValueError("center is 'mean' or 'median'")
    spread = rows.join(materialise(centres, "levene"), "g").select("g", F.abs(F.col("x") - F.col("c")).alias("z"))
    return anova_oneway(spread, "g", "z")


def pearson_test(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row ``(n, r, t, p)`` over rows where both columns are present."""
    x, y = nan_to_null(a), nan_to_null(b)
    both = df.select(x.alias("x"), y.alias("y")).dropna()
    sums = both.agg(
        F.count(F.lit(1)).alias("n"),
        F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y")).alias("r"),
    )
    dof = F.col("n") - 2
    # |r| = 1 leaves nothing unexplained: t is unbounded and p is 0.
    t = F.when(dof > 0, F.try_divide(F.col("r") * F.sqrt(dof), F.sqrt(F.lit(1.0) - F.col("r") * F.col("r"))))
    p = F.when(F.abs("r") >= 1, F.lit(0.0)).otherwise(two_sided_t(F.col("t"), dof.cast("double")))
    return sums.withColumn("t", t).withColumn("p", F.when(dof > 0, p))
