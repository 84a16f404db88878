"""The content of an analysis report as one tidy table, ready to be written or rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions import numbers as num
from tabwright.operators.groups import shapes


def _tall(df: DataFrame, section: str, group: Column, values: list[str], texts: dict[str, Column]) -> DataFrame:
    """Columns to ``(section, metric, group, value_double, value_string)`` rows."""
    cells = [
        F.struct(
            F.lit(v).alias("metric"),
            F.col(v).cast("double").alias("value_double"),
            texts.get(v, F.lit(None)).cast("string").alias("value_string"),
        )
        for v in values
    ]
    only_text = [
        F.struct(F.lit(t).alias("metric"), F.lit(None).cast("double").alias("value_double"), c.alias("value_string"))
        for t, c in texts.items()
        if t not in values
    ]
    tall = df.select(group.cast("string").alias("group"), F.explode(F.array(*cells, *only_text)).alias("_c"))
    return tall.select(F.lit(section).alias("section"), "_c.metric", "group", "_c.value_double", "_c.value_string")


def report_metrics(
    steps: dict[str, DataFrame],
    stats: DataFrame,
    tests: DataFrame,
    corr: DataFrame | None = None,
    models: DataFrame | None = None,
    chosen: str | None = None,
) -> DataFrame:
    """Row counts per step, statistics, correlations, test results, model scores and the chosen model.

    ``value_string`` holds a number in the form the report prints.
    """
    parts = [
        _tall(shapes(steps), "load", F.col("step"), ["row_count", "column_count", "removed"], {}),
        _tall(stats, "statistics", F.col("variable"), ["mean", "std", "q25", "q50", "q75"], {}),
        _tall(
            tests,
            "tests",
            F.col("measure"),
            ["mean_a", "mean_b", "t", "p"],
            {
                "mean_a": num.money("mean_a"),
                "mean_b": num.money("mean_b"),
                "t": num.fixed("t"),
                "p": num.scientific("p"),
                "verdict": F.col("verdict"),
            },
        ),
    ]
    if corr is not None:
        parts.append(_tall(corr, "correlation", F.concat_ws(" ~ ", "var1", "var2"), ["r"], {}))
    if models is not None:
        shown = [c for c in ("accuracy", "precision", "recall", "f1", "weighted_f1") if c in models.columns]
        texts = {c: num.percent(c) if c == "accuracy" else num.fixed(c) for c in shown}
        parts.append(_tall(models, "models", F.col("model"), shown, texts))
        if chosen is not None:
            best = models.where(F.col("model") == chosen)
            parts.append(_tall(best, "chosen", F.col("model"), ["accuracy"], {"accuracy": num.percent("accuracy")}))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
