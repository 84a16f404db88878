"""Classifiers and regressors: fit, compare, select, save, score."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.numbers import round_half_even
from tabwright.operators.cells import CellBoosting, CellForest, cells_of, in_fixed_order  # noqa: F401
from tabwright.operators.features import balanced_weights, fit_features
from tabwright.operators.newton import NewtonLogistic
from tabwright.session import materialise

SEED = 42


def random_forest(label: str, weight: str | None = "weight", trees: int = 150, depth: int = 10) -> CellForest:
    return CellForest(label, weight, trees, depth, SEED)


def gradient_boosting(label: str, rounds: int = 100, rate: float = 0.1, depth: int = 5) -> CellBoosting:
    """Unweighted, unlike the other two."""
    return CellBoosting(label, rounds, rate, depth, SEED)


def logistic_regression(label: str, weight_sum: float, weight: str | None = "weight", c: float = 1.0) -> NewtonLogistic:
    """L2 with inverse strength ``c``, by Newton steps."""
    return NewtonLogistic(label, weight_sum, weight, c)


def batch_predict(model, df: DataFrame) -> DataFrame:
    return model.transform(df)


def accuracy(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    hit = F.col(prediction).cast("double") == F.col(label).cast("double")
    return scored.agg(F.avg(hit.cast("double")).alias("accuracy"))


def _ratio(a, b):
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def binary_scores(scored: DataFrame, label: str, prediction: str = "prediction", positive: float = 1.0) -> DataFrame:
    """One row ``(accuracy, precision, recall, f1)`` for the positive class; 0 where a divisor is 0."""
    y = F.col(label).cast("double") == positive
    p = F.col(prediction).cast("double") == positive
    counts = scored.agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def _per_class(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """``(class, support, hits, predicted)`` from the confusion counts: one row per class from here on."""
    cells = scored.groupBy(F.col(label).cast("double").alias("y"), F.col(prediction).cast("double").alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    sides = F.explode(
        F.array(
            F.struct(F.col("y").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                     F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hits")),
            F.struct(F.col("p").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"),
                     F.lit(0).cast("bigint").alias("hits")),
        )
    )
    split = cells.select(sides.alias("_s")).select("_s.*")
    return split.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])


def _class_scores(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    return _per_class(scored, label, prediction).select(
        "class",
        _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1"),
        "support",
        "hits",
    )


def weighted_f1(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Mean of the per-class f1, weighted by support."""
    scores = _class_scores(scored, label, prediction)
    return scores.agg(_ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"))


def classification_report(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """``(row, precision, recall, f1, support)`` per class, then accuracy, macro and weighted means."""
    scores = _class_scores(scored, label, prediction)
    measures = ("precision", "recall", "f1")
    per_class = scores.select(F.col("class").cast("int").cast("string").alias("row"), *measures, "support")
    n = F.sum("support")
    share = _ratio(F.sum("hits"), n)
    lines = scores.agg(
        F.struct(F.lit("accuracy").alias("row"), *[share.alias(m) for m in measures], n.alias("support")).alias("a"),
        F.struct(F.lit("macro avg").alias("row"), *[F.avg(m).alias(m) for m in measures], n.alias("support")).alias("b"),
        F.struct(
            F.lit("weighted avg").alias("row"),
            *[_ratio(F.sum(F.col(m) * F.col("support")), n).alias(m) for m in measures],
            n.alias("support"),
        ).alias("c"),
    )
    summary = lines.select(F.explode(F.array("a", "b", "c")).alias("_l")).select("_l.*")
    return per_class.unionByName(summary)


@dataclass(frozen=True)
class Selection:
    """Scores of every candidate, and the best one with its preparation."""

    results: DataFrame
    best_name: str | None
    best_model: PipelineModel | None
    best_scored: DataFrame | None


def compare_and_select(
    train: DataFrame,
    test: DataFrame,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    candidates: Sequence[str] = ("RandomForest", "GradientBoosting", "LogisticRegression"),
) -> Selection:
    """Fit each candidate on the same prepared rows and keep the first with the highest accuracy.

    Preparation is learned once. The prepared training rows are written once and kept
    in memory or on local disk while the candidates iterate; a lost block is read again
    from the written table.
    """
    spark = train.sparkSession
    prepare = fit_features(train, numeric, categorical)
    ready = prepare.transform(balanced_weights(train, label)).select(label, "weight", "features")
    ready = materialise(ready, "train").persist(StorageLevel.MEMORY_AND_DISK)
    prepared_test = materialise(prepare.transform(test), "test")
    weight_sum = ready.agg(F.sum("weight")).first()[0] or 1.0
    # Both kinds of trees are grown on the same cells.
    cells = None if set(candidates) <= {"LogisticRegression"} else cells_of(ready, label)
    builders = {
        "RandomForest": lambda: random_forest(label),
        "GradientBoosting": lambda: gradient_boosting(label),
        "LogisticRegression": lambda: logistic_regression(label, weight_sum),
    }
    rows, best = [], (0.0, None, None, None)
    for place, name in enumerate(candidates):
        model = builders[name]().fit(ready) if name == "LogisticRegression" else builders[name]().fit(ready, cells)
        scored = model.transform(prepared_test)
        # One pass over the scored rows gives the counts that both scores are made of.
        row, f1 = _scores_of_counts(scored.groupBy(label, "prediction").count().collect())
        rows.append((place, name, row["accuracy"], row["precision"], row["recall"], row["f1"], f1))
        if row["accuracy"] > best[0]:
            best = (row["accuracy"], name, PipelineModel([*prepare.stages, model]), scored)
    ready.unpersist()
    schema = "place int, model string, accuracy double, precision double, recall double, f1 double, weighted_f1 double"
    return Selection(spark.createDataFrame(rows, schema).orderBy(F.desc("accuracy"), "place"), *best[1:])


def _scores_of_counts(cells: Sequence) -> tuple[dict[str, float], float]:
    """Binary scores and the weighted f1 from ``(label, prediction, n)``, a row for each pair that occurs."""
    counts = {(float(y), float(p)): n for y, p, n in cells}
    total = sum(counts.values())

    def f1(c: float) -> tuple[float, float, float, int]:
        hits, said, held = counts.get((c, c), 0), sum(n for (_, p), n in counts.items() if p == c), sum(n for (y, _), n in counts.items() if y == c)
        return hits / said if said else 0.0, hits / held if held else 0.0, 2 * hits / (said + held) if said + held else 0.0, held

    precision, recall, own, _ = f1(1.0)
    accuracy = sum(n for (y, p), n in counts.items() if y == p) / total if total else 0.0
    per_class = [f1(c) for c in sorted({y for y, _ in counts} | {p for _, p in counts})]
    weighted = sum(s[2] * s[3] for s in per_class) / total if total else 0.0
    return {"accuracy": accuracy, "precision": precision, "recall": recall, "f1": own}, weighted


def save_model(model: PipelineModel, path: str) -> None:
    """The whole chain, preparation included."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def _assembled(df: DataFrame, predictors: Sequence[str], target: str) -> DataFrame:
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in predictors], F.col(target).cast("double").alias("_y"))
    return VectorAssembler(inputCols=list(predictors), outputCol="_x").transform(rows.dropna())


def ols(df: DataFrame, target: str, predictors: Sequence[str]) -> DataFrame:
    """``(term, coefficient, std_error, t, p, r2)``, one row per predictor and the intercept.

    The normal equations: one pass sums products, whatever the number of rows.
    """
    fit = LinearRegression(featuresCol="_x", labelCol="_y", solver="normal", regParam=0.0).fit(
        _assembled(df, predictors, target)
    )
    s = fit.summary
    terms = [*predictors, "intercept"]
    coefficients = [*fit.coefficients.tolist(), fit.intercept]
    rows = [
        (term, float(b), float(e), float(t), float(p), float(s.r2))
        for term, b, e, t, p in zip(terms, coefficients, s.coefficientStandardErrors, s.tValues, s.pValues, strict=True)
    ]
    schema = "term string, coefficient double, std_error double, t double, p double, r2 double"
    return df.sparkSession.createDataFrame(rows, schema)


def interpret_ols(terms: DataFrame, alpha: float = 0.05) -> DataFrame:
    """``raises``, ``lowers`` or ``no_effect`` per term."""
    effect = F.when(F.col("p") < alpha, F.when(F.col("coefficient") > 0, "raises").otherwise("lowers"))
    return terms.withColumn("effect", effect.otherwise("no_effect"))


def ridge(
    train: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str] = (), alpha: float = 1.0
) -> PipelineModel:
    """Least squares plus ``alpha * |w|^2`` on prepared features; the intercept is free.

    Spark's loss is the mean over rows with the target scaled to unit deviation, so
    ``alpha`` is divided by the number of rows and multiplied by that deviation.
    """
    present = train.where(F.col(target).isNotNull())
    prepare = fit_features(present, numeric, categorical)
    n, spread = present.agg(F.count(F.lit(1)), F.stddev_pop(target)).first()
    regression = LinearRegression(
        labelCol=target,
        solver="normal",
        regParam=alpha * (spread or 1.0) / max(n, 1),
        elasticNetParam=0.0,
        standardization=False,
    )
    model = regression.fit(prepare.transform(present).select(target, "features"))
    return PipelineModel([*prepare.stages, model])


# The exchange rate and the unit a converted amount is shown in.
WON_PER_DOLLAR = 1350.0
WON_UNIT = 10_000.0


def score_and_convert(
    model: PipelineModel, df: DataFrame, rate: float = WON_PER_DOLLAR, unit: float = WON_UNIT
) -> DataFrame:
    """Predicted amount, and the same converted and rounded to whole units."""
    scored = model.transform(df)
    converted = round_half_even(F.col("prediction") * F.lit(rate) / F.lit(unit))
    return scored.withColumn("converted", converted.cast("bigint"))
