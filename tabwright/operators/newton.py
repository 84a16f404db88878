"""Logistic regression by Newton steps over moment sums.

Each step is one pass: the weighted Gram matrix of the rows gives the Hessian, and in the same sums the gradient and the
loss. Steps start where a bounded sample of the rows has its own minimum, so a few passes over all rows reach theirs;
the sample decides where the steps start and nothing else.
"""

from __future__ import annotations

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.operators.gram import gram
from tabwright.session import materialise

WIDEST = 256  # features; more are left to the quasi-Newton solver
STEPS = 50
SAMPLED = 1_000_000  # cells of the sample that reach the driver, 20,000 rows at most
LEAST_ROOT = 1e-12  # of a row's weight in the Hessian; it bends the step of a row that is decided anyway, not the gradient


def linear(x: Column, weights: list[float], intercept: float) -> Column:
    """``intercept + weights . x`` for an array column."""
    out = F.lit(float(intercept))
    for i, w in enumerate(weights):
        if w:
            out = out + x[i] * F.lit(float(w))
    return out


class LogisticModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` of label 1 and ``prediction``; the weights are parameters, so it saves like any stage."""

    weights = Param(Params._dummy(), "weights", "weight of each feature", typeConverter=TypeConverters.toListFloat)
    bias = Param(Params._dummy(), "bias", "intercept", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, weights=None, bias=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(self.getOrDefault("weights"))

    @property
    def intercept(self) -> float:
        return self.getOrDefault("bias")

    def _transform(self, df: DataFrame) -> DataFrame:
        x = df.select("*", vector_to_array("features").alias("_x"))
        scored = x.withColumn("_score", linear(F.col("_x"), self.getOrDefault("weights"), self.intercept))
        return scored.withColumns({"probability": 1 / (1 + F.exp(-F.col("_score"))), "prediction": (F.col("_score") > 0).cast("double")}).drop("_x", "_score")


def _pass(rows: DataFrame, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Hessian, gradient and loss of the data at ``beta`` (intercept first), as sums over all rows."""
    x, y, w = F.col("x"), F.col("y"), F.col("w")
    placed = rows.select("x", "y", "w", linear(x, beta[1:].tolist(), beta[0]).alias("s"))
    chance = 1 / (1 + F.exp(-F.col("s")))
    # log(1 + exp(s)) - y s, without overflow on either side
    loss = w * (F.greatest(F.col("s"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("s"))) - y * F.col("s"))
    placed = placed.select("x", (w * (chance - y)).alias("e"), loss.alias("loss"), F.greatest(F.sqrt(w * chance * (1 - chance)), F.lit(LEAST_ROOT)).alias("root"))
    root = F.col("root")
    # Products of two cells: root * root x, and root * (e / root), root * (loss / root).
    cells = [root, *[root * x[i] for i in range(len(beta) - 1)], F.col("e") / root, F.col("loss") / root]
    sums = gram(placed, cells)
    k = len(beta)
    return sums[:k, :k], sums[:k, k], float(sums[0, k + 1])


def _start(rows: DataFrame, features: int, ridge: np.ndarray, n: int, beta: np.ndarray) -> np.ndarray:
    """The minimum of a sample of rows, taken by a digest of their values; ``beta`` if the sample has none."""
    share = min(20_000, SAMPLED // max(1, features)) / max(1, n)
    picked = F.pmod(F.xxhash64("x", "y", "w"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000))
    sample = rows.where(picked).limit(25_000).toArrow() if share < 0.5 else None
    if sample is None or not sample.num_rows:
        return beta
    x1 = np.column_stack([np.ones(sample.num_rows), np.array(sample.column("x").to_pylist()).reshape(sample.num_rows, -1)])
    y, w = (sample.column(c).to_numpy() for c in ("y", "w"))
    own, small = beta.copy(), ridge * share
    for _ in range(STEPS):
        chance = 1 / (1 + np.exp(-np.clip(x1 @ own, -500, 500)))
        try:
            step = np.linalg.solve((x1.T * (w * chance * (1 - chance))) @ x1 + np.diag(small), x1.T @ (w * (y - chance)) - small * own)
        except np.linalg.LinAlgError:
            return beta
        own = own + step
        if not np.isfinite(own).all():
            return beta
        if np.abs(step).max() < 1e-6 * (1 + np.abs(own).max()):
            return own
    return beta


def minimise(rows: DataFrame, features: int, penalty: float, tolerance: float = 1e-9) -> np.ndarray | None:
    """Intercept and weights that minimise the weighted loss plus ``penalty`` / 2 * |weights|^2; None if steps do not get there.

    ``rows`` hold ``x`` (array), ``y`` (0 or 1) and ``w``. Steps are halved while they raise the loss.
    """
    total, positive, n = rows.agg(F.sum("w"), F.sum(F.col("w") * F.col("y")), F.count(F.lit(1))).first()
    if not total or not 0 < positive < total:
        return None
    ridge = np.array([0.0, *[penalty] * features])
    plain = np.zeros(features + 1)
    plain[0] = np.log(positive / (total - positive))
    warm = _start(rows, features, ridge, n, plain)
    for beta in (warm, plain):
        found = _descend(rows, beta, ridge, tolerance * total)
        if found is not None or warm is plain:
            return found
    return None


def _descend(rows: DataFrame, beta: np.ndarray, ridge: np.ndarray, least: float) -> np.ndarray | None:
    """Newton steps from ``beta`` until the gradient is at most ``least``."""
    step, best = None, np.inf
    for _ in range(STEPS):
        hessian, gradient, loss = _pass(rows, beta)
        loss += float(ridge @ beta**2) / 2
        if not np.isfinite(loss):
            return None
        if step is not None and loss > best * (1 + 1e-12):
            step /= 2
            if np.abs(step).max() < 1e-14:
                return None
            beta = beta - step
            continue
        best = loss
        gradient = gradient + ridge * beta
        if np.abs(gradient).max() <= least:
            return beta
        try:
            step = np.linalg.solve(hessian + np.diag(ridge), -gradient)
        except np.linalg.LinAlgError:
            return None
        if not np.isfinite(step).all():
            return None
        beta = beta + step
    return None


class NewtonLogistic:
    """Estimator with an L2 penalty on the weights, the intercept free; ``c`` is the inverse of its strength.

    Falls to the quasi-Newton solver for more than ``WIDEST`` features, and where steps find no minimum: a singular
    Hessian, a label that does not vary.
    """

    def __init__(self, label: str, weight_sum: float, weight: str | None = "weight", c: float = 1.0):
        self.label, self.weight_sum, self.weight, self.c = label, weight_sum, weight, c

    def fallback(self) -> LogisticRegression:
        """The loss there is a weighted mean, so the penalty is 1 / (c * sum of weights)."""
        extra = {"weightCol": self.weight} if self.weight else {}
        return LogisticRegression(
            labelCol=self.label, maxIter=1000, regParam=1.0 / (self.c * self.weight_sum), elasticNetParam=0.0, standardization=False, **extra
        )

    def fit(self, ready: DataFrame) -> Model:
        first = ready.select("features").first()
        if first is not None and first["features"].size <= WIDEST:
            weight = F.col(self.weight).cast("double") if self.weight else F.lit(1.0)
            rows = ready.select(vector_to_array("features").alias("x"), F.col(self.label).cast("double").alias("y"), weight.alias("w"))
            beta = minimise(materialise(rows, "newton"), first["features"].size, 1.0 / self.c)
            if beta is not None:
                return LogisticModel(weights=beta[1:].tolist(), bias=float(beta[0]))
        return self.fallback().fit(ready)
