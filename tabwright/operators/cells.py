"""Forests and boosting on cells: rows of one label and weight whose features fall into the same bins are one weighted row.

Trees see their features in at most ``BINS`` bins whatever the number of rows, so rows of one cell are alike to every
split. A cell with its number of rows gives the sums that its rows would give, and many rows have few cells, at most the
bins' combinations; where none coincide, a cell is a row. All rows are counted, both for the bins' edges and in the cells.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target, keyword_only
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.operators.quantiles import quantiles
from tabwright.session import materialise

BINS = 32  # as many as Spark's trees take by default
WIDEST = 64  # features; rows of more seldom share a cell, and are left as they are
FEW = 1_000  # values of a feature up to which they are counted one by one
AT_ONCE = 8  # trees that are fitted at the same time
ROWS_AT_ONCE = 250_000  # of a part
FROM = 500_000  # rows; fewer are fitted as they are, since their cells are hardly fewer and a job for each tree costs more


class Binned(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``binned``, the vector of each feature's bin: the number of its edges that are not above it."""

    edges = Param(Params._dummy(), "edges", "edges of each feature in order, as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, edges=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        every = [F.array(*map(F.lit, map(float, own))).cast("array<double>") for own in json.loads(self.getOrDefault("edges"))]
        # The vector is taken apart once a row; a term for each edge would do it anew for every edge.
        bins = F.zip_with(vector_to_array("features"), F.array(*every), lambda x, own: F.size(F.filter(own, lambda e: e <= x)).cast("double"))
        return df.withColumn("binned", array_to_vector(bins))


def _edges_between(counts: list[tuple[float, int]]) -> list[float]:
    """Edges halfway between neighbouring values: all of them, or those next to equal shares of the rows."""
    values, times = [v for v, _ in counts], [n for _, n in counts]
    places = range(1, len(values))
    if len(values) > BINS:
        below = np.cumsum(times)
        places = sorted({min(max(int(np.argmin(np.abs(below - below[-1] * k / BINS))) + 1, 1), len(values) - 1) for k in range(1, BINS)})
    return [values[i - 1] / 2 + values[i] / 2 for i in places]


def fit_bins(ready: DataFrame, width: int) -> Binned:
    """Edges at equal shares of all rows, exact and the same for any partitioning."""
    names = [f"x{i}" for i in range(width)]
    slots = ready.select(vector_to_array("features").alias("_x")).select(*[F.col("_x")[i].alias(n) for i, n in enumerate(names)])
    sizes = slots.agg(*[F.approx_count_distinct(n).alias(n) for n in names]).first()
    few, many = [n for n in names if sizes[n] <= FEW], [n for n in names if sizes[n] > FEW]
    edges: dict[str, list[float]] = {n: [] for n in names}
    if few:
        cells = slots.select(F.explode(F.array(*[F.struct(F.lit(n).alias("variable"), F.col(n).alias("x")) for n in few])).alias("_c")).select("_c.*")
        counted = cells.groupBy("variable", "x").agg(F.count(F.lit(1)).alias("n")).collect()
        for n in few:
            edges[n] = _edges_between(sorted((r["x"], r["n"]) for r in counted if r["variable"] == n))
    if many:
        # Written as plain numbers: the many comparisons there would each take them out of the vector again.
        for r in quantiles(materialise(slots.select(*many), "slots"), many, [k / BINS for k in range(1, BINS)]).collect():
            edges[r["variable"]].append(r["value"])
    return Binned(edges=json.dumps([sorted(set(edges[n])) for n in names]))


@dataclass(frozen=True)
class Cells:
    """Cells ``(label, _weight, binned, _n)``, how many there are, and the stage that gives a row its bins."""

    bins: Binned
    rows: DataFrame
    size: int


def cells_of(ready: DataFrame, label: str, weight: str | None = "weight") -> Cells | None:
    """The cells of prepared rows; None for few rows or many features, which trees take as they are."""
    first = ready.select("features").first()
    if first is None or first["features"].size > WIDEST or ready.count() < FROM:
        return None
    bins = fit_bins(ready, first["features"].size)
    own = F.col(weight).cast("double") if weight else F.lit(1.0)
    place = vector_to_array("binned", "float32")
    binned = bins.transform(ready.select(label, own.alias("_weight"), "features")).select(label, "_weight", place.alias("_place"))
    counted = binned.groupBy(label, "_weight", "_place").agg(F.count(F.lit(1)).alias("_n"))
    rows = materialise(counted.select(label, "_weight", array_to_vector(F.col("_place").cast("array<double>")).alias("binned"), "_n"), "cells")
    return Cells(bins, rows, rows.count())


def in_fixed_order(ready: DataFrame, label: str, rows_at_once: int = ROWS_AT_ONCE) -> DataFrame:
    """Prepared rows dealt and sorted by their own values, in as many parts as their number asks for.

    Trees draw rows by their place in a part; this way the draw is the same on any cluster and after any retry.
    """
    parts = max(8, -(-ready.count() // rows_at_once))
    return _dealt(ready, F.xxhash64(F.col(label), vector_to_array("features")), parts)


def _dealt(rows: DataFrame, key: Column, parts: int) -> DataFrame:
    return rows.withColumn("_key", key).repartition(parts, "_key").sortWithinPartitions("_key").drop("_key")


def _key(label: str) -> Column:
    return F.xxhash64(F.col(label), F.col("_weight"), vector_to_array("binned"))


def _drawn(cells: DataFrame, label: str, trees: int, seed: int) -> DataFrame:
    """Each cell with the number of its rows that each tree draws: a Poisson draw per row, summed over the cell's.

    The draws of a cell come from a generator of its own, keyed by its values.
    """
    names = [f"_d{t}" for t in range(trees)]
    source = cells.select(label, "_weight", vector_to_array("binned").alias("_place"), "_n", _key(label).alias("_key"))
    kept = [f for f in source.schema if f.name not in ("_n", "_key")]

    def draw(batches):
        for batch in batches:
            n, key = batch.column("_n").to_numpy(), batch.column("_key").to_numpy().view(np.uint64)
            draws = np.empty((trees, batch.num_rows), np.int64)
            for i in range(batch.num_rows):
                draws[:, i] = np.random.Generator(np.random.Philox(key=[np.uint64(seed), key[i]])).poisson(n[i], trees)
            columns = [*[batch.column(f.name) for f in kept], *map(pa.array, draws)]
            yield pa.RecordBatch.from_arrays(columns, names=[*[f.name for f in kept], *names])

    schema = T.StructType([*kept, *[T.StructField(n, T.LongType()) for n in names]])
    return source.mapInArrow(draw, schema).withColumn("binned", array_to_vector("_place")).drop("_place")


class CellForest:
    """Bagged trees, each with its own draw of rows and a root of the features at every node."""

    def __init__(self, label: str, weight: str | None, trees: int, depth: int, seed: int):
        self.label, self.weight, self.trees, self.depth, self.seed = label, weight, trees, depth, seed

    def fallback(self) -> RandomForestClassifier:
        extra = {"weightCol": self.weight} if self.weight else {}
        return RandomForestClassifier(labelCol=self.label, numTrees=self.trees, maxDepth=self.depth, seed=self.seed, **extra)

    def fit(self, ready: DataFrame, cells: Cells | None = None) -> Model:
        cells = cells or cells_of(ready, self.label, self.weight)
        if cells is None:
            return self.fallback().fit(in_fixed_order(ready, self.label))
        parts = max(1, -(-cells.size // ROWS_AT_ONCE))
        drawn = materialise(_drawn(cells.rows, self.label, self.trees, self.seed), "draws")
        classes = int(drawn.agg(F.max(self.label)).first()[0] or 0) + 1
        # A tree's draw may lack a class; the number of classes is told by the column.
        label = F.col(self.label).cast("double").alias(self.label, metadata={"ml_attr": {"type": "nominal", "num_vals": max(2, classes)}})
        ordered = _dealt(drawn, _key(self.label), parts).persist(StorageLevel.MEMORY_AND_DISK)

        def one(t: int):
            own = ordered.where(F.col(f"_d{t}") > 0).select(label, "binned", (F.col("_weight") * F.col(f"_d{t}")).alias("_w"))
            tree = RandomForestClassifier(
                labelCol=self.label, featuresCol="binned", weightCol="_w", numTrees=1, bootstrap=False,
                featureSubsetStrategy="sqrt", maxDepth=self.depth, maxBins=BINS, seed=self.seed * 1_000_003 + t,
            )
            return tree.fit(own)

        ordered.count()
        with ThreadPool(min(AT_ONCE, self.trees)) as pool:
            fitted = pool.map(inheritable_thread_target(ready.sparkSession)(one), range(self.trees), 1)
        ordered.unpersist()
        return PipelineModel([cells.bins, _united(ready, fitted)])


def _united(ready: DataFrame, fitted: list[RandomForestClassificationModel]) -> RandomForestClassificationModel:
    """One forest of forests with a tree each."""
    context = ready.sparkSession.sparkContext
    of = context._jvm.org.apache.spark.ml.classification
    trees = context._gateway.new_array(of.DecisionTreeClassificationModel, len(fitted))
    for i, m in enumerate(fitted):
        trees[i] = m._call_java("trees")[0]
    whole = of.RandomForestClassificationModel(fitted[0].uid, trees, fitted[0].numFeatures, fitted[0].numClasses)
    model = RandomForestClassificationModel(whole)
    return model._set(featuresCol="binned", labelCol=fitted[0].getLabelCol(), numTrees=len(fitted), maxDepth=fitted[0].getMaxDepth())


class CellBoosting:
    """Boosted trees on cells, each weighing as many rows as it has."""

    def __init__(self, label: str, rounds: int, rate: float, depth: int, seed: int):
        self.label, self.options = label, {"labelCol": label, "maxIter": rounds, "stepSize": rate, "maxDepth": depth, "seed": seed}

    def fit(self, ready: DataFrame, cells: Cells | None = None) -> Model:
        cells = cells or cells_of(ready, self.label, None)
        if cells is None:
            return GBTClassifier(**self.options).fit(in_fixed_order(ready, self.label))
        parts = max(8, -(-cells.size // ROWS_AT_ONCE))
        rows = _dealt(cells.rows, _key(self.label), parts).withColumn("_w", F.col("_n").cast("double"))
        model = GBTClassifier(featuresCol="binned", weightCol="_w", maxBins=BINS, **self.options).fit(rows)
        return PipelineModel([cells.bins, model])
