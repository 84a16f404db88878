"""Whitening of vectors from an exact covariance, summed by bit-sliced scatter.

Each component c becomes the integer floor(``scale`` * c) + ``shift``. Integers sum without error in any order, so the fit
is the same on any cluster and after any retry:

1. One pass finds every dimension's least and largest integer, its sum and the number of vectors.
2. A second pass takes the integers less their dimension's least, and packs each bit plane of each dimension across rows
   into 64-bit words. The cross-product of two dimensions is the sum over their planes a, b of 2**(a + b) times the
   number of rows that hold both bits: an AND and a population count. Tasks send one exact sum for each two dimensions.
3. The scatter n * sum(y y') - S S' is centred in integers, divided by n**2 once, and handed to ``eigh``. Only numbers by
   dimension reach the driver, however many vectors there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.shipping import ship
from tabwright.session import materialise

ROWS_AT_ONCE = 16_384
EXACT = "decimal(38,0)"


@dataclass(frozen=True)
class Whitener:
    """What a fit learned: the integers' sums, and the projections by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    least: tuple[int, ...]
    vectors: np.ndarray  # one column a component
    values: np.ndarray
    trace: float
    covariance: np.ndarray
    scale: float
    shift: int


def usable(column: str) -> Column:
    """Vectors that are not null and hold finite components only."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.col(column).isNotNull() & fine


def _integers(column: pa.Array, scale: float, shift: int) -> np.ndarray:
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    scaled = np.floor(scale * flat)
    if len(scaled) and np.abs(scaled).max() >= 2.0**62:
        raise ValueError("a scaled component leaves the range of 64-bit integers")
    return scaled.astype(np.int64).reshape(len(column), -1) + shift


def _matrices(batches: Iterator[pa.RecordBatch], scale: float, shift: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            yield part, _integers(part.column("v"), scale, shift)


def _decimals(values) -> pa.Array:
    import decimal

    return pa.array([decimal.Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def _summed(scale: float, shift: int):
    """Task: count, least, largest and sum of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high, total = 0, None, None, None
        for _, x in _matrices(batches, scale, shift):
            if not len(x):
                continue
            least = x.min(axis=0)
            own = (x - least).astype(object).sum(axis=0) if (x.max(axis=0) - least).max() >= 2**45 else (x - least).sum(axis=0).astype(object)
            own = own + least.astype(object) * len(x)
            total = own if total is None else total + own
            low = least if low is None else np.minimum(low, least)
            high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
            n += len(x)
        if n:
            columns = [pa.array(range(len(low)), pa.int32()), pa.array([n] * len(low), pa.int64()), pa.array(low), pa.array(high), _decimals(total)]
            yield pa.RecordBatch.from_arrays(columns, ["dim", "n", "low", "high", "total"])

    return run


def bit_planes(y: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """Planes by 64-bit words: bit ``a`` of dimension ``d`` over all rows, for every ``a`` below ``widths[d]``."""
    words = -(-len(y) // 64)
    planes = np.zeros((int(widths.sum()), words * 8), np.uint8)
    at = 0
    for d, width in enumerate(widths.tolist()):
        for a in range(width):
            packed = np.packbits((y[:, d] >> a & 1).astype(np.uint8))
            planes[at, : len(packed)] = packed
            at += 1
    return planes.view(np.uint64)


def cross_products(planes: np.ndarray, widths: np.ndarray, weigh: np.ndarray) -> list[int]:
    """For all dimensions i <= j, row by row, the exact sum of products, by weighted AND-popcounts."""
    ends = np.cumsum(widths)
    starts = ends - widths
    powers = [1 << a for a in range(int(widths.max(initial=0)))]
    out = []
    for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
        counts = np.zeros((b - a, len(planes) - a), np.int64)
        for k in range(a, b):
            counts[k - a] = np.bitwise_count(planes[k] & planes[a:]).sum(axis=1, dtype=np.int64)
        rows = sum((counts[k].astype(object) * powers[k] for k in range(b - a)), np.zeros(len(planes) - a, object))
        weighted = rows * weigh[a:]
        out += [sum(weighted[c - a : d - a].tolist()) for c, d in zip(starts[i:].tolist(), ends[i:].tolist(), strict=True)]
    return out


def _scattered(least: tuple[int, ...], widths: np.ndarray, scale: float, shift: int):
    """Task: the sum of products of every two dimensions, over all its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, total = np.array(least, np.int64), None
        weigh = np.array([1 << a for w in widths.tolist() for a in range(w)], object)
        for _, x in _matrices(batches, scale, shift):
            if len(x):
                own = cross_products(bit_planes(x - low, widths), widths, weigh)
                total = own if total is None else [a + b for a, b in zip(total, own, strict=True)]
        if total:
            i, j = np.triu_indices(len(low))
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), _decimals(total)], ["i", "j", "total"])

    return run


def centred(n: int, sums: list[int], products: dict[tuple[int, int], int]) -> np.ndarray:
    """n * sum(y y') - S S', exact, as Python integers."""
    out = np.zeros((len(sums), len(sums)), object)
    for (i, j), total in products.items():
        out[i, j] = out[j, i] = n * total - sums[i] * sums[j]
    return out


def _vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    good = table.where(usable(vector_col) & (F.size(vector_col) > 0)).select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    sizes = good.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    return good.where(F.size("v") == (sizes[0]["size"] if sizes else -1))


def fit(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, scale: float = 64.0, shift: int = 1_000_000) -> Whitener | None:
    """Learns from all usable vectors of the most frequent length (of two, the longer); None if there is none."""
    ship(table.sparkSession)
    return _fit(_vectors(table, id_col, vector_col), scale, shift)


def _fit(vectors: DataFrame, scale: float, shift: int) -> Whitener | None:
    parts = vectors.select("v").mapInArrow(_summed(scale, shift), f"dim int, n long, low long, high long, total {EXACT}")
    dims = parts.groupBy("dim").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").alias("total")).orderBy("dim").collect()
    if not dims:
        return None
    n, least = dims[0]["n"], tuple(r["low"] for r in dims)
    sums = [int(r["total"]) - n * r["low"] for r in dims]
    widths = np.array([(r["high"] - r["low"]).bit_length() for r in dims])
    sent = vectors.select("v").mapInArrow(_scattered(least, widths, scale, shift), f"i int, j int, total {EXACT}")
    products = {(r["i"], r["j"]): int(r["total"]) for r in sent.groupBy("i", "j").agg(F.sum("total").alias("total")).collect()}
    exact = centred(n, sums, products)
    covariance = np.array([[int(x) / (n * n) for x in row] for row in exact], np.float64).reshape(len(dims), len(dims))
    values, columns = np.linalg.eigh(covariance)
    trace = sum(exact[i, i] for i in range(len(dims))) / (n * n)
    order = np.argsort(-values, kind="stable")
    return Whitener(n, tuple(int(r["total"]) for r in dims), least, columns[:, order], values[order], trace, covariance, scale, shift)


def _projected(model: Whitener, kept: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = model.vectors[:, :kept] / np.sqrt(model.values[:kept])
        farthest = max(abs(s) for s in model.sums)
        for part, x in _matrices(batches, model.scale, model.shift):
            if not len(x):
                continue
            # In 64 bits where nothing can leave them, else as Python integers: the same numbers.
            fits = model.n * int(np.abs(x).max()) + farthest < 2**62
            gap = model.n * (x if fits else x.astype(object)) - np.array(model.sums, np.int64 if fits else object)
            wide = not fits or x.shape[1] * int(np.abs(gap).max()) ** 2 >= 2**62
            deviation = ((gap.astype(object) if wide else gap) ** 2).sum(axis=1)
            white = (gap / model.n).astype(np.float64) @ turn
            lists = pa.FixedSizeListArray.from_arrays(pa.array(white.ravel()), kept).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), _decimals(deviation), lists], ["vec_id", "deviation", "whitened"])

    return run


def _grams(kept: int):
    """Task: count, sums and sums of products of its whitened vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((kept + 1, kept + 1))
        for batch in batches:
            white = np.column_stack([np.ones(batch.num_rows), batch.column("whitened").flatten().to_numpy().reshape(batch.num_rows, kept)])
            total += white.T @ white
        i, j = np.triu_indices(kept + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "total"])

    return run


def identity_error(white: DataFrame, kept: int) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity, measured on the vectors."""
    sums = white.select("whitened").mapInArrow(_grams(kept), "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect()
    gram = np.zeros((kept + 1, kept + 1))
    for r in sums:
        gram[r["i"], r["j"]] = gram[r["j"], r["i"]] = r["total"]
    mean = gram[0, 1:] / gram[0, 0]
    return float(np.abs(gram[1:, 1:] / gram[0, 0] - np.outer(mean, mean) - np.eye(kept)).max())


_OUT = f"component int, n long, deviation {EXACT}, whitened double, explained double, identity_error double"


def whiten(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, components: int = 32, scale: float = 64.0, shift: int = 1_000_000
) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``, a row for each vector and component.

    ``deviation`` is the exact sum over dimensions of (n * x - S)**2, S the dimension's sum over the n vectors of the fit;
    ``whitened`` the centred integers projected on the component, over the root of its eigenvalue; ``explained`` the
    eigenvalue's share of the trace; ``identity_error`` one number, measured on all whitened vectors. Components go by
    falling eigenvalue, up to ``components``. A direction without variance cannot be whitened: components whose
    eigenvalue is not above the rounding error of the largest are left out, so one vector alone, or copies of one, give
    no rows. A null vector, and one that holds a null, a NaN or an infinity, is dropped; so is one of another length than
    the most frequent (of two equally frequent the longer stays), for it has no place in one covariance, and one of no
    components. Repeated rows
    and rows without an id count and come out like any other. Components so large that the scaled integer leaves 62 bits
    fail the job. Other columns are not read; an empty table gives no rows.
    """
    spark = table.sparkSession
    ship(spark)
    id_type = table.schema[id_col].dataType.simpleString()
    vectors = _vectors(table, id_col, vector_col)
    model = _fit(vectors, scale, shift)
    noise = 0.0 if model is None else model.values[0] * len(model.values) * np.finfo(float).eps * 8
    kept = 0 if model is None else min(components, int((model.values > noise).sum()))
    if not kept:
        return spark.createDataFrame([], f"vec_id {id_type}, {_OUT}")
    white = materialise(vectors.mapInArrow(_projected(model, kept), f"vec_id {id_type}, deviation {EXACT}, whitened array<double>"), "whitened")
    shares = [float(v) for v in model.values[:kept] / model.trace]
    rows = white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.element_at(F.array(*map(F.lit, shares)), F.col("at") + 1)
    error = F.lit(identity_error(white, kept))
    n = F.lit(model.n).cast("bigint")
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), n.alias("n"), "deviation", "whitened", explained.alias("explained"), error.alias("identity_error"))
