"""Exact quantiles without sorting the data or gathering a group in one task.

Spark's ``percentile`` keeps a value-to-count map per group in one buffer, which grows
with the number of distinct values. Here a mergeable sketch of bounded size, all columns
in one aggregate, first gives a bracket around each wanted rank, whatever the
distribution. A second pass counts the rows between the brackets, and the rows inside
them per distinct value: a fixed small share of the rows is left, and a hot value is one
row. Without groups only those rows leave the scan; the others are conditional counts.
While more than ``ranked`` values of a group are left, their own equal-depth cuts narrow
them again. Only then are they ranked, and the ranks found prove the brackets right; if
one is not there, the brackets are widened and counted again. The same path serves every
size. A kept sketch of the same rows can stand in for the first pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil, floor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tabwright.functions.numbers import nan_to_null
from tabwright.session import materialise

GRID = 1_000  # cuts that narrow a group with too many values left
ACCURACY = 10_000  # their ranks are off by at most a 10,000th of the cells
DEPTH = 8_192  # size of the first sketch: its ranks are off by a 1,470th of the rows or less in 99 of 100 cases
#: Half the width of a bracket, as a share of the rows, and the rows from which it is wide enough; the last holds all.
LEVELS = ((0.0017, 2_000), (0.05, 50), (1.0, 0))
AT_ONCE = 16  # columns whose stretches are counted in one aggregate


def _long(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per non-missing value: ``(by..., variable, x)``."""
    keep = [F.col(b) for b in by]
    if len(cols) == 1:
        rows = df.where(F.col(cols[0]).isNotNull()).select(*keep, F.lit(cols[0]).alias("variable"), nan_to_null(cols[0]).alias("x"))
    else:
        cells = F.array(*[F.struct(F.lit(c).alias("variable"), nan_to_null(c).alias("x")) for c in cols])
        rows = df.select(*keep, F.explode(cells).alias("_cell")).select(*by, "_cell.variable", "_cell.x")
    return rows.where(F.col("x").isNotNull())


def _ranks(wanted: Column) -> Column:
    """The 0-based ranks the wanted quantiles of ``n`` values stand at, or between."""
    position = F.transform(wanted, lambda q: q * (F.col("n") - 1))
    return F.array_distinct(F.flatten(F.transform(position, lambda p: F.array(F.floor(p), F.ceil(p)))))


def sketch_of(x: str | Column) -> Column:
    return F.kll_sketch_agg_double(x, DEPTH)


def sketched(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., variable, n, sketch)``: rows that are not missing, and their sketch, of all columns in one aggregate."""
    aggs = [a.alias(f"{k}{i}") for i, c in enumerate(cols) for k, a in (("_n", F.count(nan_to_null(c))), ("_s", sketch_of(nan_to_null(c))))]
    cells = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"_n{i}").alias("n"), F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(cols)])
    wide = df.groupBy(*by).agg(*aggs)
    return wide.select(*by, F.explode(cells).alias("_c")).select(*by, "_c.*").where("n > 0")


def _spans(sketch: DataFrame, keys: Sequence[str], qs: Sequence[float], wider: int) -> DataFrame:
    """Per wanted quantile the two cuts that its two ranks surely lie between, or ``wider`` ones."""
    places = [min(max(q + side * level, 0.0), 1.0) for q in qs for level, _ in LEVELS for side in (-1, 1)]
    cuts = sketch.select(*keys, "n", F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, places))).alias("cuts"))
    level = F.lit(len(LEVELS) - 1)
    for i, (_, least) in reversed(list(enumerate(LEVELS))):
        level = F.when(F.col("n") >= least, i).otherwise(level)
    level = F.least(level + wider, F.lit(len(LEVELS) - 1))

    def cut(i: int, side: int) -> Column:
        return F.get("cuts", F.lit(2 * len(LEVELS) * i + side) + 2 * level)

    return cuts.select(*keys, "n", F.array(*[F.struct(cut(i, 0).alias("lo"), cut(i, 1).alias("hi")) for i in range(len(qs))]).alias("spans"))


def _counted(rows: DataFrame, keys: Sequence[str], spans: int) -> DataFrame:
    """Rows inside a span counted per value, the others per stretch between spans; ``at`` puts them in order."""
    edges = [(F.col("spans")[i]["lo"], F.col("spans")[i]["hi"]) for i in range(spans)]
    inside = reduce(Column.__or__, ((F.col("x") >= lo) & (F.col("x") <= hi) for lo, hi in edges), F.lit(False))
    stretch = sum(((lo <= F.col("x")).cast("int") for lo, _ in edges), F.lit(0))
    cells = rows.select(*keys, "n", "x", F.when(inside, F.col("x")).alias("value"), F.when(~inside, stretch).alias("stretch"))
    return cells.groupBy(*keys, "n", "value", "stretch").agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("at"))


def _counted_wide(df: DataFrame, few: Sequence) -> DataFrame:
    """The same without groups, from spans on the driver: conditional counts, and an explode of the values inside."""
    counts, cells = [], []
    for k in range(0, len(few), AT_ONCE):
        aggs = []
        for i, r in enumerate(few[k : k + AT_ONCE]):
            x, spans = nan_to_null(r["variable"]), sorted((s["lo"], s["hi"]) for s in r["spans"])
            for t in range(len(spans) + 1):
                above = max((hi for _, hi in spans[:t]), default=None)
                if above is not None and t < len(spans) and above >= spans[t][0]:
                    continue
                outside = [*([] if above is None else [x > above]), *([x < spans[t][0]] if t < len(spans) else [])]
                here = reduce(Column.__and__, outside)
                aggs += [F.count_if(here).alias(f"c{i}_{t}"), F.min(F.when(here, x)).alias(f"at{i}_{t}")]
            inside = reduce(Column.__or__, (x.between(lo, hi) for lo, hi in spans))
            cells.append(F.when(inside, F.struct(F.lit(r["variable"]).alias("variable"), F.lit(r["n"]).alias("n"), x.alias("value"))))
        row = df.agg(*aggs).first().asDict()
        for i, r in enumerate(few[k : k + AT_ONCE]):
            for t in range(len(r["spans"]) + 1):
                if row.get(f"c{i}_{t}"):
                    counts.append((r["variable"], r["n"], None, t, row[f"c{i}_{t}"], row[f"at{i}_{t}"]))
    near = df.where(reduce(Column.__or__, (c.isNotNull() for c in cells))) if cells else df
    exploded = near.select(F.explode(F.array(*cells) if cells else F.expr("array(cast(null as struct<variable:string,n:bigint,value:double>))")).alias("_c"))
    held = exploded.where("_c is not null").select("_c.*").groupBy("variable", "n", "value").agg(F.count(F.lit(1)).alias("c"))
    held = held.select("variable", "n", "value", F.lit(None).cast("int").alias("stretch"), "c", F.col("value").alias("at"))
    schema = "variable string, n bigint, value double, stretch int, c bigint, at double"
    return held.unionByName(df.sparkSession.createDataFrame(counts, schema))


def _ranked(counted: DataFrame, keys: Sequence[str], wanted: Column) -> DataFrame:
    """The values that hold a wanted rank, with the ranks they hold."""
    w = Window.partitionBy(*keys).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("start", F.sum("c").over(w) - F.col("c"))
    held = F.filter(_ranks(wanted), lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("c")))
    return placed.where(F.col("value").isNotNull()).select(*keys, "n", held.alias("held"), F.col("value").alias("x")).where(F.size("held") > 0)


def _narrowed(counted: DataFrame, keys: Sequence[str], wanted: Column) -> DataFrame:
    """Counted cells once more, with only the values near a wanted rank kept apart."""
    cuts = counted.groupBy(*keys).agg(_cuts("at").alias("cuts"))
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
    cuts = cuts.select(*[F.col(k).alias(f"_{k}") for k in keys], "cuts")
    part = F.aggregate("cuts", F.lit(0), lambda n, x: n + (x <= F.col("at")).cast("int"))
    cells = materialise(counted.join(cuts, same).select(*counted.columns, part.alias("part")), "quantile-cells")
    w = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    parts = cells.groupBy(*keys, "n", "part").agg(F.sum("c").alias("c")).withColumn("start", F.sum("c").over(w) - F.col("c"))
    wanted_here = F.exists(_ranks(wanted), lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("c")))
    parts = parts.withColumn("near", wanted_here).withColumn("stretch", F.sum(F.col("near").cast("int")).over(w))
    near = parts.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("part").alias("_part"), "near", F.col("stretch").alias("_stretch"))
    marked = cells.join(near, same & (F.col("part") == F.col("_part")))
    kept = F.col("near") & F.col("value").isNotNull()
    # What is not kept: between two parts near a rank all is one cell; inside such a part each cell stays its own.
    gap = F.when(~kept, F.struct("_stretch", F.when(F.col("near"), F.col("at")).alias("at")))
    return marked.groupBy(*keys, "n", F.when(kept, F.col("value")).alias("value"), gap.alias("gap")).agg(F.sum("c").alias("c"), F.min("at").alias("at")).drop("gap")


def quantiles(
    df: DataFrame,
    cols: Sequence[str],
    qs: Sequence[float],
    by: Sequence[str] = (),
    method: str = "exact",
    accuracy: int = 10_000,
    ranked: int = 200_000,
    first_cut: DataFrame | None = None,
) -> DataFrame:
    """``(by..., variable, n, q, value)``: linear interpolation, missing skipped.

    ``method="exact"`` computes now and ranks at most ``ranked`` values of a group in one
    task. Its first scan is spared if ``first_cut`` holds the kept ``(by..., variable, n,
    sketch)`` of exactly these rows, as ``sketched`` gives them. ``"approx"`` is the lazy
    one-pass sketch with rank error ``1 / accuracy``.
    """
    qs = [float(q) for q in qs]
    if any(not 0.0 <= q <= 1.0 for q in qs):
        raise ValueError("quantiles must lie in [0, 1]")
    if method not in ("exact", "approx"):
        raise ValueError(f"unknown method {method!r}")
    keys = [*by, "variable"]
    long = _long(df, cols, by)
    wanted = F.array(*[F.lit(q) for q in qs])
    if method == "approx":
        sketch = long.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.percentile_approx("x", qs, accuracy).alias("_v")
        )
        cells = F.explode(F.arrays_zip(wanted.alias("q"), F.col("_v").alias("value")))
        return sketch.select(*keys, "n", cells.alias("_c")).select(*keys, "n", "_c.q", "_c.value")

    found = _values_at(df, long, cols, by, qs, wanted, ranked, first_cut)
    pairs = F.transform("held", lambda r: F.struct(r.alias("rank"), F.col("x").alias("value")))
    by_rank = found.groupBy(*keys, "n").agg(
        F.map_from_entries(F.flatten(F.collect_list(pairs))).alias("_at")
    )
    pos = F.col("q") * (F.col("n") - 1)
    low, high = F.col("_at")[F.floor(pos)], F.col("_at")[F.ceil(pos)]
    # Equal neighbours skip the arithmetic: it would turn infinities into NaN.
    value = F.when(low == high, low).otherwise(low + (high - low) * (pos - F.floor(pos)))
    return by_rank.withColumn("q", F.explode(wanted)).select(*keys, "n", "q", value.alias("value"))


def _cuts(column: str) -> Column:
    places = ",".join(f"{i / GRID}D" for i in range(GRID + 1))
    return F.expr(f"percentile_approx({column}, array({places}), {ACCURACY})")


def _values_at(
    df: DataFrame, long: DataFrame, cols: Sequence[str], by: Sequence[str], qs: Sequence[float], wanted: Column, ranked: int, first_cut: DataFrame | None
) -> DataFrame:
    """``(keys..., n, held, x)``: the wanted ranks and the value that stands there."""
    keys = [*by, "variable"]
    sketch = sketched(df, cols, by) if first_cut is None else first_cut.where((F.col("n") > 0) & F.col("variable").isin(*cols)).select(*keys, "n", "sketch")
    if first_cut is None:
        sketch = materialise(sketch, "quantile-groups")
    for wider in range(len(LEVELS)):
        spans = _spans(sketch, keys, qs, wider)
        if by:
            same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
            rows = long.join(spans.select(*[F.col(k).alias(f"_{k}") for k in keys], "n", "spans"), same).select(*keys, "n", "x", "spans")
            counted = materialise(_counted(rows, keys, len(qs)), "quantile-cells")
        else:
            few = spans.collect()  # without groups, a row per column asked for
            counted = materialise(_counted_wide(df, few), "quantile-cells")
        while _most(counted, keys, ranked) > ranked:
            counted = materialise(_narrowed(counted, keys, wanted), "quantile-cells")
        found = _ranked(counted, keys, wanted)
        if not by:
            held = found.collect()  # two rows per column and quantile at most
            have = {v: sum(len(r["held"]) for r in held if r["variable"] == v) for v in (r["variable"] for r in few)}
            need = {r["variable"]: len({f(q * (r["n"] - 1)) for q in qs for f in (floor, ceil)}) for r in few}
            if have == need:
                return _rows(df.sparkSession, held, found.schema)
        else:
            found = materialise(found, "quantile-values")
            proven = found.groupBy(*keys, "n").agg(F.sum(F.size("held")).alias("have")).where(F.col("have") == F.size(_ranks(wanted)))
            if proven.count() == sketch.count():
                return found
    raise ValueError("the first cut is not of these rows")


def _rows(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """A handful of rows as literals in the plan."""
    cells = F.array(*[F.struct(*[F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in schema]) for r in rows]).cast(T.ArrayType(schema))
    return spark.range(1).select(F.inline(cells))


def _most(counted: DataFrame, keys: Sequence[str], ranked: int) -> int:
    """The cells of the largest group; all of them, from the file footers, where that is few enough."""
    total = counted.count()
    return total if total <= ranked else counted.groupBy(*keys).count().agg(F.max("count")).first()[0]


def quantile_row(df: DataFrame, col: str, names: dict[str, float], **options) -> DataFrame:
    """The quantiles of one column as a one-row frame with a column per name."""
    q = quantiles(df, [col], sorted(set(names.values())), **options)
    return q.agg(*[F.max(F.when(F.col("q") == F.lit(float(v)), F.col("value"))).alias(k) for k, v in names.items()])


def quantile_point(df: DataFrame, col: str, q: float, **options) -> Column:
    """One quantile as a scalar subquery, usable in any expression."""
    return quantile_row(df, col, {"value": q}, **options).scalar()


def median_point(df: DataFrame, col: str, **options) -> Column:
    return quantile_point(df, col, 0.5, **options)
