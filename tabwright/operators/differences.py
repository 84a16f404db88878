"""Which rows of two tables differ, without joining the tables.

Both sides are cut into leaves by a hash of the key, and each leaf is summed up by its number of rows and two sums of row
hashes, in one pass a side. Leaves are the lowest level of a tree whose nodes sum their children; the descent from the
root visits unequal nodes only. The rows of unequal leaves, few where few rows differ, are then compared key by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.session import materialise

FAN_OUT = 16
DEPTH = 4  # levels below the root: 65,536 leaves


def _leaf(key: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(FAN_OUT**DEPTH)).cast("int")


def _leaves(df: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``(leaf, n, a, b)``: at most ``FAN_OUT ** DEPTH`` rows."""
    sums = [F.sum(F.xxhash64(F.lit(salt), *cols).cast("decimal(38,0)")).alias(name) for salt, name in ((1, "a"), (2, "b"))]
    return df.groupBy(_leaf(key).alias("leaf")).agg(F.count(F.lit(1)).alias("n"), *sums)


def unequal_leaves(left: DataFrame, right: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``(leaf)`` of those whose rows differ, found from the root of the tree downwards."""
    both = _leaves(left, key, cols).select("leaf", "n", "a", "b").unionByName(
        _leaves(right, key, cols).select("leaf", (-F.col("n")).alias("n"), (-F.col("a")).alias("a"), (-F.col("b")).alias("b"))
    )
    leaves = materialise(both.groupBy("leaf").agg(F.sum("n").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b")), "leaves")
    open_ = leaves
    for level in range(DEPTH):
        node = F.expr(f"leaf div {FAN_OUT ** (DEPTH - level - 1)}").cast("int")
        nodes = open_.groupBy(node.alias("node")).agg(F.sum("n").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))
        differ = F.broadcast(nodes.where("n <> 0 or a <> 0 or b <> 0").select("node"))  # at most one row a node
        open_ = open_.withColumn("node", node).join(differ, "node", "left_semi").drop("node")
    return open_.select("leaf")


def differing_rows(left: DataFrame, right: DataFrame, key: Sequence[str], compared=None) -> DataFrame:
    """``(key..., status, columns)``: keys that are only in ``left`` (``removed``) or ``right`` (``added``), and those whose
    other columns differ (``changed``, with their names).

    Both sides have the same columns. Missing equals missing. A key that occurs several times on a side is compared as
    the bag of its rows: it is ``changed`` if the bags differ, and then its columns are those whose bags differ.
    ``compared`` is called with the two frames of rows that are compared one by one.
    """
    key = list(key)
    cols = list(left.columns)
    if sorted(cols) != sorted(right.columns):
        raise ValueError("the two sides have different columns")
    others = [c for c in cols if c not in key]
    leaves = F.broadcast(materialise(unequal_leaves(left, right, key, cols), "unequal"))  # at most FAN_OUT ** DEPTH rows
    sides = [materialise(df.select(*cols).withColumn("_leaf", _leaf(key)).join(leaves, F.col("_leaf") == F.col("leaf"), "left_semi").drop("_leaf"), "differing") for df in (left, right)]
    if compared:
        compared(*sides)
    # A bag of values is its number and the sums of two hashes of each.
    marks = [a for i, c in enumerate(others) for a in (F.sum(F.xxhash64(F.lit(1), c).cast("decimal(38,0)")).alias(f"_a{i}"), F.sum(F.xxhash64(F.lit(2), c).cast("decimal(38,0)")).alias(f"_b{i}"))]
    whole = [F.sum(F.xxhash64(F.lit(s), *cols).cast("decimal(38,0)")).alias(f"_w{s}") for s in (1, 2)]
    keyed = [s.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), *whole, *marks).alias(side) for s, side in zip(sides, "lr", strict=True)]
    same = F.lit(True)
    for k in key:
        same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    joined = keyed[0].join(keyed[1], same, "full_outer")
    unequal = [F.when(~(F.col(f"l._a{i}").eqNullSafe(F.col(f"r._a{i}")) & F.col(f"l._b{i}").eqNullSafe(F.col(f"r._b{i}"))), F.lit(c)) for i, c in enumerate(others)]
    differ = ~F.col("l._n").eqNullSafe(F.col("r._n"))
    for s in (1, 2):
        differ = differ | ~F.col(f"l._w{s}").eqNullSafe(F.col(f"r._w{s}"))
    status = F.when(F.col("r._n").isNull(), "removed").when(F.col("l._n").isNull(), "added").otherwise("changed")
    columns = F.when(status == "changed", F.array_compact(F.array(*unequal)) if unequal else F.array().cast("array<string>"))
    # A key of nulls is coalesced like any other: both sides of a match are equal.
    return joined.where(differ).select(*[F.coalesce(f"l.{k}", f"r.{k}").alias(k) for k in key], status.alias("status"), columns.alias("columns"))
