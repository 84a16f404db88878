"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.session import materialise


def _tied_to_least(neighbours: DataFrame) -> DataFrame:
    """Each ``u``'s neighbours ``v`` with the least of them and ``u`` itself.

    The least is found by a map-side aggregate and joined back, so that the neighbours of one hot vertex stay spread.
    """
    least = neighbours.groupBy("u").agg(F.min("v").alias("least"))
    return neighbours.join(least, "u").select("u", "v", F.least("u", "least").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _tied_to_least(both).where("v > u and v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    tied = _tied_to_least(links)
    return tied.select("v", "m").union(tied.select(F.col("u").alias("v"), "m")).where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(vertex, component)`` for every vertex that a link touches; a component's id is its smallest vertex.

    Links are unordered; loops, repeats and links with a null end say nothing. No links give no rows. Each round is a
    written table; at the end every vertex hangs on its component's smallest one. Rounds grow with the logarithm of the
    longest chain, and no round has more rows than there are links and vertices.
    """
    ends = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    ends = materialise(ends.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v"))).distinct(), "links")
    state = None
    while True:
        ends = materialise(_small_star(_large_star(ends)), "links")
        mark = F.xxhash64("u", "v")
        now = ends.agg(F.count("*"), F.bit_xor(mark), F.bit_xor(F.xxhash64(mark, F.lit(1)))).first()
        if now == state or not now[0]:
            break
        state = now
    low = ends.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    return ends.select(F.col("u").alias("vertex"), F.col("v").alias("component")).union(low)
