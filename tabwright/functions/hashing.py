"""Uniform and normal draws computed from a row key.

``rand()`` depends on how rows fall into partitions, so a lost executor or another
cluster size changes the draw. A digest of (seed, name, key) does not.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabwright.functions.numbers import col_of

_DIGITS = 12  # hex digits used: 48 bits, exact in a double


def digest(key: str | Column, seed: int, name: str = "") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:{name}:"), col_of(key).cast("string")))


def uniform(key: str | Column, seed: int, name: str) -> Column:
    """In [0, 1)."""
    head = F.conv(F.substring(digest(key, seed, name), 1, _DIGITS), 16, 10)
    return head.cast("bigint").cast("double") / F.lit(float(16**_DIGITS))


def standard_normal(key: str | Column, seed: int, name: str) -> Column:
    """Box-Muller on two uniforms; ``1 - u`` keeps the logarithm finite."""
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - uniform(key, seed, name + "/r")))
    return radius * F.cos(F.lit(2.0 * math.pi) * uniform(key, seed, name + "/a"))


def weighted_choice(u: Column, values: list[str], weights: list[float]) -> Column:
    """Pick by cumulative weight; the last value takes the rest."""
    edge, pick = 0.0, None
    for value, weight in zip(values[:-1], weights[:-1], strict=True):
        edge += weight
        test = u < F.lit(edge)
        pick = F.when(test, F.lit(value)) if pick is None else pick.when(test, F.lit(value))
    return F.lit(values[0]) if pick is None else pick.otherwise(F.lit(values[-1]))
