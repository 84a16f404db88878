"""Tail probabilities of the t and F distributions as column expressions.

Both are regularised incomplete beta functions. Spark ships commons-math on its
class path and ``java_method`` reaches it from SQL, so no Python worker is started.
These run on one row per test, after all aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BETA = "org.apache.commons.math3.special.Beta"


def _regularized_beta(x: Column, a: Column, b: Column) -> Column:
    known = x.isNotNull() & a.isNotNull() & b.isNotNull()
    # java_method throws on NULL arguments, so they are replaced and the result masked.
    safe = [F.coalesce(c, F.lit(0.5)) for c in (x, a, b)]
    value = F.call_function("java_method", F.lit(_BETA), F.lit("regularizedBeta"), *safe)
    return F.when(known, value.cast("double"))


def two_sided_t(t: Column, dof: Column) -> Column:
    """P(|T| >= |t|)."""
    return _regularized_beta(F.try_divide(dof, dof + t * t), dof / 2, F.lit(0.5))


def upper_f(f: Column, d1: Column, d2: Column) -> Column:
    """P(F >= f)."""
    d1, d2 = d1.cast("double"), d2.cast("double")
    return _regularized_beta(F.try_divide(d2, d2 + d1 * f), d2 / 2, d1 / 2)
