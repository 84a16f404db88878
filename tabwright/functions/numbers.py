"""Number expressions: parsing, rounding, clipping, guarded ratios, formatting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text forms a lenient numeric parse accepts.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INFINITY_PATTERN = r"(?i)^[+-]?inf(inity)?$"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """Missing is NULL everywhere: Spark would sort NaN above every number."""
    return F.nanvl(col_of(c).cast("double"), F.lit(None).cast("double"))


def missing_as_null(df: DataFrame, c: str) -> Column:
    """The column with NaN as NULL and its type kept; a column that cannot hold NaN stays bare."""
    kind = df.schema[c].dataType
    return F.nanvl(F.col(c), F.lit(None).cast(kind)) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.col(c)


def parse_number(c: str | Column) -> Column:
    """Text to double, NULL where it is not a plain number.

    A bare ``try_cast`` also takes Java forms such as ``7d``, so the text is matched first.
    """
    text = F.trim(col_of(c).cast("string"))
    numeric = text.rlike(NUMBER_PATTERN) | text.rlike(INFINITY_PATTERN)
    return F.when(numeric, text.try_cast("double"))


def clip(c: str | Column, lo: float, hi: float) -> Column:
    """Bound to ``[lo, hi]``; missing stays missing (greatest/least alone skip NULL)."""
    x = nan_to_null(c)
    return F.when(x.isNotNull(), F.greatest(F.lit(float(lo)), F.least(x, F.lit(float(hi)))))


def round_half_even(c: str | Column, digits: int = 0) -> Column:
    return F.bround(col_of(c), digits)


def safe_ratio(a: str | Column, b: str | Column, otherwise: float = 1.0) -> Column:
    """``a / b``, or ``otherwise`` where the divisor is zero; missing where either side is."""
    return F.when((col_of(b) == 0) & col_of(a).isNotNull(), F.lit(float(otherwise))).otherwise(F.try_divide(col_of(a), col_of(b)))


def linear_score(intercept: float, weights: dict[str, float]) -> Column:
    """``intercept + sum(weight * column)``."""
    total = F.lit(float(intercept))
    for name, weight in weights.items():
        total = total + F.col(name) * F.lit(float(weight))
    return total


def flag_equal(c: str | Column, value, yes="Yes", no="No") -> Column:
    """``yes`` where the column equals ``value``; everything else, missing included, is ``no``."""
    return F.when(col_of(c) == F.lit(value), F.lit(yes)).otherwise(F.lit(no))


def money(c: str | Column, digits: int = 2) -> Column:
    """``1,234.56``"""
    return F.format_number(col_of(c), digits)


def fixed(c: str | Column, digits: int = 4) -> Column:
    """``0.1234``"""
    return F.format_string(f"%.{digits}f", col_of(c))


def scientific(c: str | Column, digits: int = 4) -> Column:
    """``2.5099e-30``"""
    return F.format_string(f"%.{digits}e", col_of(c))


def percent(c: str | Column, digits: int = 2) -> Column:
    """A share as ``86.37%``"""
    return F.format_string(f"%.{digits}f%%", col_of(c) * 100)


def one_line(c: str | Column) -> Column:
    """Newlines become blanks."""
    return F.translate(col_of(c), "\n", " ")


def stamp(pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """The current time as text."""
    return F.date_format(F.current_timestamp(), pattern)
