"""Joins whose left side may hold very frequent keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that hold this share of the rows are sent to the rows instead; there are at most so many of them.
MOST_HOT = 2_000


def least_hot(total: int) -> int:
    """Rows from which a key counts as hot: at most ``MOST_HOT`` keys of ``total`` rows have as many."""
    return max(2, -(-total // MOST_HOT))


def join_hot_apart(rows: DataFrame, keyed: DataFrame, on: list[str], times: str, total: int) -> DataFrame:
    """``rows.join(keyed, on)`` that keeps the rows of a frequent key where they are.

    ``keyed`` has one row for a key, with the key's number of rows in ``times``; ``total`` is the number of all rows. Keys
    of at least 1 / ``MOST_HOT`` of them, ``MOST_HOT`` at most by counting, are broadcast; the other rows are shuffled, and
    no key of theirs holds more than that share. Both inputs should be written tables: they are read twice.
    """
    hot = F.broadcast(keyed.where(F.col(times) >= least_hot(total)))
    cold = rows.join(hot.select(*on), on, "left_anti")
    return rows.join(hot, on).unionByName(cold.join(keyed.where(F.col(times) < least_hot(total)), on))
