"""Row numbers over a whole table without one task seeing all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabwright.session import materialise


def row_position(df: DataFrame, key: str, name: str = "position") -> DataFrame:
    """0-based position of each row in the order of a unique ``key`` of any type that sorts.

    The rows are sorted into ranges of even size, whatever the keys' spread, and written
    with their place in their range; the ranges, one row for each sorting task, are summed
    up and their starts added.
    """
    place = F.monotonically_increasing_id()  # the task in the upper bits, the row in the lower 33
    ranges = materialise(df.orderBy(key).withColumn("_place", place), "row-position")
    counts = ranges.groupBy(F.shiftright("_place", 33).alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    local = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    joined = ranges.join(F.broadcast(starts), F.shiftright("_place", 33) == F.col("_range"))  # one row per sorting task
    return joined.withColumn(name, F.col("_start") + local).drop("_place", "_range", "_start")


def file_position(df: DataFrame, name: str = "position") -> DataFrame:
    """0-based position of each row in its table, files by path, from a scan of a format that keeps it, as Parquet does.

    A row's place in its file is added to its file's start, which comes from the files' own row counts.
    """
    counts = df.groupBy(F.col("_metadata.file_path").alias("_file")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    starts = counts.select("_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    placed = df.withColumns({name: F.col("_metadata.row_index"), "_file": F.col("_metadata.file_path")}).join(starts, "_file")
    return placed.withColumn(name, F.col("_start") + F.col(name)).drop("_file", "_start")
