"""Record contracts on a landing folder as a stream.

A check is stateless, so the batch expressions run unchanged on every micro-batch.
Valid and rejected rows go to two sinks, each with its own checkpoint below the folder the
caller names. A restart with that same folder goes on where the last run ended, so it
neither loses nor repeats a file; sinks and checkpoint belong together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabwright.operators.validate import Contract, check, error_rows, valid_rows


def landing_stream(spark: SparkSession, folder: str) -> DataFrame:
    """JSON Lines files as they land, one document per row in ``v``."""
    lines = spark.readStream.format("text").load(folder)
    return lines.select(F.try_parse_json("value").alias("v"))


def start_validation(
    stream: DataFrame, contract: Contract, valid_path: str, errors_path: str, checkpoint: str, key: str = "$.id"
) -> tuple[StreamingQuery, StreamingQuery]:
    """Start both sinks on what has landed so far and stop when it is read (``availableNow``).

    ``checkpoint`` is a folder all executors reach, the same on every start for the same sinks.
    """
    checked = check(stream, contract, variant="v")
    row_key = F.try_variant_get("v", key, "string")
    sides = (("valid", valid_rows(checked), "parquet", valid_path), ("errors", error_rows(checked, row_key), "json", errors_path))
    return tuple(
        df.writeStream.format(fmt)
        .option("path", path)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{side}")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        for side, df, fmt, path in sides
    )


def running_totals(stream: DataFrame, key: str, measure, name: str = "total"):
    """Sum and count per key of a stream, for ``complete`` or ``update`` output."""
    return stream.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(measure).alias(name))
