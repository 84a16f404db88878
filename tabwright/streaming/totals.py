"""Running totals per key and period of a stream, in state of bounded size, with a sink that repeats safely.

A watermark closes periods that are ``delay`` older than the newest event, so state holds the open periods' keys only.
Every micro-batch gives the totals it changed; the sink keeps them under the batch's number. A batch that runs again
after a failure overwrites its own rows, and the newest row of a key and period is its total.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def period_totals(stream: DataFrame, time: str, keys: Sequence[str], measure: str | Column, period: str = "1 day", delay: str = "1 day") -> DataFrame:
    """``(period, keys..., n, total)`` for ``update`` output. Events without a time, or of closed periods, take no part."""
    # Grouped by the whole window: its start alone would not carry the watermark, and no period would ever close.
    open_ = stream.withWatermark(time, delay).groupBy(F.window(time, period), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(measure).alias("total"))
    return open_.select(F.col("window.start").alias("period"), *keys, "n", "total")


def start_totals(totals: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Bring the totals below ``path`` up to date with what has landed, and stop (``availableNow``).

    ``checkpoint`` is a folder all executors reach, the same on every start for the same ``path``.
    """

    def upsert(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch:010d}")

    return totals.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(upsert).trigger(availableNow=True).start()


def read_totals(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest total of every period and key: one partial aggregate, whatever the number of batches."""
    rows = spark.read.parquet(path)
    newest = F.max_by(F.struct("n", "total"), "batch").alias("_t")
    return rows.groupBy("period", *keys).agg(newest).select("period", *keys, "_t.n", "_t.total")
