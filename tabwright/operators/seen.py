"""Rows of a table that arrives in landings, each kept once.

What was kept is the memory: files by landing and part of the rows' digest, which later landings never rewrite. Beside it
lies a Bloom filter, a table of bitmaps with one bit for each kept row. Rows of a new landing whose bit is not set are new
without a look at the memory; the others are compared with it in full, so that a shared bit or digest loses nothing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.session import materialise

PARTS = 64
BITS = 2**33  # of the filter; only bitmaps with a set bit take space
MAP_BITS = 32_768  # of one bitmap, fixed by the functions that build it


class SeenRows:
    """The distinct rows of all landings below one folder that all executors reach.

    A landing that is added again replaces what it kept, so a repeated or restarted run changes nothing. Missing equals
    missing. Columns are those of the first landing.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str, but: str | None = None) -> DataFrame | None:
        try:
            found = self.spark.read.parquet(f"{self.path}/{name}")
        except AnalysisException:
            return None
        kept = found.where(F.col("_landing").cast("string") != but) if but is not None else found
        return kept.drop("_landing")

    def rows(self) -> DataFrame | None:
        """All rows that were kept; None before the first landing."""
        found = self._read("rows")
        return None if found is None else found.drop("_mark", "_part")

    @staticmethod
    def _bit(cols: list[str]) -> Column:
        return F.pmod(F.xxhash64(F.lit("bit"), *cols), F.lit(BITS)) + 1  # places of a bitmap are counted from 1

    def unsure(self, landing: str, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """A landing's distinct rows in two frames: those that are surely new, and those that have to be compared."""
        cols = rows.columns
        marked = rows.dropDuplicates().withColumn("_mark", F.xxhash64(*cols))
        marked = materialise(marked.withColumns({"_part": F.pmod("_mark", F.lit(PARTS)).cast("int"), "_at": self._bit(cols)}), "landing")
        bits = self._read("bits", landing)
        if bits is None:
            return marked.drop("_at"), marked.drop("_at").limit(0)
        united = bits.groupBy("_map").agg(F.expr("bitmap_or_agg(_bits)").alias("_bits"))
        place = F.expr("bitmap_bit_position(_at)")
        byte = F.conv(F.hex(F.substring("_bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        held = F.coalesce(F.expr("shiftright(byte, cast(place % 8 as int))").bitwiseAND(1) == 1, F.lit(False))
        tested = marked.withColumn("_map", F.expr("bitmap_bucket_number(_at)")).join(united, "_map", "left")
        tested = tested.withColumns({"byte": byte, "place": place}).withColumn("_held", held)
        tested = materialise(tested.select(*cols, "_mark", "_part", "_held"), "tested")
        return tested.where("not _held").drop("_held"), tested.where("_held").drop("_held")

    def add(self, landing: str, rows: DataFrame) -> int:
        """Keep the rows of a landing that no other landing kept; gives the number of rows compared with the memory."""
        cols = rows.columns
        new, unsure = self.unsure(landing, rows)
        memory = self._read("rows", landing)
        compared = unsure.count()
        if memory is not None and compared:
            same = (F.col("n._part") == F.col("m._part")) & (F.col("n._mark") == F.col("m._mark"))
            for c in cols:
                same = same & F.col(f"n.`{c}`").eqNullSafe(F.col(f"m.`{c}`"))
            unsure = unsure.alias("n").join(memory.alias("m"), same, "left_anti")
        kept = materialise(new.unionByName(unsure).withColumn("_landing", F.lit(landing)), "kept")
        bits = kept.groupBy("_landing", F.bitmap_bucket_number(self._bit(cols)).alias("_map")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(self._bit(cols))).alias("_bits"))
        # Bits first: a run that ends between the two leaves bits too many, which cost a comparison and no row.
        bits.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_landing").parquet(f"{self.path}/bits")
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_landing", "_part").parquet(f"{self.path}/rows")
        return compared
