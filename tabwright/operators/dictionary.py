"""Numbering of text values by a dictionary that is a table, for columns with any number of values.

An indexer that keeps its labels in the model holds every one of them on the driver and in each task. Here the values
of a column are ranked by a distributed sort and written as (value, index, times); rows find their index by a join.
Values of a large share of the fitted rows, at most ``joins.MOST_HOT``, are broadcast and the others joined by key, so no
frequent value gathers its rows in one task.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.operators.joins import least_hot
from tabwright.operators.numbering import row_position
from tabwright.session import scratch_path

SPREAD = 1_024  # places for the rows that need no join


def write_dictionary(df: DataFrame, col: str, path: str) -> tuple[int, int]:
    """Write (value, index, times) of a column's values in alphabetical order; gives their number and that of the rows."""
    value = F.col(col).cast("string").alias("value")
    counted = df.select(value).where("value is not null").groupBy("value").agg(F.count(F.lit(1)).alias("times"))
    row_position(counted, "value", "index").write.parquet(path)
    size, rows = df.sparkSession.read.parquet(path).agg(F.count(F.lit(1)), F.coalesce(F.sum("times"), F.lit(0))).first()
    return size, rows


class _Writer(DefaultParamsWriter):
    """The parameters, and the dictionary beside them: a saved indexer does not need the folder it was fitted in."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        spark = SparkSession.getActiveSession()
        spark.read.parquet(self.instance.getOrDefault("table")).write.parquet(f"{path}/dictionary")


class _Reader(DefaultParamsReader):
    def load(self, path: str) -> DictionaryIndexer:
        found = super().load(path)
        return found._set(table=f"{path}/dictionary")


class DictionaryIndexer(Transformer, HasInputCol, HasOutputCol, MLReadable, MLWritable):
    """``outputCol``: the index of ``inputCol`` in a written dictionary; a value that is not in it, or none, gets its size.

    The column carries its number of categories, the one for other values included, and no names. Rows keep their
    columns; their order is not kept.
    """

    table = Param(Params._dummy(), "table", "folder of the dictionary", typeConverter=TypeConverters.toString)
    size = Param(Params._dummy(), "size", "number of values", typeConverter=TypeConverters.toInt)
    rows = Param(Params._dummy(), "rows", "number of rows the dictionary was counted on", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, table=None, size=None, rows=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def write(self) -> _Writer:
        return _Writer(self)

    @classmethod
    def read(cls) -> _Reader:
        return _Reader(cls)

    def _transform(self, df: DataFrame) -> DataFrame:
        size = self.getOrDefault("size")
        dictionary = df.sparkSession.read.parquet(self.getOrDefault("table"))
        least = least_hot(self.getOrDefault("rows"))
        hot = dictionary.where(F.col("times") >= least).select(F.col("value").alias("_hot"), F.col("index").alias("_hot_at"))
        cold = dictionary.where(F.col("times") < least).select(F.col("value").alias("_cold"), F.lit(-1).alias("_own"), F.col("index").alias("_cold_at"))
        value = F.col(self.getInputCol()).cast("string")
        marked = df.join(F.broadcast(hot), value == F.col("_hot"), "left")
        # Rows that are done, and those without a value, look for nothing and are spread by their other columns.
        done = F.col("_hot_at").isNotNull() | value.isNull()
        plain = [F.col(f.name) for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant", "udt")]
        marked = marked.withColumn("_place", F.when(done, F.pmod(F.xxhash64(*plain), F.lit(SPREAD)).cast("int")).otherwise(-1))
        marked = marked.withColumn("_key", F.coalesce(value, F.lit("")))
        joined = marked.join(cold, (F.col("_place") == F.col("_own")) & (F.col("_key") == F.col("_cold")), "left")
        index = F.coalesce("_hot_at", "_cold_at", F.lit(size)).cast("double")
        kept = [F.col(c) for c in df.columns]
        return joined.select(*kept, index.alias(self.getOutputCol(), metadata={"ml_attr": {"type": "nominal", "num_vals": size + 1}}))


class NamelessVector(Transformer, HasInputCol, MLReadable, MLWritable):
    """The vector column without the names of its entries: a name for each of very many categories swells every schema."""

    @keyword_only
    def __init__(self, *, inputCol=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def write(self) -> DefaultParamsWriter:
        return DefaultParamsWriter(self)

    @classmethod
    def read(cls) -> DefaultParamsReader:
        return DefaultParamsReader(cls)

    def _transform(self, df: DataFrame) -> DataFrame:
        name = self.getInputCol()
        attributes = df.schema[name].metadata.get("ml_attr", {})
        size = {"num_attrs": attributes["num_attrs"]} if "num_attrs" in attributes else {}
        return df.withColumn(name, F.col(name).alias(name, metadata={"ml_attr": size} if size else {}))


def dictionary_indexer(df: DataFrame, col: str, output: str, source: str | None = None) -> DictionaryIndexer:
    """Learns the dictionary of ``source`` (by default ``col``) and gives the stage that numbers ``col`` by it."""
    path = scratch_path(df.sparkSession, "dictionary")
    size, rows = write_dictionary(df, source or col, path)
    return DictionaryIndexer(inputCol=col, outputCol=output, table=path, size=size, rows=rows)
