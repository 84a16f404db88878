"""CSV, JSON and Parquet scans and sinks, tolerant loading, write-and-verify."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.session import materialise, scratch_path

log = logging.getLogger(__name__)


def json_array_scan(spark: SparkSession, path: str | Sequence[str], schema, lines: bool = False) -> DataFrame:
    """Records of UTF-8 JSON. A file holding one array is read by one task: use ``lines`` for anything large."""
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def safe_load(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, lines: bool = False) -> DataFrame:
    """JSON records; a missing path gives no rows and a broken file loses all of its rows.

    Other files are unaffected. A value of the wrong type is not a broken file: declare
    such a field as string and let a contract explain it.
    """
    try:
        text = spark.read.text(path, wholetext=not lines)
        rows = spark.read.schema(schema).json(path).withColumn("_file", F.col("_metadata.file_path"))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in (e.getCondition() or str(e)):
            raise
        log.error("no such file: %s", path)
        return spark.createDataFrame([], schema)
    finally:
        log.info("load finished: %s", path)
    unreadable = (F.trim("value") != "") & F.try_parse_json("value").isNull()
    if not lines:
        # One document per file: an unreadable one has no records to give.
        records = F.from_json("value", T.ArrayType(schema))
        return text.where(~unreadable).select(F.inline(records))
    broken = (
        text.where(unreadable)
        .groupBy(F.col("_metadata.file_path").alias("_file"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return rows.join(materialise(broken, "broken-files"), "_file", "left_anti").select(*schema.names)


def csv_scan(spark: SparkSession, path: str | Sequence[str], schema=None, line_breaks: bool = False) -> DataFrame:
    """CSV with a header row; an empty field is missing, a quoted empty one is "", a doubled quote is a quote.

    Without a schema the types are inferred by an extra pass. ``line_breaks`` allows them
    inside quoted fields; such files cannot be split between tasks.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", line_breaks)
    # No text equals this mark, so that only a field without any character reads as missing.
    reader = reader.option("nullValue", "\u0001").option("emptyValue", "")
    reader = reader.option("enforceSchema", False) if schema is not None else reader.option("inferSchema", True)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def csv_sink(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Header, no index column; text is kept as it is: quotes, line breaks, outer blanks, and "" apart from missing."""
    kept = df.write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", '""')
    kept.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def parquet_scan(spark: SparkSession, path: str | Sequence[str], schema=None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def parquet_sink(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def reject_sink(errors: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Rejected records, one JSON object per line, text unescaped."""
    errors.write.mode(mode).json(path)


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def write_and_verify(valid: DataFrame, errors: DataFrame, valid_path: str, errors_path: str) -> DataFrame:
    """Write valid rows as CSV and rejects as JSON, read both back: ``(side, expected, reloaded, ok)``; ``ok`` compares content."""
    spark = valid.sparkSession
    csv_sink(valid, valid_path)
    reject_sink(errors, errors_path)
    back = csv_scan(spark, valid_path, valid.schema, line_breaks=True)
    sides = (
        ("valid", valid, back),
        ("error", errors, spark.read.schema(errors.schema).json(errors_path)),
    )
    rows = [
        _fingerprint(given, "_given", count="expected").select(
            F.lit(side).alias("side"), "expected", _count(read, "r").scalar().alias("reloaded"), (F.col("_given") == _fingerprint(read).scalar()).alias("ok")
        )
        for side, given, read in sides
    ]
    return rows[0].unionByName(rows[1])


FORMATS = ("csv", "parquet")


def multi_format_materialise(tables: dict[str, DataFrame], root: str | None = None) -> DataFrame:
    """Write each table in each format, read it back: ``(table, format, row_count, same_content)``.

    Content is compared without collecting it: rows are hashed and the hashes counted on both sides.
    """
    out = []
    for name, df in tables.items():
        base = root or scratch_path(df.sparkSession, "formats")
        for fmt in FORMATS:
            path = f"{base}/{name}.{fmt}"
            if fmt == "csv":
                csv_sink(df, path)
                back = csv_scan(df.sparkSession, path, df.schema, line_breaks=True)
            else:
                parquet_sink(df, path)
                back = parquet_scan(df.sparkSession, path, df.schema)
            same = _fingerprint(df).scalar() == F.col("_print")
            out.append(
                _fingerprint(back, "_print", count="row_count").select(
                    F.lit(name).alias("table"), F.lit(fmt).alias("format"), "row_count", same.alias("same_content")
                )
            )
    return reduce(DataFrame.unionByName, out)


def _fingerprint(df: DataFrame, name: str = "_print", count: str | None = None) -> DataFrame:
    """Order-free digest of a bag of rows: their number and the sums of two row hashes."""
    cols = [F.col(c) for c in df.columns]
    sums = [F.sum(F.xxhash64(F.lit(salt), *cols).cast("decimal(38,0)")) for salt in (1, 2)]
    digest = F.concat_ws(":", F.count(F.lit(1)).cast("string"), *[s.cast("string") for s in sums])
    return df.agg(digest.alias(name), *([F.count(F.lit(1)).alias(count)] if count else []))
