"""Landed JSON feeds as variants, each isolated from the failure of another."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.variants import string_or_object, unwrap_first
from tabwright.operators.rows import attach_scalar
from tabwright.operators.validate import COUNTRY, IP, WEATHER, all_or_nothing, check, zip_arrays_to_rows

log = logging.getLogger(__name__)


def feed_scan(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """One JSON document per line, or per file with ``whole``, as column ``v``; text that is no JSON becomes NULL."""
    documents = spark.read.text(path, wholetext=whole)
    return documents.select(F.try_parse_json("value").alias("v"))


def feed_landing_scan(spark: SparkSession, paths: dict[str, str], whole: bool = False) -> dict[str, DataFrame]:
    """A frame per feed.

    A feed that has not landed is reported and comes out as one unreadable record, so the
    other feeds are still read and a later check still sees the gap.
    """
    out = {}
    for name, path in paths.items():
        try:
            out[name] = feed_scan(spark, path, whole)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in (e.getCondition() or str(e)):
                raise
            log.warning("feed %s has not landed: %s", name, path)
            out[name] = spark.range(1).select(F.try_parse_json(F.lit("{")).alias("v"))
    return out


def weather_report(feeds: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejected)`` of the weather, country and ip feeds.

    Hourly lists become rows that carry the country name and the region of the address.
    One bad feed empties the rows.
    """
    country = feeds["country"].select(unwrap_first(F.col("v")).alias("v"))
    checked = {
        "weather": check(feeds["weather"], WEATHER, "v"),
        "country": check(country, COUNTRY, "v"),
        "ip": check(feeds["ip"], IP, "v"),
    }
    good, rejected = all_or_nothing(checked)
    hourly = zip_arrays_to_rows(
        good["weather"],
        {
            "time": "hourly_time",
            "temperature_2m": "hourly_temperature_2m",
            "precipitation_probability": "hourly_precipitation_probability",
        },
    )
    wrapped = checked["country"].select(string_or_object(F.col("v"), "$.name", "common", "Korea").alias("country_name"))
    out = attach_scalar(hourly, wrapped)
    return attach_scalar(out, good["ip"].select(F.col("regionName").alias("ip_region"))), rejected


def feed_tables(feeds: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The three tables a feed job stores: weather rows, the country with its region, the address's region and country."""
    country = check(feeds["country"].select(unwrap_first(F.col("v")).alias("v")), COUNTRY, "v").where("valid")
    name = string_or_object(F.col("v"), "$.name", "common", "Korea")
    address = check(feeds["ip"], IP, "v").where("valid")
    return {
        "weather": weather_report(feeds)[0],
        "country": country.select(name.alias("country_name"), F.col("record.region").alias("region")),
        "ip": address.select(F.col("record.regionName").alias("ip_region"), F.col("record.country").alias("country")),
    }
