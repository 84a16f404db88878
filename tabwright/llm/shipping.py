"""Gives Python workers this package, wherever the driver has it."""

from __future__ import annotations

import io
import os
import zipfile

from pyspark.sql import SparkSession

from tabwright.session import scratch_path

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to all executors, once an application, as Spark's own Python file.

    The archive lies in the shared folder that the session names.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    path = scratch_path(spark, "code") + "/tabwright.zip"  # in a folder, so that it is released with it
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(context._jsc.hadoopConfiguration()).create(place)
    stream.write(bytearray(archive.getvalue()))
    stream.close()
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
