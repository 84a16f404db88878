"""Several tables that appear together or not at all.

The tables of a batch are written to folders of their own that no reader looks at. One small file, the batch's entry in
the ledger, then names them all: it appears by a single rename, so a reader sees every table of the batch or none. A run
that is killed before the rename leaves folders without an entry; a batch that is run again after its entry does nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.operators.validate import all_or_nothing


class Publication:
    """Tables below one folder that all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _place(self, name: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return place, place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    @staticmethod
    def _file_name(batch: str) -> str:
        return batch.encode().hex()  # any name

    def entry(self, batch: str) -> dict | None:
        """The ledger's entry of a batch: the folder of each of its tables; None before it is published."""
        place, files = self._place(f"ledger/{self._file_name(batch)}.json")
        if not files.exists(place):
            return None
        return json.loads(self.spark.read.text(str(place.toString())).first()["value"])

    def publish(self, batch: str, tables: dict[str, DataFrame], written: Callable[[str], None] | None = None) -> bool:
        """Write and enter a batch; False if it was published before. ``written`` is called after each table."""
        if self.entry(batch) is not None:
            return False
        attempt = f"staged/{self._file_name(batch)}-{uuid.uuid4().hex}"
        for name, df in tables.items():
            df.write.parquet(f"{self.path}/{attempt}/{name}")
            if written:
                written(name)
        place, files = self._place(f"ledger/{self._file_name(batch)}.json")
        draft, _ = self._place(f"{attempt}/entry.json")
        out = files.create(draft)
        out.write(bytearray(json.dumps({name: f"{attempt}/{name}" for name in tables}).encode()))
        out.close()
        files.mkdirs(place.getParent())
        # Where two runs race, the second rename finds the first one's entry and changes nothing.
        return bool(files.rename(draft, place)) if not files.exists(place) else False

    def publish_checked(self, batch: str, feeds: dict[str, DataFrame], written: Callable[[str], None] | None = None) -> bool:
        """The valid rows of all checked feeds, or, if one holds an error, no rows but the errors of all of them."""
        passed, rejected = all_or_nothing(feeds)
        rejects = rejected.select("feed", F.to_json("errors").alias("errors"))
        return self.publish(batch, {**passed, "rejected": rejects}, written)

    def read(self, table: str) -> DataFrame:
        """All published rows of a table with their ``batch``. The ledger holds one short line for each batch."""
        try:
            ledger = self.spark.read.text(f"{self.path}/ledger").select(F.get_json_object("value", f"$['{table}']").alias("folder"))
        except AnalysisException as e:
            raise ValueError(f"nothing is published in {self.path}") from e
        folders = [r["folder"] for r in ledger.where("folder is not null").orderBy("folder").collect()]
        if not folders:
            raise ValueError(f"no table {table} is published in {self.path}")
        rows = self.spark.read.parquet(*[f"{self.path}/{f}" for f in folders])
        name = F.regexp_extract(F.col("_metadata.file_path"), r"/staged/([0-9a-f]*)-[0-9a-f]{32}/", 1)
        return rows.withColumn("batch", F.decode(F.unhex(name), "utf-8"))
