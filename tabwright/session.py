"""Session set-up and shared scratch storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Scratch paths handed out by this process, by application.
_WRITTEN: dict[str, list[str]] = {}


def local_session(app: str = "tabwright", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    ``spark.checkpoint.dir`` wins. Only a local session without one gets a fresh
    temporary folder; a cluster session without one is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="tabwright-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    path = f"{shared_root(spark).rstrip('/')}/tabwright-{label}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete what this process wrote to the shared folder for this application; frames read from it end with it."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(hadoop).delete(path, True)
    return len(paths)


def materialise(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage reliably and leaves a columnar table, so that later passes
    read only the columns they use, and whose bytes tell the planner whether a join
    may broadcast it.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
