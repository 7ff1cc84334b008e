"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import uuid
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "rowsmith", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; on a cluster, bring your own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local run without the setting uses a folder below the warehouse; a cluster has to name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared root, never used before.

    All paths of an application lie in one folder, which goes when the driver ends.
    """
    folder = f"{shared_root(spark)}/rowsmith/{spark.sparkContext.applicationId}"
    fs, target = _file_system(spark, folder)
    fs.mkdirs(target)
    fs.deleteOnExit(target)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def create_exclusively(spark: SparkSession, path: str) -> bool:
    """Create an empty file and its folders; False if it is there already. Of several callers one gets True.

    Shared file systems decide that themselves. Hadoop's local one looks before it creates, so there the
    operating system is asked.
    """
    fs, target = _file_system(spark, path)
    fs.mkdirs(target.getParent())
    if fs.getUri().getScheme() == "file":
        try:
            os.close(os.open(fs.makeQualified(target).toUri().getPath(), os.O_CREAT | os.O_EXCL))
        except FileExistsError:
            return False
        return True
    try:
        fs.create(target, False).close()
    except Py4JJavaError:
        if not fs.exists(target):
            raise
        return False
    return True


def list_folders(spark: SparkSession, pattern: str) -> list[tuple[str, datetime]]:
    """Path and time of change of the folders that match a pattern."""
    return _listed(spark, pattern, True)


def list_files(spark: SparkSession, pattern: str) -> list[tuple[str, datetime]]:
    """Path and time of change of the files that match a pattern."""
    return _listed(spark, pattern, False)


def _listed(spark: SparkSession, pattern: str, folders: bool) -> list[tuple[str, datetime]]:
    fs, target = _file_system(spark, pattern)
    found = [s for s in fs.globStatus(target) or [] if s.isDirectory() == folders]
    return [(s.getPath().toString(), datetime.fromtimestamp(s.getModificationTime() / 1000, timezone.utc)) for s in found]


class Scratch:
    """Intermediate tables of one operator in the shared folder.

    Used as a context: tables written inside are removed at its end, also after an error. A table
    written with ``keep=True`` backs a result that is read later and stays until the driver ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            drop_path(self.spark, path)

    def path(self, label: str) -> str:
        """A fresh path for what is not a table; it goes with the tables."""
        path = scratch_path(self.spark, f"{self.label}-{label}")
        self.paths.append(path)
        return path

    def write(self, df: DataFrame, label: str, keep: bool = False, partition_by: list[str] | None = None) -> DataFrame:
        """Write ``df`` and read it back, which cuts its lineage."""
        path = scratch_path(self.spark, f"{self.label}-{label}")
        if not keep:
            self.paths.append(path)
        df.write.mode("overwrite").partitionBy(*partition_by or []).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def materialise(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pin_small(df: DataFrame, bound: int = 100_000) -> DataFrame:
    """Compute an aggregate once and mark it for broadcasting if it is small enough.

    The other side of a join with a small result is then never shuffled. Beyond ``bound``
    rows the data stays distributed: it is written to the shared folder and joining it is
    an ordinary shuffle join.
    """
    rows = df.limit(bound + 1).collect()
    if len(rows) <= bound:
        return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
    return materialise(df, "wide")
