"""Append-only tables with many writers: one folder per write, snapshots of many writes, a sweep of what they replace."""

from __future__ import annotations

import math
import uuid
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.session import create_exclusively, drop_path, list_files, list_folders

ROWS_PER_FILE = 1_000_000
ABSORBED = "name string, kind string"


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, or an empty one with the fixed schema if nothing is there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class AppendLog:
    """Rows below ``path``; every write is a folder ``key=<id>``, so writers never touch each other's files.

    ``compact`` writes all rows so far into few files beside the log. A snapshot counts once its mark is there; readers merge
    the marked snapshots with the writes that none of them holds. What a snapshot replaces stays for a retention time, so
    a reader can finish, and a compaction that dies on its way has taken nothing away. Several compactions at once are
    harmless: their snapshots are merged by ``key``.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        self.beside = f"{self.path}-compacted"

    def append(self, rows: DataFrame) -> str:
        """Write ``rows`` (without the key column) as one entry and return its id."""
        name = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/{self.key}={name}")
        return name

    def rows(self) -> DataFrame:
        # The marks are looked up first: a write that a later snapshot replaces is then still among the folders.
        live = self._live()
        return self._merged(live, read_or_empty(self.spark, self.path, self.schema))

    def compact(self, retention: timedelta = timedelta(days=7)) -> int:
        """Write a snapshot if there is anything new, and remove what snapshots replaced longer than ``retention`` ago.

        Returns the number of folders and snapshots removed.
        """
        # Folders are known to be whole by their success files, which are looked up before the folders are listed for reading.
        whole = [p.split("/")[-2].split("=", 1)[1] for p, _ in list_files(self.spark, f"{self.path}/{self.key}=*/_SUCCESS")]
        live = self._live()
        ids = self.spark.createDataFrame([(n,) for n in whole], f"{self.key} string")
        fresh = ids.join(self._absorbed(live, "write"), self.key, "left_anti")
        if len(live) > 1 or not fresh.isEmpty():
            self._snapshot(live, ids)
        return self._sweep(datetime.now(timezone.utc) - retention)

    def _snapshot(self, live: list[str], ids: DataFrame) -> None:
        name = uuid.uuid4().hex
        tail = read_or_empty(self.spark, self.path, self.schema).join(ids, self.key, "left_semi")
        rows = self._merged(live, tail)
        files = max(1, math.ceil(rows.count() / ROWS_PER_FILE))
        rows.repartition(files, self.key).write.parquet(f"{self.beside}/data/{name}")
        parents = self.spark.createDataFrame([(n, "snapshot") for n in live], ABSORBED)
        replaced = ids.select(F.col(self.key).alias("name"), F.lit("write").alias("kind")).unionByName(parents)
        replaced.coalesce(1).write.parquet(f"{self.beside}/absorbed/{name}")
        create_exclusively(self.spark, f"{self.beside}/done/{name}")

    def _marks(self) -> dict[str, datetime]:
        return {p.rsplit("/", 1)[1]: at for p, at in list_files(self.spark, f"{self.beside}/done/*")}

    def _live(self) -> list[str]:
        """The snapshots that no other one replaces; more than one only after compactions at the same time."""
        done = sorted(self._marks())
        if len(done) < 2:
            return done
        replaced = {r["name"] for r in self._replaced(done).filter("kind = 'snapshot'").collect()}
        return [n for n in done if n not in replaced]

    def _replaced(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], ABSORBED)
        return self.spark.read.schema(ABSORBED).parquet(*[f"{self.beside}/absorbed/{n}" for n in names])

    def _absorbed(self, names: list[str], kind: str) -> DataFrame:
        """Ids of what the given snapshots replace and may still be there."""
        return self._replaced(names).filter(F.col("kind") == kind).select(F.col("name").alias(self.key)).distinct()

    def _merged(self, live: list[str], tail: DataFrame) -> DataFrame:
        columns = tail.columns
        if live:
            tail = tail.join(self._absorbed(live, "write"), self.key, "left_anti").select(*columns)
        parts = []
        for name in live:
            part = self.spark.read.schema(self.schema).parquet(f"{self.beside}/data/{name}")
            for other in parts:
                part = part.join(other.select(self.key).distinct(), self.key, "left_anti").select(*columns)
            parts.append(part)
        for part in parts:
            tail = tail.unionByName(part)
        return tail

    def _sweep(self, before: datetime) -> int:
        marks = self._marks()
        old = [n for n, at in marks.items() if at <= before]
        gone = self._replaced(old)
        count = 0
        there = [(p, p.rsplit("=", 1)[1]) for p, _ in list_folders(self.spark, f"{self.path}/{self.key}=*")]
        folders = self.spark.createDataFrame(there, f"folder string, {self.key} string")
        for r in folders.join(self._absorbed(old, "write"), self.key, "left_semi").toLocalIterator():
            drop_path(self.spark, r["folder"])
            count += 1
        dead = {r["name"] for r in gone.filter("kind = 'snapshot'").collect()} & set(marks)
        # A snapshot without a mark was never read; its writer is given the retention time to finish.
        tried = {p.rsplit("/", 1)[1]: at for p, at in list_folders(self.spark, f"{self.beside}/data/*")}
        dead |= {n for n, at in tried.items() if at < before and n not in marks}
        for name in sorted(dead):
            for part in ("done", "data", "absorbed"):  # the mark first, so nobody counts on half a snapshot
                drop_path(self.spark, f"{self.beside}/{part}/{name}")
            count += 1
        return count
