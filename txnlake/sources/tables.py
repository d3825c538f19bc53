"""Table storage on the shared file system: versioned overwrite, idempotent
append and the watermark table.

Parquet has no MERGE here, so a table rewrite goes to a new version folder
and a new numbered pointer is added afterwards; readers resolve the highest
pointer and never see a half-written version, and a path being read is never
overwritten.  File-system calls go through Hadoop's ``FileSystem`` so the
same code works on HDFS/object stores and on local disk.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.operators.incremental import dedupe_first, insert_if_absent

POINTERS = "_pointers"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def create_file(spark: SparkSession, path: str, text: str = "") -> None:
    """Create a file that must not exist yet."""
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    try:
        if text:
            out.write(bytearray(text.encode()))
    finally:
        out.close()


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [str(f.getPath().getName()) for f in fs.listStatus(p)] if fs.exists(p) else []


class VersionedTable:
    """A table whose full rewrites land in fresh version folders.

    Pointers are never replaced: a flip creates the empty file
    ``_pointers/<number>=<version>``, and readers take the highest number.  A
    crash at any point leaves the previous pointer in force.  The last
    ``keep`` versions stay readable; older ones are removed after a flip.
    """

    def __init__(self, spark: SparkSession, root: str, keep: int = 3) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep = keep

    def _pointers(self) -> list[str]:
        return sorted(n for n in _names(self.spark, f"{self.root}/{POINTERS}") if "=" in n)

    def current_path(self) -> str | None:
        pointers = self._pointers()
        return f"{self.root}/{pointers[-1].split('=', 1)[1]}" if pointers else None

    def read(self) -> DataFrame | None:
        path = self.current_path()
        if path and path.endswith(".json"):  # stored in buckets: the version is a manifest
            from txnlake.sources.buckets import load_manifest, read_manifest

            return read_manifest(self.spark, self.root,
                                 load_manifest(self.spark, self.root, path.rsplit("/", 1)[1]))
        return self.spark.read.parquet(path) if path else None

    def write(self, df: DataFrame, partition_by: list[str] | None = None) -> str:
        """Write a version that no reader sees before ``flip``."""
        version = f"v{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}"
        writer = df.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.root}/{version}")
        return version

    def overwrite(self, df: DataFrame, partition_by: list[str] | None = None) -> str:
        version = self.write(df, partition_by)
        self.flip(version)
        return version

    def flip(self, version: str) -> None:
        pointers = self._pointers()
        number = int(pointers[-1].split("=", 1)[0]) + 1 if pointers else 1
        pointer = f"{number:012d}={version}"
        create_file(self.spark, f"{self.root}/{POINTERS}/{pointer}")
        for old in [*pointers, pointer][:-self.keep]:
            for gone in (f"{POINTERS}/{old}", old.split("=", 1)[1]):
                delete_path(self.spark, f"{self.root}/{gone}")


class RunLog:
    """Which steps of a run are done, as empty files ``<step>=<rows>`` in the run's folder.

    ``once`` runs a step unless an earlier attempt of the same run has
    finished it.  A step that was cut off is run again from its start, so a
    step must be idempotent by itself.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def done(self) -> dict[str, int]:
        return {n.rsplit("=", 1)[0]: int(n.rsplit("=", 1)[1])
                for n in _names(self.spark, self.root) if "=" in n}

    def once(self, step: str, work: Callable[[], int | None]) -> int:
        known = self.done()
        if step in known:
            return known[step]
        rows = work() or 0
        self.mark(step, rows)
        return rows

    def mark(self, step: str, rows: int) -> None:
        create_file(self.spark, f"{self.root}/{step}={rows}")


class AppendTable:
    """Append-only table with insert-if-absent on a key."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str],
                 partition_by: list[str] | None = None) -> None:
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys
        self.partition_by = partition_by

    def read(self) -> DataFrame | None:
        if not path_exists(self.spark, self.path):
            return None
        return self.spark.read.parquet(self.path)

    def insert_if_absent(self, batch: DataFrame, order_by: list[str] | None = None,
                         existing: DataFrame | None = None) -> int:
        """Append rows whose key is not stored yet (first copy wins in the batch).

        ``existing`` may narrow what the anti-join reads (e.g. only the
        month partitions the batch touches).  Returns the number of rows
        appended (counted on the batch, never on the whole table).
        """
        target = existing if existing is not None else self.read()
        if target is not None:
            rows = insert_if_absent(batch, target, self.keys, order_by)
        else:
            rows = batch if order_by is None else dedupe_first(batch, self.keys, order_by)
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n = rows.count()
            writer = rows.write.mode("append")
            if self.partition_by:
                writer = writer.partitionBy(*self.partition_by)
            writer.parquet(self.path)
            return n
        finally:
            rows.unpersist()


class WatermarkTable:
    """``(table_name, last_loaded_at)``; one row per target, epoch by default."""

    EPOCH = "1970-01-01 00:00:00"
    #: marks are set by threads of one driver; each rewrites the whole small table
    _writing = threading.Lock()

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.table = VersionedTable(spark, root)
        self.spark = spark

    def all(self) -> DataFrame:
        df = self.table.read()
        if df is None:
            return self.spark.createDataFrame([], "table_name STRING, last_loaded_at TIMESTAMP_NTZ")
        return df

    def get(self, name: str):
        rows = self.all().where(F.col("table_name") == name).select("last_loaded_at").collect()
        if rows and rows[0][0] is not None:
            return rows[0][0]
        import datetime
        return datetime.datetime(1970, 1, 1)

    def set_from(self, name: str, next_value: DataFrame) -> None:
        """Replace the row of ``name`` with the one-row frame ``next_value``."""
        mark = next_value.select(F.col(next_value.columns[0]).cast("timestamp_ntz")).first()[0]
        with self._writing:
            # materialise before the pointer flip: the new version may not read the old one lazily
            data = [tuple(r) for r in self.all().where(F.col("table_name") != name).collect()]
            self.table.overwrite(self.spark.createDataFrame(
                [*data, (name, mark)], "table_name STRING, last_loaded_at TIMESTAMP_NTZ").coalesce(1))
