"""Keyed tables in hash buckets: a rewrite costs what its keys' buckets hold.

Rows lie below ``<version>/_bucket=<n>/``; a manifest names, for each bucket,
the version that is in force.  A run that brings changes for some keys reads
and rewrites the buckets of these keys only, writes a manifest that points to
the new folders for them and to the old ones for all others, and adds a
numbered pointer to it, as ``VersionedTable`` does for whole versions.  A crash
at any point leaves the previous manifest in force.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.sources.tables import POINTERS, VersionedTable, create_file, delete_path, path_exists

MANIFESTS = "_manifests"


class BucketedTable(VersionedTable):
    """A table with one key column, stored in ``buckets`` hash buckets.

    The number of buckets is fixed when the table is first written.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = 32, keep: int = 3) -> None:
        super().__init__(spark, root, keep)
        self.key = key
        known = self.manifest()
        self.buckets = known["buckets"] if known else buckets

    def bucket(self, key: Column | None = None) -> Column:
        key = F.col(self.key) if key is None else key
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.buckets)).cast("int")

    def touched(self, changes: DataFrame, key: Column | None = None) -> list[int]:
        """The buckets of the keys in ``changes``: at most as many numbers as there are buckets."""
        return sorted(r[0] for r in changes.select(self.bucket(key)).distinct().collect())

    def read(self, buckets: Iterable[int] | None = None) -> DataFrame | None:
        known = self.manifest()
        return None if known is None else read_manifest(self.spark, self.root, known, buckets)

    def write(self, df: DataFrame, buckets: Iterable[int], **facts) -> str:
        """Store all rows of ``buckets``; returns a manifest that no reader sees before ``flip``.

        ``facts`` are small values kept with the manifest.
        """
        version = super().write(df.withColumn("_bucket", self.bucket()).hint("rebalance", "_bucket"),
                                ["_bucket"])
        known = self.manifest() or {"parts": {}}
        parts = {b: v for b, v in known["parts"].items() if int(b) not in set(buckets)}
        for b in buckets:
            if path_exists(self.spark, f"{self.root}/{version}/_bucket={b}"):
                parts[str(b)] = version
        body = {"buckets": self.buckets, "parts": parts, "schema": df.schema.json(),
                "facts": {**known.get("facts", {}), **facts}}
        name = f"{version}.json"
        create_file(self.spark, f"{self.root}/{MANIFESTS}/{name}", json.dumps(body))
        return name

    def flip(self, version: str) -> None:
        before = self._pointers()
        number = int(before[-1].split("=", 1)[0]) + 1 if before else 1
        pointer = f"{number:012d}={version}"
        create_file(self.spark, f"{self.root}/{POINTERS}/{pointer}")
        gone, kept = [*before, pointer][:-self.keep], [*before, pointer][-self.keep:]
        if not gone:
            return
        used = {p for name in kept for p in self._folders(name)}
        for name in gone:
            for folder in self._folders(name) - used:
                delete_path(self.spark, f"{self.root}/{folder}")
            delete_path(self.spark, f"{self.root}/{MANIFESTS}/{name.split('=', 1)[1]}")
            delete_path(self.spark, f"{self.root}/{POINTERS}/{name}")

    def _folders(self, pointer: str) -> set[str]:
        known = load_manifest(self.spark, self.root, pointer.split("=", 1)[1])
        return {f"{v}/_bucket={b}" for b, v in known["parts"].items()}

    def manifest(self) -> dict | None:
        pointers = self._pointers()
        return load_manifest(self.spark, self.root, pointers[-1].split("=", 1)[1]) if pointers else None


def load_manifest(spark: SparkSession, root: str, name: str) -> dict:
    return json.loads(spark.read.text(f"{root}/{MANIFESTS}/{name}", wholetext=True).first()[0])


def read_manifest(spark: SparkSession, root: str, known: dict,
                  buckets: Iterable[int] | None = None) -> DataFrame:
    """The rows of (some) buckets of a manifest."""
    from pyspark.sql.types import StructType

    wanted = None if buckets is None else {str(b) for b in buckets}
    paths = [f"{root}/{v}/_bucket={b}" for b, v in known["parts"].items() if wanted is None or b in wanted]
    schema = StructType.fromJson(json.loads(known["schema"]))
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
