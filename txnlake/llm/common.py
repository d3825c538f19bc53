"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.session import prepare, scratch_path, ship_package


def ready(spark: SparkSession) -> SparkSession:
    """Pin session settings and make the package importable in Python workers.

    Arrow batches are bounded by bytes, as rows may hold whole texts.
    """
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20)
    ship_package(spark)
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back.

    Cuts the lineage without a local checkpoint: a lost executor re-reads
    files, and every later job sees the same rows in the same files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts_for(rows: int) -> int:
    """Partitions of a narrow table of so many rows: small tables needn't be dealt out."""
    return max(1, -(-rows // 100_000))


def one_thread() -> None:
    """One thread per Python worker: Spark already fills the cores with tasks."""
    for name in ("RAYON_NUM_THREADS", "OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS"):
        os.environ.setdefault(name, "1")
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def text_digest(text: Column) -> Column:
    """128-bit digest of a text (null for null): stands for the text in keys."""
    return F.unhex(F.md5(text.cast("binary")))


def unit_key(doc_id: Column, text: Column) -> Column:
    """Key of a (doc_id, text) pair; rows equal in both are one document."""
    return F.struct(doc_id.alias("id"), text_digest(text).alias("th"))
