"""SparkSession construction and session-level helpers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC session time (all dates are UTC dates),
# AQE for runtime re-planning (coalescing, skew-join splitting, runtime
# broadcast decisions that are based on measured sizes), no web UI.
_SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, app_name: str = "txnlake",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings the operators depend on (idempotent)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is.  Only when it is unset (local tests) a private folder is
    created and registered.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        current = tempfile.mkdtemp(prefix="txnlake-ckpt-")
        atexit.register(shutil.rmtree, current, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    sep = "" if base.endswith("/") else "/"
    return f"{base}{sep}{name}-{uuid.uuid4().hex}"


def reliable_checkpoint(df):
    """Cut lineage: write ``df`` below the shared checkpoint folder and read it back.

    The files are Parquet: the plan runs once, a later reader takes the columns
    it needs, and the planner knows the size.
    """
    path = scratch_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make ``txnlake`` importable by every Python worker (idempotent).

    Stateful stream operators unpickle their processor class in Python
    workers: executors get the package as a zip through ``addPyFile``; the
    driver-side worker that validates state schemas gets the package root
    through the workers' ``PYTHONPATH``.
    """
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_txnlake_shipped", False):
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    paths = [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        sc.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    archive = os.path.join(tempfile.mkdtemp(prefix="txnlake-pkg-"), "txnlake.zip")
    with zipfile.ZipFile(archive, "w") as zf:
        for folder, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(archive)
    sc._txnlake_shipped = True

