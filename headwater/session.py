"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Spark settings the library expects. Partition counts are left to the caller: on a cluster
# AQE coalesces from a high initial number, locally the core count is enough.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # let AQE split a skewed join side even if that costs one more exchange above it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # state of streams on disk, its changes written per batch
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "headwater", master: str | None = None, partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the library defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return ship(builder.getOrCreate())


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per application.

    Arrow UDFs and the GeoPackage source import it there; workers do not see the driver's path.
    """
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="headwater-py-"), "headwater.zip")
        with zipfile.ZipFile(archive, "w") as target:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        target.write(path, os.path.relpath(path, os.path.dirname(package)))
        spark.sparkContext.addPyFile(archive)
        _shipped.add(application)
    return spark


def _shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="headwater-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a URI; without a scheme it is on the default file system, as for Spark's readers."""
    if "://" in path:
        return path
    if path.startswith("file:"):
        return "file://" + path.removeprefix("file:")
    root = spark.conf.get("spark.hadoop.fs.defaultFS", "file://")
    return root.rstrip("/") + path if path.startswith("/") else path


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name below ``spark.checkpoint.dir`` (a local folder in local mode).

    The name has no digits, so it cannot be taken for a watershed code in a path.
    """
    letters = uuid.uuid4().hex[:12].translate(str.maketrans("0123456789", "ghijklmnop"))
    return f"{_shared_root(spark)}/{label}-{letters}"


def cut_lineage(df, label: str):
    """Write ``df`` to the shared folder and read it back, so a lost executor costs a re-read."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
