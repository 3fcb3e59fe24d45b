"""Session helpers: the shared folder for lineage cuts and scratch output."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "sluice",
                shuffle_partitions: int | None = None,
                extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Session with AQE and skew-join handling on, UI off, UTC clock.

    On a cluster the master and partition counts come from the launcher;
    the arguments are for local runs and tests.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra_conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared folder named in ``spark.checkpoint.dir``.

    Read from the session; only a local run without the setting gets a folder
    of our own.  Executors of a cluster do not share such a folder, so there a
    missing setting is an error.
    """
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="sluice-ckpt-")
    spark.sparkContext.setCheckpointDir(conf)
    return spark.sparkContext.getCheckpointDir() or conf


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run's written tables, under the shared root."""
    root = checkpoint_root(spark).rstrip("/")
    parent = root.rsplit("/", 1)[0] if "/" in root else root
    return f"{parent}/sluice-work/{name}-{uuid.uuid4().hex[:12]}"


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme so Python can open a local test path."""
    if uri.startswith("file://"):
        return uri[len("file://"):]
    if uri.startswith("file:"):
        return uri[len("file:"):]
    return uri


def exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem, valid for any store."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p)


def has_data(spark: SparkSession, path: str) -> bool:
    if not exists(spark, path):
        return False
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    # Same rule as Spark's file index: "_x" and ".x" are hidden unless "_x=v" partitions.
    return any(not n.startswith(".") and (not n.startswith("_") or "=" in n)
               for n in (s.getPath().getName() for s in fs.listStatus(p)))


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of our own temporary output, on any store."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


__all__ = ["get_session", "checkpoint_root", "scratch_dir", "local_path", "exists",
           "has_data", "delete"]
