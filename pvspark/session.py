"""Session helpers: a sane local session for tests / bench, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "pvspark",
                  extra: dict | None = None) -> SparkSession:
    """A local session configured the way the library expects a cluster session to be.

    On a cluster the session comes from the platform; nothing here is required there except
    ``spark.sql.session.timeZone=UTC`` (hour-of-day features) and AQE (runtime re-planning).
    """
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("PVSPARK_DRIVER_MEMORY", "8g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared filesystem folder and is left alone; without it the
    job stops, since executors cannot see each other's local folders. Only a ``local[...]`` master
    (tests) gets a scratch folder of its own.
    """
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if not cur:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        cur = tempfile.mkdtemp(prefix="pvspark-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", cur)
    spark.sparkContext.setCheckpointDir(cur)
    return cur


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for materialised intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder through the file system that holds it (any Hadoop store)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Inside, the shuffle files of a query go when it ends: for tables that are written and read again. (Spark would keep them
    until the driver collects its garbage; a query that is run again makes them anew.)"""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
