"""Spark session factory and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "sillage") -> SparkSession:
    """Session with UTC time zone, UI off, AQE (coalescing + skew join) on.

    On a cluster ``master`` is left to spark-submit (``None``) and shuffle/scan sizes
    are set for large inputs; tests and the bench pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    local = bool(master) and master.startswith("local")
    cpus = os.environ.get("BENCH_CPUS")
    if local:
        parts = shuffle_partitions or (int(cpus) if cpus else 8)
    else:
        # Cluster: start high and let AQE coalesce shuffle output to ~256 MB partitions,
        # so a 100 TB shuffle never has multi-GB partitions that spill or fail.
        parts = shuffle_partitions or 8000
        builder = (builder.config("spark.sql.files.maxPartitionBytes", "256m")
                   .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256m")
                   .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1g"))
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SILLAGE_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Event times are epoch seconds and the test tables hold zone-less timestamps;
    both are read as UTC, so the session time zone must be UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the operator reads the setting the cluster gives.  Only when it
    is unset and the master is local do we create one, under the system temp folder; on
    a cluster an unset folder is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
        path = path or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    except Exception:  # Spark Connect: no SparkContext, the session conf is the source
        sc = None
    if not path:
        if sc is None or not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="sillage-ckpt-")  # one machine: its temp folder is shared
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused location inside the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
