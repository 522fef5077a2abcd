"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(app: str = "wattlake", cpus: int | str = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """Local session used by tests and the bench; clusters pass their own."""
    parts = shuffle_partitions or (8 if cpus == "*" else int(cpus))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        # HotSpot does not JIT methods over 8000 bytes of bytecode; stages whose
        # generated method is larger fall back to expression codegen instead of
        # running interpreted (value recommended by the Spark configuration docs)
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("WATTLAKE_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names shared storage on a cluster and is only
    filled in here when unset (local tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="wattlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, *parts: str) -> str:
    """Path under the shared checkpoint folder (never a machine-local temp dir)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])
