"""Session helpers.

``local_session`` is for tests and the bench only; on a cluster the caller
owns the session and only ``checkpoint_dir`` / ``scratch_dir`` are used.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "medallion") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("MEDALLION_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only when the session has none (local tests) a fresh temporary folder is
    created and registered.
    """
    current = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="medallion-ckpt-")
    spark.conf.set(CHECKPOINT_KEY, path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local on a cluster)."""
    base = checkpoint_dir(spark).rstrip("/")
    if base.startswith("file:"):
        base = base[len("file:"):]
    if "://" in base:
        import uuid

        return f"{base}/{name}-{uuid.uuid4().hex}"
    os.makedirs(base, exist_ok=True)
    return tempfile.mkdtemp(prefix=f"{name}-", dir=base)
