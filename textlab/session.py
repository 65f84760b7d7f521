"""Session helpers.

The library never builds its own cluster session inside an operator; these
helpers are for tests, the bench and scripts.  ``checkpoint_dir`` reads the
cluster's shared checkpoint folder and only invents one when none is set
(local tests).
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def _default_driver_memory() -> str:
    """60 % of the machine's memory, between 2 GB and 16 GB (local mode: the
    driver heap is all of Spark's memory)."""
    try:
        with open("/proc/meminfo") as fh:
            kb = next(int(line.split()[1]) for line in fh if line.startswith("MemTotal:"))
        gb = int(kb / (1024 * 1024) * 0.6)
    except (OSError, StopIteration, ValueError):
        gb = 4
    return f"{max(2, min(16, gb))}g"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "textlab") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TEXTLAB_DRIVER_MEMORY", _default_driver_memory()))
        .config("spark.sql.optimizer.windowGroupLimitThreshold", "5000")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder of the cluster (``spark.checkpoint.dir``).

    On a cluster the setting names shared storage and is used as is.  Only in
    local mode, when it is unset (tests), a private folder is created; a
    cluster without the setting is an error (a machine-local folder would not
    be readable by other executors).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/S3) for this cluster")
        configured = tempfile.mkdtemp(prefix="textlab-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
