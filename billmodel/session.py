"""Session helpers for tests, the bench and the registry."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("billmodel")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Call-site capture for error messages costs ~1 ms per Column built;
        # the wide table builds thousands. Results are unaffected.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BILLMODEL_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when it is unset on a local master (tests) a scratch folder is created
    and set; on a cluster that is an error, as executors could not share it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        # Unset in a local run or a test: a scratch folder stands in.
        current = tempfile.mkdtemp(prefix="billmodel-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def shared_folder(spark: SparkSession) -> str:
    """The configured ``spark.checkpoint.dir`` itself (stable across
    applications), for state that must outlive one run, such as a stream's
    progress. Falls back to the context's checkpoint folder."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return configured or checkpoint_dir(spark)
