"""Session helpers.

The library never hard-codes cluster settings; it only fills in what a
local run needs when the session has not set it (tests, bench).  On a
cluster, ``spark.checkpoint.dir`` must point at shared storage and is
read from the session as-is.
"""
from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every gridspark job assumes.  UTC keeps timestamp <-> string
# casts and window edges identical to the DuckDB oracle.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "gridspark") -> SparkSession:
    """A local session for tests and the bench.  Not used on a cluster."""
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
        .config("spark.driver.memory", os.environ.get("GRIDSPARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> SparkSession:
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and stored layers.

    Reads ``spark.checkpoint.dir`` from the session (the cluster names it).
    Where it is unset a single-machine session (tests, the bench) gets a
    scratch folder; on a cluster that is an error, since executors could not
    read a folder of the driver's machine."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.match(r"local(\[[^,]*\])?$", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="gridspark-ckpt-", dir=os.environ.get("GRIDSPARK_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d
