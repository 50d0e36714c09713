"""T8s: versions of a table's folder, for full refreshes.

A streaming sink remembers by its checkpoint, and in its own log, which batches
it has written; started anew on the same folder it skips the first ones, and a
checkpoint whose landed files are gone cannot go on.  So every checkpoint
writes to a folder of its own, ``<table>/data-<version>``, and a log of one
small row a switch, ``<table>/versions``, says which one readers take.  A
refresh fills a new version beside the current one and switches when it is
complete: readers see the old rows or the new ones, and rows of the old version
that do not come again are gone.
"""
from __future__ import annotations

import hashlib
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOG = "version string, at long"


def version_of(checkpoint: str) -> str:
    """The version that a query with this checkpoint folder writes."""
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()


def folder(path: str, version: str) -> str:
    """Where a version's rows lie."""
    return f"{path.rstrip('/')}/data-{version}"


def current(spark: SparkSession, path: str) -> str | None:
    """The version that readers take; None where nothing was published."""
    try:
        return spark.read.schema(_LOG).json(f"{path.rstrip('/')}/versions").agg(F.max_by("version", "at")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def publish(spark: SparkSession, path: str, version: str) -> None:
    """Let readers take ``version`` from now on."""
    if current(spark, path) != version:
        row = spark.createDataFrame([(version, time.time_ns())], _LOG)
        row.coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/versions")


def current_folder(spark: SparkSession, path: str) -> str:
    """The folder of the current version, or ``path`` itself for a table without versions."""
    version = current(spark, path)
    return path if version is None else folder(path, version)


def write_version(df: DataFrame, path: str, *partition_by: str) -> None:
    """Write ``df`` as the table's next version and switch to it."""
    spark, version = df.sparkSession, version_of(f"{path}#{time.time_ns()}")
    w = df.write
    (w.partitionBy(*partition_by) if partition_by else w).parquet(folder(path, version))
    publish(spark, path, version)
