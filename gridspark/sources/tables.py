"""Keyed upsert, and gold tables as plain partitioned Parquet.

An event table is a log of batches, ``_run=<run>/_batch=<id>/``: a batch
overwrites its own partition and nothing else, so a retried micro-batch leaves
what it left before, and a query restarted with a fresh checkpoint writes as
another run.  Readers take the latest row a key.  Nothing is moved, merged or
deleted, so a failed write loses nothing that was there.
"""
from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from ..operators.windows import latest_per

RUN, BATCH = "_run", "_batch"


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str] = ("event_id",),
           mode: str = "upsert", replace_on: Sequence[str] | None = None) -> DataFrame:
    """The merged table: every update row, plus target rows whose key is not
    updated.  Columns follow ``target``.

    ``mode="replace"`` also drops target rows that share ``replace_on`` with
    an update (e.g. the device of a re-detected window), so rows whose key
    changed do not linger.  Duplicate keys among the updates raise, as a
    MERGE would.  One pass over the updates: both sides are tagged, meet in
    one shuffle by key, and a key's update wins there."""
    keys, cols = list(keys), target.columns
    if mode not in ("upsert", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    on = list(replace_on or keys)
    both = updates.select(*cols, F.lit(True).alias("_new")).unionByName(target.select(*cols, F.lit(False).alias("_new")))
    w = Window.partitionBy(*keys)
    both = both.withColumn("_n", F.count_if(F.col("_new")).over(w))
    k0 = keys[0]  # the check sits in a key column so that pruning cannot drop it
    both = both.withColumn(k0, F.when(F.col("_n") > 1, F.raise_error(F.lit("upsert: duplicate keys in the update set")))
                           .otherwise(F.col(k0))).filter(F.col("_new") | (F.col("_n") == 0))
    if mode == "replace" and on != keys:
        touched = F.max("_new").over(Window.partitionBy(*on))
        both = both.withColumn("_n", touched.cast("int")).filter(F.col("_new") | (F.col("_n") == 0))
    return both.select(*cols)


def new_run() -> str:
    """A name for a writer's run; later runs sort after earlier ones."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _log_schema(schema: StructType) -> StructType:
    return StructType([*schema.fields]).add(RUN, StringType()).add(BATCH, LongType())


def append_batch(df: DataFrame, path: str, run: str, batch_id: int) -> None:
    """Write one batch of a run; writing it again replaces it."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{RUN}={run}/{BATCH}={int(batch_id)}")


def read_log(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows of a table's batches, with the run and batch they came in.  A
    folder that does not exist is an empty table; any other failure raises."""
    try:
        return spark.read.schema(_log_schema(schema)).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _log_schema(schema))


def read_table(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str] = ("event_id",)) -> DataFrame:
    """The table's current rows: a key's row of the latest batch of the latest run."""
    return latest_per(read_log(spark, path, schema), list(keys), [RUN, BATCH]).select(*schema.names)


def position(spark: SparkSession, path: str, schema: StructType) -> tuple[str, int] | None:
    """(run, batch) of the latest batch with rows; None for an empty table."""
    latest = read_log(spark, path, schema).agg(F.max(F.struct(RUN, BATCH)).alias("p")).first().p
    return None if latest is None else (latest[RUN], latest[BATCH])


def changed_rows(spark: SparkSession, path: str, schema: StructType, since: tuple[str, int] | None,
                 until: tuple[str, int], keys: Sequence[str] = ("event_id",)) -> DataFrame:
    """What batches behind ``since`` up to ``until`` wrote, and what their keys
    were before: all rows of the log that such a change may concern.  Folders
    outside the range are read for the keys' earlier rows only."""
    log, at = read_log(spark, path, schema), F.struct(RUN, BATCH)
    to = F.struct(F.lit(until[0]).alias(RUN), F.lit(until[1]).cast("long").alias(BATCH))
    log = log.filter(at <= to)
    if since is None:
        return log.select(*schema.names)
    new = log.filter(at > F.struct(F.lit(since[0]).alias(RUN), F.lit(since[1]).cast("long").alias(BATCH)))
    return new.select(*schema.names).unionByName(log.join(new.select(*keys).distinct(), list(keys), "left_semi").select(*schema.names))


def ensure_table(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str] = ("event_id",)) -> DataFrame:
    """Create the table if its folder does not exist (an empty batch that
    no query's batch can replace); return it."""
    try:
        spark.read.schema(_log_schema(schema)).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        append_batch(spark.createDataFrame([], schema), path, "0", -1)
    return read_table(spark, path, schema, keys)


def reset_table(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str] = ("event_id",)) -> DataFrame:
    """Truncate the table."""
    spark.createDataFrame([], _log_schema(schema)).write.mode("overwrite").partitionBy(RUN, BATCH).parquet(path)
    append_batch(spark.createDataFrame([], schema), path, "0", -1)
    return read_table(spark, path, schema, keys)


def upsert_table(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], schema: StructType,
                 run: str | None = None, batch_id: int = 0) -> DataFrame:
    """Merge ``updates``, one row a key, into the table at ``path``; a
    repeated (run, batch) replaces what it wrote.  Duplicate keys raise."""
    k0 = keys[0]
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    checked = (updates.select(*schema.names).withColumn("_n", n)
               .withColumn(k0, F.when(F.col("_n") > 1, F.raise_error(F.lit("upsert: duplicate keys in the update set")))
                           .otherwise(F.col(k0))).drop("_n"))
    append_batch(checked, path, run or new_run(), batch_id)
    return read_table(spark, path, schema, keys)


def write_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Overwrite the partitions that ``df`` has rows of, and no others."""
    (df.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))
