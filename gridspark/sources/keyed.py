"""T7s, S8: a keyed table for streaming upserts, one row a key.

Rows are dealt by the hash of their key into a fixed number of buckets.  A
micro-batch is first reduced to the latest row a key, in the order of the rows
themselves (an event's opening and its end may come in one batch); then it
writes the merged rows of the buckets it touches, and of no others, as its own
copy ``rows/_run=<run>/_batch=<id>/_bucket=<n>``, and last a head, a row a
bucket that names the copy to read.  Until the head stands readers see the
table without the batch.  A retried batch starts from the heads before it and
writes what it wrote.  Readers open one copy a bucket and merge nothing.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.windows import latest_per

BUCKET, BUCKETS = "_bucket", 32
_HEAD = "bucket int, run string, batch long"


def _heads(spark: SparkSession, path: str, before: tuple[str, int] | None = None) -> dict[int, tuple[str, int]]:
    """(run, batch) of each bucket's copy: at most ``BUCKETS`` small rows."""
    try:
        heads = spark.read.schema(_HEAD + ", at_run string, at_batch long").parquet(f"{path.rstrip('/')}/heads")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    at = F.struct("at_run", "at_batch")
    if before is not None:
        heads = heads.filter(at < F.struct(F.lit(before[0]), F.lit(before[1]).cast("long")))
    latest = heads.groupBy("bucket").agg(F.max_by(F.struct("run", "batch"), at).alias("h"))
    return {r.bucket: (r.h.run, r.h.batch) for r in latest.collect()}


def _copies(spark: SparkSession, path: str, heads: dict[int, tuple[str, int]], schema: StructType) -> DataFrame:
    folders = [f"{path.rstrip('/')}/rows/_run={run}/_batch={batch}/{BUCKET}={bucket}" for bucket, (run, batch) in sorted(heads.items())]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_keyed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table's rows, one a key; a table without batches is empty."""
    return _copies(spark, path, _heads(spark, path), schema)


def upsert_keyed(updates: DataFrame, path: str, run: str, batch_id: int, keys: Sequence[str] = ("event_id",),
                 order: Sequence[str] = ()) -> None:
    """Merge a batch of ``run`` into the table at ``path``.

    Of rows with the same key the one that comes last in ``order`` (columns of
    the table) stays, the batch's own on a tie; without ``order`` the batch's
    row replaces the stored one and duplicate keys in a batch raise.  Runs and
    batches count in their order (``tables.new_run``); an empty batch changes
    nothing."""
    spark, schema, keys = updates.sparkSession, updates.schema, list(keys)
    if order:
        updates = latest_per(updates, keys, list(order)).select(*schema.names)
    else:  # the check sits in a key column so that pruning cannot drop it
        n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
        updates = (updates.withColumn("_n", n).withColumn(keys[0], F.when(
            F.col("_n") > 1, F.raise_error(F.lit("upsert: duplicate keys in the update set"))).otherwise(F.col(keys[0]))).drop("_n"))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    updates = updates.withColumn(BUCKET, bucket).persist()
    try:
        touched = [r[0] for r in updates.select(BUCKET).distinct().collect()]
        if not touched:
            return
        heads = _heads(spark, path, (run, batch_id))
        stored = _copies(spark, path, {b: h for b, h in heads.items() if b in touched}, schema)
        both = stored.withColumn(BUCKET, bucket).withColumn("_new", F.lit(False)).unionByName(updates.withColumn("_new", F.lit(True)))
        merged = latest_per(both, keys, [*order, "_new"]).select(*schema.names, BUCKET)
        part = f"_run={run}/_batch={int(batch_id)}"
        merged.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path.rstrip('/')}/rows/{part}")
        head = spark.createDataFrame([(b, run, int(batch_id)) for b in touched], _HEAD)
        head.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/heads/at_run={run}/at_batch={int(batch_id)}")
    finally:
        updates.unpersist()
