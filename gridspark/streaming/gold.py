"""Streaming gold: feeder windows, fault join and event upserts (T1s-T8s).

* T1s/T2s: event-time watermark, tumbling windows, append mode -- a window
  is emitted once the watermark passes its end; late rows of a closed
  window are dropped.
* T3s: distinct devices per window, exact by two chained window aggregates, or
  approximate.
* T4s: stream-static left join with fault counts.  The static frame is the
  fault table as it was when the query was built; a long-running query takes
  ``upsert_health_batch``, which reads the faults anew for each micro-batch.
* T7s: ``foreachBatch`` upserts that a retried batch repeats without effect.
* T8s: a full refresh starts from a new checkpoint folder and fills a new version
  of the table (``sources/versions.py``), which readers take when it is complete.
"""
from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import health as H
from ..operators.quality import only_source
from ..operators.windows import latest_per
from ..session import checkpoint_dir
from ..sources import keyed, tables, versions


def event_time(df: DataFrame, col: str = "ts") -> DataFrame:
    """Watermarks need a session-zone ``timestamp`` (not ``timestamp_ntz``)."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def feeder_windows_stream(readings: DataFrame, width: str = "1 minute", watermark: str = "30 seconds",
                          exact: bool = True, source: str | None = S.SYNTHETIC) -> DataFrame:
    r = event_time(only_source(readings, source) if source else readings).withWatermark("ts", watermark)
    return H.feeder_windows(r, width, exact, source=None)


def feeder_health_stream(readings: DataFrame, faults: DataFrame, width: str = "1 minute",
                         watermark: str = "30 seconds", exact: bool = True) -> DataFrame:
    """Streaming A2: windows (stream) left-joined with fault counts (static)."""
    return H.with_fault_counts(feeder_windows_stream(readings, width, watermark, exact), faults, width)


#: Emissions of an event in order: the last one says its status.
EMISSION_ORDER = ("timestamp", "reading_id")


def upsert_events_batch(path: str, run: str):
    """A ``foreachBatch`` function that appends each micro-batch of emissions,
    reduced to each event's last one, to the log at ``path`` as a batch of
    ``run`` (``tables.new_run()`` for a fresh checkpoint; the same name when a
    query resumes its own), so that ``tables.read_table`` shows every event's
    last status."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        last = latest_per(batch, "event_id", list(EMISSION_ORDER)).select(*batch.columns)
        tables.append_batch(last, path, run, batch_id)
    return fn


def upsert_keyed_batch(path: str, run: str, keys=("event_id",), order=EMISSION_ORDER):
    """A ``foreachBatch`` function that merges each micro-batch into the keyed
    table at ``path`` (``sources/keyed.py``): a batch rewrites the buckets of
    its keys, readers find one row a key."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        keyed.upsert_keyed(batch, path, run, batch_id, keys, order)
    return fn


def read_health(spark: SparkSession, path: str) -> DataFrame | None:
    """Stored feeder health with its ``day``, of the current version if the
    table has versions; None before the first batch."""
    try:
        return spark.read.parquet(versions.current_folder(spark, path))
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def upsert_health_batch(path: str, faults_reader, width: str = "1 minute", faults_log: str | None = None):
    """A ``foreachBatch`` function for the windowed stream (without the
    join): each micro-batch of closed windows gets the counts of the fault
    table as it is now (``faults_reader(spark)``), and windows stored earlier
    whose count has changed meanwhile get their new one.

    Health is partitioned by day; only the days of new windows and of changed
    counts are written.  With ``faults_log``, the folder of the fault table's
    log, the changed days are those of the faults that came since the batch
    before (``tables.changed_rows``), and nothing else of the stored history is
    read; each batch notes how far it saw the log, and a retry starts from the
    note of the batch before it.  Without, finding them reads two columns of
    the stored windows and joins them with the counts."""
    notes = f"{path.rstrip('/')}-seen"

    def seen_before(spark: SparkSession, batch_id: int) -> tuple[str, int] | None:
        try:
            noted = spark.read.schema(_NOTE + ", of_batch long").parquet(notes).filter(F.col("of_batch") < batch_id)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        last = noted.agg(F.max_by(F.struct("run", "batch"), "of_batch").alias("p")).first().p
        return None if last is None else (last.run, last.batch)

    def changed_days(spark: SparkSession, stored: DataFrame | None, faults: DataFrame, now, batch_id: int) -> DataFrame | None:
        if stored is None:
            return None
        if faults_log is None:
            counts = H.fault_counts(faults, width).withColumnRenamed("fault_count", "_now")
            return (stored.select(*H.KEY, "fault_count", "day").join(counts, H.KEY, "left")
                    .filter(F.col("fault_count") != F.coalesce("_now", F.lit(0))).select("day"))
        since = seen_before(spark, batch_id)
        if now is None or since == now:
            return spark.createDataFrame([], "day date")
        rows = tables.changed_rows(spark, faults_log, S.FAULTS, since, now)
        return H.by_day(rows.select(F.window("timestamp", width).start.alias("window_start"))).select("day").distinct()

    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        now = tables.position(spark, faults_log, S.FAULTS) if faults_log else None
        faults = faults_reader(spark)
        fresh = H.by_day(H.with_fault_counts(batch, faults, width))
        stored = read_health(spark, path)
        days = changed_days(spark, stored, faults, now, batch_id)
        if days is not None:
            days = days.union(fresh.select("day")).distinct()
            older = H.by_day(H.refresh_fault_counts(stored.join(days, "day", "left_semi").drop("day"), faults, width))
            fresh = tables.upsert(older, fresh, H.KEY)
        # written aside first: the partitions that are read are those that are replaced
        aside = f"{checkpoint_dir(spark).rstrip('/')}/gridspark-health/{uuid.uuid4().hex}"
        fresh.write.parquet(aside)
        tables.write_partitions(spark.read.schema(fresh.schema).parquet(aside), path, ["day"])
        if now is not None:  # last: a batch that failed before this looks at the same changes again
            spark.createDataFrame([now], _NOTE).coalesce(1).write.mode("overwrite").parquet(f"{notes}/of_batch={int(batch_id)}")
    return fn


#: How far a batch of health saw the fault table's log.
_NOTE = "run string, batch long"


def fresh_checkpoint(base: str) -> str:
    """T8s: a new checkpoint folder for a full refresh (the old one is left
    in place; its offsets refer to files that may be gone)."""
    return f"{base.rstrip('/')}/ckpt-{uuid.uuid4().hex}"
