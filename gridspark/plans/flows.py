"""End-to-end flows over landed files: landing -> silver -> gold tables.

Each function is one Spark job (or one streaming query) a scheduler would
run, over folders on shared storage.

* ``silver_batch`` / ``silver_stream``: synthetic readings (parquet) and
  half-hourly meter CSVs -> unified silver readings, partitioned by source.
* ``waveform_batch`` / ``context_batch``: landed captures -> long and wide
  waveform tables; landed regional rows -> the context table.
* ``detect_and_upsert``: silver -> frozen (default) or windowed detector ->
  keyed upsert into the fault classification table.
* ``health_batch`` / ``health_stream``: silver + faults -> feeder health by day.
* ``events_stream``: the streaming detector -> the keyed event table.
* ``refresh``: any of the streams anew, beside the current rows, then a switch (T8s).

Silver, health and events are tables with versions (``sources/versions.py``): a
checkpoint writes a folder of its own, readers take the current one.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import detect, detect_state, health, quality, waveform
from ..sources import keyed, landing, tables, versions
from ..streaming import gold as SG
from ..streaming.detect import detect_frozen_stream


def _silver(readings: DataFrame, meter: DataFrame | None) -> DataFrame:
    syn = quality.expect_or_drop(quality.clean_readings(readings.drop("_ingested_at")))
    if meter is None:
        return syn
    return quality.unify_readings(syn, quality.derive_meter_readings(meter.drop("_ingested_at", "block")))


def silver_batch(spark: SparkSession, readings_path: str, meter_path: str | None, silver_path: str) -> DataFrame:
    """Rebuild the silver table from everything landed so far."""
    meter = landing.read_meter(spark, meter_path) if meter_path else None
    versions.write_version(_silver(landing.read_readings(spark, readings_path), meter), silver_path, "source")
    return read_silver(spark, silver_path)


def silver_stream(spark: SparkSession, readings_path: str, meter_path: str | None, silver_path: str,
                  checkpoint: str, trigger: dict | None = None, max_files_per_trigger: int | None = None,
                  publish: bool = True):
    """Incremental silver: both landing folders as streams, appended to the
    checkpoint's version of the table, partitioned by source.  Returns the
    running query.  Readers take that version from now on, unless ``publish``
    is false (``refresh`` publishes when it is complete)."""
    version = versions.version_of(checkpoint)
    if publish:
        versions.publish(spark, silver_path, version)
    r = landing.read_readings_stream(spark, readings_path, max_files_per_trigger)
    m = landing.read_meter_stream(spark, meter_path, max_files_per_trigger) if meter_path else None
    w = (_silver(r, m).writeStream.outputMode("append").format("parquet").partitionBy("source")
         .option("checkpointLocation", checkpoint))
    if trigger:
        w = w.trigger(**trigger)
    return w.start(versions.folder(silver_path, version))


def read_silver(spark: SparkSession, silver_path: str, stream: bool = False) -> DataFrame:
    """Silver as written by ``silver_batch`` or ``silver_stream``: the current
    version.  A stream stays with the version it began on; after a refresh of
    silver the streams that read it are refreshed too."""
    return (spark.readStream if stream else spark.read).schema(S.READINGS).parquet(versions.current_folder(spark, silver_path))


def refresh(stream, spark: SparkSession, path: str, base: str, *args, **kwargs) -> str:
    """T8s: run ``stream(..., checkpoint, ...)`` (one of this module's) from a
    fresh checkpoint below ``base`` over everything that is there now, into a
    new version of the table at ``path``; switch readers to it when it has
    caught up; return the checkpoint, with which the stream goes on.

    ``args`` are the stream's arguments in order, without its checkpoint.  The
    old checkpoint is not opened (its files may be gone) and the old rows are
    read until the switch, not after it."""
    checkpoint = SG.fresh_checkpoint(base)
    stream(*args, checkpoint=checkpoint, trigger={"availableNow": True}, publish=False, **kwargs).awaitTermination()
    versions.publish(spark, path, versions.version_of(checkpoint))
    return checkpoint


def waveform_batch(raw: DataFrame, long_path: str, wide_path: str) -> tuple[DataFrame, DataFrame]:
    """Landed captures -> the long table, and the wide one from what was stored."""
    spark = raw.sparkSession
    waveform.flatten_waveform(raw).write.mode("overwrite").parquet(long_path)
    long = spark.read.parquet(long_path)
    waveform.pivot_channels(long).write.mode("overwrite").parquet(wide_path)
    return long, spark.read.parquet(wide_path)


def context_batch(raw: DataFrame, path: str) -> DataFrame:
    """Landed regional rows -> the context table."""
    quality.grid_context(raw).write.mode("overwrite").parquet(path)
    return raw.sparkSession.read.parquet(path)


def detect_and_upsert(spark: SparkSession, silver: DataFrame, faults_path: str, run: str, batch_id: int = 0,
                      detector: str = "frozen", **thresholds) -> DataFrame:
    """Detect over the silver readings and merge the events, one row per event
    id stamped with the event's start, into the fault classification table."""
    if detector == "frozen":
        events = detect_state.event_summary(detect_state.detect_frozen(silver, **thresholds))
    elif detector == "windowed":
        events = detect.detect_windowed(silver, **thresholds)
    else:
        raise ValueError(f"unknown detector {detector!r}")
    tables.ensure_table(spark, faults_path, S.FAULTS)
    return tables.upsert_table(spark, faults_path, events, ["event_id"], S.FAULTS, run, batch_id)


def health_batch(spark: SparkSession, silver: DataFrame, faults_path: str, health_path: str,
                 width: str = "1 minute") -> DataFrame:
    """Rebuild feeder health, partitioned by day."""
    faults = tables.read_table(spark, faults_path, S.FAULTS)
    rows = health.by_day(health.feeder_health(silver, faults, width))
    versions.write_version(rows.repartition("day"), health_path, "day")
    return SG.read_health(spark, health_path)


def health_stream(spark: SparkSession, silver_stream_df: DataFrame, faults_path: str, health_path: str,
                  checkpoint: str, width: str = "1 minute", watermark: str = "30 seconds",
                  trigger: dict | None = None, publish: bool = True):
    """Streaming feeder health; fault counts re-read from the fault table at
    every micro-batch and refreshed for stored windows."""
    version = versions.version_of(checkpoint)
    if publish:
        versions.publish(spark, health_path, version)
    w = (SG.feeder_windows_stream(silver_stream_df, width, watermark).writeStream
         .foreachBatch(SG.upsert_health_batch(versions.folder(health_path, version),
                                              lambda s: tables.read_table(s, faults_path, S.FAULTS), width, faults_path))
         .option("checkpointLocation", checkpoint))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def events_stream(spark: SparkSession, silver_stream_df: DataFrame, events_path: str, checkpoint: str,
                  trigger: dict | None = None, publish: bool = True, **thresholds):
    """The streaming detector into the keyed event table, one row an event."""
    version = versions.version_of(checkpoint)
    if publish:
        versions.publish(spark, events_path, version)
    emits = detect_frozen_stream(silver_stream_df, **thresholds)
    w = (emits.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(SG.upsert_keyed_batch(versions.folder(events_path, version), version)))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def read_events(spark: SparkSession, events_path: str) -> DataFrame:
    """Every event's last status, of the event table's current version."""
    return keyed.read_keyed(spark, versions.current_folder(spark, events_path), S.EMISSIONS).select(*S.FAULTS.names)


def count_by_source(silver: DataFrame) -> DataFrame:
    """Bronze/silver bookkeeping: rows per provenance."""
    return quality.source_counts(silver).orderBy(F.col("source"))
