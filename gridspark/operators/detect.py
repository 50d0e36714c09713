"""Windowed (spike) detector, declarative.

rolling baseline -> max |z| -> flag -> islands -> one row per event.

The baseline window includes earlier readings of the same fault, so a long
fault scores lower and lower and is rarely called ``sustained`` at the
default thresholds; ``detect_frozen`` (``detect_state.py``) keeps a frozen
baseline instead.  This operator is the spike detector.

Two physical strategies, one result: rows without a time come first and count
in the baselines after them, rows without a device are one device of their own.

* ``"segmented"`` (default): a device with more than ``segment_rows`` readings
  is cut into time ranges of about as many (``time_segments``), each with the
  ``window`` readings before it; the readings are shuffled by (device, range)
  once, where the rolling baseline runs.  Event membership is keyed by the
  place of the last normal reading before each anomalous one, carried across
  ranges through one summary row a range.  A device holding a third of all
  rows is spread over many tasks.
* ``"device"``: the plain SQL shape -- one window partition per device (one
  exchange, one sort), for callers who know that no device is hot.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import confidence, event_key
from .quality import only_source
from .windows import flag_anomalies, islands, rolling_baseline, time_segments, zscore

CHANNELS = ("voltage", "current")


def _events(anomalous: DataFrame, group_cols, sustained_s: float, full_scale: float,
            digits: int | None) -> DataFrame:
    ev = anomalous.groupBy(*group_cols).agg(
        F.min("ts").alias("_start"), F.max("ts").alias("_end"),
        F.min("feeder_id").alias("feeder_id"), F.max("abs_z").alias("_peak"))
    return _event_rows(ev, sustained_s, full_scale, digits)


def _event_rows(ev: DataFrame, sustained_s: float, full_scale: float, digits: int | None) -> DataFrame:
    dur = F.unix_timestamp("_end") - F.unix_timestamp("_start")
    return ev.select(
        event_key("device_id", "_start").alias("event_id"),
        "device_id", "feeder_id",
        F.col("_start").alias("timestamp"),
        F.when(dur >= F.lit(float(sustained_s)), F.lit(S.SUSTAINED)).otherwise(F.lit(S.TRANSIENT)).alias("fault_type"),
        confidence("_peak", full_scale, digits).alias("confidence_score"),
    )


def detect_windowed(readings: DataFrame, z: float = S.DEFAULT_Z_THRESHOLD,
                    sustained_s: float = S.DEFAULT_SUSTAINED_THRESHOLD_S,
                    window: int = S.DEFAULT_WINDOW_SIZE, min_n: int = S.DEFAULT_MIN_BASELINE_READINGS,
                    full_scale: float = S.CONFIDENCE_Z_FULL_SCALE, source: str | None = S.SYNTHETIC,
                    strategy: str = "segmented", segment_rows: int = 1_000_000,
                    bucket_seconds: int = 60, digits: int | None = None) -> DataFrame:
    """Fault events (FAULTS schema) from silver readings."""
    r = only_source(readings, source) if source else readings
    r = r.select("reading_id", "device_id", "feeder_id", "ts", *CHANNELS)

    if strategy == "device":
        scored = zscore(rolling_baseline(r, CHANNELS, window))
        marked = islands(flag_anomalies(scored, z, min_n, CHANNELS))
        anomalous = marked.filter(F.col("is_anomalous") == 1)
        return _events(anomalous, ["device_id", "event_seq"], sustained_s, full_scale, digits)

    if strategy != "segmented":
        raise ValueError(f"unknown strategy {strategy!r}")

    sg = time_segments(r, halo=window, size=segment_rows, bucket_seconds=bucket_seconds)
    keys = ("device_id", "seg")
    order = Window.partitionBy(*keys).orderBy("ts", "reading_id")
    scored = rolling_baseline(sg, CHANNELS, window, keys=keys).withColumn("pos", F.row_number().over(order))
    flagged = flag_anomalies(zscore(scored.filter(~F.col("is_halo"))), z, min_n, CHANNELS)
    anom = F.col("is_anomalous") == 1
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    flagged = flagged.withColumn("_last_normal", F.max(F.when(~anom, F.col("pos"))).over(running))
    # One aggregate, combined map-side: anomalous rows group into runs keyed
    # by the last normal place in their segment (-1: the run continues from
    # an earlier segment); a segment's normal rows collapse into one summary
    # row (-2) with its last normal place.
    k = F.when(anom, F.coalesce(F.col("_last_normal"), F.lit(-1))).otherwise(F.lit(-2)).cast("long")
    parts = (flagged.groupBy("device_id", "seg", k.alias("_k")).agg(
        F.max(F.when(~anom, F.col("pos"))).alias("_seg_normal"),
        F.min(F.when(anom, F.col("ts"))).alias("ts"),
        F.max(F.when(anom, F.col("ts"))).alias("_end"),
        F.min(F.when(anom, F.col("feeder_id"))).alias("feeder_id"),
        F.max(F.when(anom, F.col("abs_z"))).alias("abs_z")))
    # Only summaries meet in a window per device: a row a segment.  The runs
    # that continue, at most one a segment, join what it finds.
    whole = parts.groupBy("device_id", "seg").agg(F.max("_seg_normal").alias("_own"))
    place = F.when(F.col("_own").isNotNull(), F.struct("seg", F.col("_own").cast("long").alias("pos")))
    carry = F.last(place, ignorenulls=True).over(Window.partitionBy("device_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1))
    whole = whole.select(F.struct("device_id", "seg").alias("_s"), carry.alias("_carry"))
    runs = parts.filter(F.col("_k") != -2)
    runs = (runs.join(whole, runs["device_id"].eqNullSafe(F.col("_s.device_id")) & (runs["seg"] == F.col("_s.seg")))
                .withColumn("_run", F.when(F.col("_k") == -1, F.col("_carry")).otherwise(F.struct("seg", F.col("_k").alias("pos")))))
    ev = runs.groupBy("device_id", "_run").agg(
        F.min("ts").alias("_start"), F.max("_end").alias("_end"),
        F.min("feeder_id").alias("feeder_id"), F.max("abs_z").alias("_peak"))
    return _event_rows(ev, sustained_s, full_scale, digits)
