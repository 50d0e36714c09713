"""As-of overlay of known fault intervals onto readings.

A reading takes its device's fault with the latest ``start_time <= ts``
(a newer fault replaces an older one), and only while that fault is active:
``ts < start_time + duration_s``.

Spark has no as-of join.  A plain range join would enumerate pairs and
duplicate rows where faults overlap, so this is a sort-based as-of:
readings and faults are unioned and ``last(..., ignorenulls)`` runs over the
ordered stream, cut by (device, time bucket) to keep a hot device from landing
in one task.  The schedule alone says which buckets a fault governs: from its
start to its end or to the start of the next fault of its device.  It is
expanded to a row for each of these buckets, so buckets carry nothing into one
another and the readings are read and shuffled once.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FAULT_COLS = ["fault_id", "fault_type", "start_time", "duration_s",
              "voltage_factor", "current_factor", "freq_offset_hz"]


def _bucket(col: str, seconds: int):
    return F.floor(F.unix_micros(F.col(col)) / F.lit(seconds * 1_000_000)).cast("long")


def asof_active(left: DataFrame, schedule: DataFrame, key: str = "device_id", time_col: str = "ts",
                bucket_seconds: int = 3600) -> DataFrame:
    """Left rows plus the active fault's columns (NULL when none).

    The schedule's ``fault_type`` comes back as ``truth_type``."""
    fstruct = F.struct(*[F.col(c) for c in FAULT_COLS])
    width = bucket_seconds * 1_000_000
    newer = F.lead(F.unix_micros("start_time")).over(Window.partitionBy("device_id").orderBy("start_time", "fault_id"))
    begin = F.unix_micros("start_time")
    end = begin + F.round(F.col("duration_s") * F.lit(1e6)).cast("long")
    governed = (schedule.select(F.col("device_id").alias(key), begin.alias("_begin"), fstruct.alias("_f"),
                                F.when(newer < end, newer).otherwise(end).alias("_end"))
                .filter(F.col("_end") > F.col("_begin")))
    first, last = (F.floor(c / F.lit(width)).cast("long") for c in (F.col("_begin"), F.col("_end") - 1))
    faults = governed.select(key, "_f", "_begin", first.alias("_first"), F.explode(F.sequence(first, last)).alias("_b"))
    lrows = left.withColumn("_b", _bucket(time_col, bucket_seconds))
    ftype = faults.schema["_f"].dataType
    lcols = [c for c in left.columns if c != key]
    # a fault that began in an earlier bucket stands before all readings of this one
    marks = faults.select(key, "_b", "_f", F.when(F.col("_b") == F.col("_first"), F.col("_begin")).alias("_t"), F.lit(0).alias("_k"),
                          *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in lcols])
    rows = lrows.select(key, "_b", F.lit(None).cast(ftype).alias("_f"), F.unix_micros(time_col).alias("_t"), F.lit(1).alias("_k"), *lcols)
    w = Window.partitionBy(key, "_b").orderBy("_t", "_k").rowsBetween(Window.unboundedPreceding, 0)
    picked = marks.unionByName(rows).withColumn("_cur", F.last("_f", ignorenulls=True).over(w)).filter(F.col("_k") == 1)
    end_us = F.unix_micros("_cur.start_time") + F.round(F.col("_cur.duration_s") * F.lit(1e6)).cast("long")
    active = F.col("_cur").isNotNull() & (F.unix_micros(F.col(time_col)) < end_us)
    out_cols = [c for c in left.columns]
    fault_out = [F.when(active, F.col(f"_cur.{c}")).alias("truth_type" if c == "fault_type" else c)
                 for c in FAULT_COLS]
    return picked.select(*[F.col(c) for c in out_cols], *fault_out)


def overlay_faults(readings: DataFrame, schedule: DataFrame, bucket_seconds: int = 3600) -> DataFrame:
    """Readings with active faults applied: voltage x factor, current x
    factor, frequency + offset, ``event_flag`` 1 and the truth columns."""
    j = asof_active(readings, schedule, bucket_seconds=bucket_seconds)
    on = F.col("fault_id").isNotNull()
    passthrough = [c for c in readings.columns
                   if c not in ("voltage", "current", "frequency", "event_flag", "_fault_id", "_fault_type_truth")]
    return j.select(
        *passthrough,
        F.when(on, F.col("voltage") * F.col("voltage_factor")).otherwise(F.col("voltage")).alias("voltage"),
        F.when(on, F.col("current") * F.col("current_factor")).otherwise(F.col("current")).alias("current"),
        F.when(on, F.col("frequency") + F.col("freq_offset_hz")).otherwise(F.col("frequency")).alias("frequency"),
        F.when(on, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("event_flag"),
        F.col("fault_id").alias("_fault_id"),
        F.col("truth_type").alias("_fault_type_truth"),
    )
