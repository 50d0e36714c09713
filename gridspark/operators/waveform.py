"""Waveform captures -> long rows -> one row per (capture, step).

Both steps are generators and one pivot aggregate: no Python, and the
pivot is combined map-side per (capture, time step), so a capture of any
length never has to fit in one task's memory (the grouped pandas pivot did).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The channels the wide table keeps.
WIDE_CHANNELS = ("IA", "IB", "IC")


def flatten_waveform(raw: DataFrame) -> DataFrame:
    """One row per (capture, time step, channel).

    Time steps pair ``microseconds`` with ``analog`` rows; channels pair
    ``analog_channel_names`` with the step's values.  The shorter array is
    NULL-padded; NULL or empty arrays give no rows.  ``channel_pos`` keeps
    the channel's position for a deterministic pick in the pivot."""
    steps = (raw.select("base_name", "station_name", "analog_channel_names",
                        F.inline(F.arrays_zip(F.col("microseconds"), F.col("analog"))))
                .withColumn("ts", F.timestamp_micros("microseconds")))
    n = F.greatest(F.size("analog_channel_names"), F.size("analog"))
    idx = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    chans = steps.select(
        F.col("base_name").alias("event_id"), "ts", "station_name",
        F.inline(F.arrays_zip(F.col("analog_channel_names"), F.col("analog"), idx.alias("channel_pos"))))
    return chans.select("event_id", "ts", "station_name",
                        F.col("analog_channel_names").alias("analog_channel_name"),
                        F.col("analog").alias("analog_value"),
                        F.col("channel_pos").cast("int").alias("channel_pos"))


def pivot_channels(long: DataFrame, names: Sequence[str] = WIDE_CHANNELS) -> DataFrame:
    """R2: channels to columns; the lowest-position non-NULL value wins,
    missing channels are NULL.  Rows without a value or a station do not
    count; a step with only unlisted channels still yields a row."""
    kept = long.filter(F.col("analog_value").isNotNull() & F.col("station_name").isNotNull())
    # one aggregate (one exchange): per channel, the value at the lowest
    # position among that channel's rows (other rows have a NULL ordering
    # key, which min_by skips) -- the same result as pivot(), which plans a
    # second aggregation level for this function
    picks = [F.min_by("analog_value", F.when(F.col("analog_channel_name") == F.lit(c), F.col("channel_pos")))
             .alias(c) for c in names]
    return kept.groupBy("event_id", "ts", "station_name").agg(*picks)
