"""Frozen-baseline detector and its event bookkeeping.

Per device, a baseline of the last ``window`` *normal* readings (voltage,
current) scores each new reading with a population-sigma z (sigma 0 ->
1e-6).  Anomalous readings never enter the baseline, so a long fault keeps
scoring high.  Emissions:

* first anomalous reading of a run -> the event opens (``fault_type`` NULL);
* each further anomalous reading once ``ts - start >= sustained_s`` ->
  ``sustained`` (the in-flight upgrade);
* the first normal reading after a run -> ``sustained``/``transient`` by
  ``ts - start``, and the event closes.

The recursion (the baseline depends on earlier verdicts) cannot be written
as window functions, so the batch operator is: hash-partition by device,
sort by (device, ts, reading_id) inside partitions, then ``mapInPandas``
walks each partition once with O(window) state per device, carrying the
state across Arrow batches.  Event ids, timestamps and confidence are
computed back in the JVM.

Hot devices: the state is tiny, but the walk over one device is serial, so
every device is split into segments of ``segment_rows`` readings that run in
parallel from a speculative start state (warmed up on the ``warmup`` readings
before each segment); each segment's start state is then checked against the
end state of the segment before it, and wrong ones are run again from the true
state, in rounds, until all agree -- the result is exact, usually after one
round.  ``segment_rows=None`` walks each device whole, for callers who know
that none is hot.

One rule for gaps in both plans: readings without a time, voltage or current
are skipped; readings without a device are one device of their own.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from .. import schemas as S
from ..functions import confidence, event_key
from .quality import only_source

# Output of the Python walk; everything else is derived in the JVM.
EMIT_SCHEMA = StructType([
    StructField("device_id", StringType()),
    StructField("feeder_id", StringType()),
    StructField("reading_id", StringType()),
    StructField("ts_us", LongType()),
    StructField("start_us", LongType()),
    StructField("fault_type", StringType()),
    StructField("peak_z", DoubleType()),
])


def _stats(win: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and population sigma (0 -> 1e-6) over the last axis, which must be
    contiguous: then a row's sums do not depend on the rows beside it."""
    m = win.sum(axis=-1) / win.shape[-1]
    d = win - m[..., None]
    sd = np.sqrt((d * d).sum(axis=-1) / win.shape[-1])
    sd[sd == 0] = 1e-6
    return m, sd


class FrozenBaseline:
    """One device's detector, fed with stretches of its readings in order.

    ``base`` holds the last normal readings, a row a channel; ``start_us``,
    ``peak`` and ``feeder`` describe the open event.  Stretches are scored
    whole, however they are cut: while no event is open, each reading against
    the window that slides over the normal readings before it, up to the first
    anomalous one; while one is open the baseline stands still, so all against
    the same statistics up to the first normal one."""

    FIRST, LARGEST = 16, 512  # readings scored at a time; doubled while nothing changes

    def __init__(self, window: int, min_n: int, vth: float, cth: float, sustained_s: float):
        self.window, self.ready = window, max(2, min_n)
        self.limits = np.array([[vth], [cth]])
        self.sustained_us = sustained_s * 1_000_000.0
        self.base = np.zeros((2, 0))
        self.start_us, self.peak, self.feeder = None, 0.0, None
        self.top = 0.0

    # state as plain values, for streaming state stores and segment checks
    def get_state(self):
        return (*self.base.tolist(), self.start_us, self.peak, self.feeder)

    def set_state(self, st):
        bv, bc, self.start_us, peak, self.feeder = st
        self.base = np.array([[] if bv is None else bv, [] if bc is None else bc], dtype=np.float64)
        self.peak = peak or 0.0

    def run(self, ts: np.ndarray, v: np.ndarray, c: np.ndarray, feeder, until_closed: bool = False) -> pd.DataFrame:
        """Emissions of a stretch: ``idx`` (place in it), ``fault_type`` (None:
        opened), ``start_us``, ``peak_z`` and ``feeder_id``.  ``until_closed``
        stops where the open event closes; ``top`` is the highest peak seen."""
        x = np.stack([v, c]).astype(np.float64)
        parts: list[tuple] = []  # (places, type, start, peaks, feeder)
        i, size = 0, self.FIRST
        while i < x.shape[1] and not (until_closed and self.start_us is None):
            step = self._frozen if self.start_us is not None else self._sliding
            i, calm = step(ts, x, feeder, i, size, parts)
            size = min(2 * size, self.LARGEST) if calm else self.FIRST
        return pd.DataFrame({
            "idx": np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64),
            "fault_type": np.repeat(np.array([p[1] for p in parts], object), [len(p[0]) for p in parts]),
            "start_us": np.repeat(np.array([p[2] for p in parts], np.int64), [len(p[0]) for p in parts]),
            "peak_z": np.concatenate([p[3] for p in parts]) if parts else np.zeros(0),
            "feeder_id": np.repeat(np.array([p[4] for p in parts], object), [len(p[0]) for p in parts])})

    def _sliding(self, ts, x, feeder, i, size, parts):
        """No event is open.  Returns (the next reading, whether all were normal)."""
        m, n = self.base.shape[1], x.shape[1]
        if m < self.ready:  # too few to score: all are normal
            j = n if self.ready > self.window else min(n, i + self.ready - m)
            self.base = np.concatenate([self.base, x[:, i:j]], axis=1)[:, -self.window:]
            return j, False
        j = min(n, i + (size if m == self.window else 1))  # a baseline still growing has another width each time
        both = np.concatenate([self.base, x[:, i:j]], axis=1)
        mean, sd = _stats(np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(both, m, axis=1)[:, :j - i]))
        z = np.abs((x[:, i:j] - mean) / sd)
        odd = (z >= self.limits).any(axis=0)
        k = int(odd.argmax()) if odd.any() else j - i
        self.base = both[:, max(0, m + k - self.window):m + k]
        if k == j - i:
            return j, True
        self.start_us, self.peak, self.feeder = int(ts[i + k]), float(np.fmax(*z[:, k])), feeder[i + k]
        parts.append((np.array([i + k]), None, self.start_us, np.array([self.peak]), self.feeder))
        return i + k + 1, False

    def _frozen(self, ts, x, feeder, i, size, parts):
        """An event is open.  Returns (the next reading, whether it still is)."""
        j = min(x.shape[1], i + size)
        mean, sd = _stats(np.ascontiguousarray(self.base))
        z = np.abs((x[:, i:j] - mean[:, None]) / sd[:, None])
        normal = ~(z >= self.limits).any(axis=0)
        k = int(normal.argmax()) if normal.any() else j - i
        peaks = np.fmax.accumulate(np.concatenate([[self.peak], np.fmax(z[0, :k], z[1, :k])]))
        self.peak = self.top = float(peaks[-1])
        due = np.flatnonzero(ts[i:i + k] - self.start_us >= self.sustained_us)
        if len(due):
            parts.append((i + due, S.SUSTAINED, self.start_us, peaks[1:][due], self.feeder))
        if k == j - i:
            return j, True
        long = int(ts[i + k]) - self.start_us >= self.sustained_us
        parts.append((np.array([i + k]), S.SUSTAINED if long else S.TRANSIENT, self.start_us, np.array([self.peak]), self.feeder))
        self.base = np.concatenate([self.base, x[:, i + k:i + k + 1]], axis=1)[:, -self.window:]
        self.start_us, self.peak, self.feeder = None, 0.0, None
        return i + k + 1, False


def emitted(e: pd.DataFrame, device, rid: np.ndarray, ts_us: np.ndarray) -> pd.DataFrame:
    """The emissions of one stretch as EMIT_SCHEMA rows."""
    at = e["idx"].to_numpy()
    return e.assign(device_id=device, reading_id=rid[at], ts_us=ts_us[at])[EMIT_SCHEMA.names]


def _walk(params: dict):
    """mapInPandas body: rows arrive sorted by (device, ts, reading_id);
    a device's run may span Arrow batches (the machine carries over)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dev, m = None, None
        for pdf in batches:
            if not len(pdf):
                continue
            d, f, rid = (pdf[x].to_numpy() for x in ("device_id", "feeder_id", "reading_id"))
            t, v, c = (pdf[x].to_numpy(dtype=k) for x, k in (("ts_us", np.int64), ("voltage", np.float64), ("current", np.float64)))
            cuts = np.flatnonzero(d[1:] != d[:-1]) + 1
            found = []
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(d)]):
                if m is None or d[a] != dev:
                    dev, m = d[a], FrozenBaseline(**params)
                e = m.run(t[a:b], v[a:b], c[a:b], f[a:b])
                if len(e):
                    found.append(emitted(e, dev, rid[a:b], t[a:b]))
            if found:
                yield pd.concat(found, ignore_index=True)
    return run


def _finish(emits: DataFrame, full_scale: float, digits: int) -> DataFrame:
    start = F.timestamp_micros("start_us")
    return emits.select(
        event_key("device_id", start).alias("event_id"),
        "device_id", "feeder_id",
        F.timestamp_micros("ts_us").alias("timestamp"),
        "fault_type",
        confidence("peak_z", full_scale, digits).alias("confidence_score"),
        "reading_id",
    )


def _prepared(readings: DataFrame, source, more=()):
    r = only_source(readings, source) if source else readings
    return (r.filter(F.col("voltage").isNotNull() & F.col("current").isNotNull() & F.col("ts").isNotNull())
             .select("device_id", "feeder_id", "reading_id",
                     F.unix_micros("ts").alias("ts_us"), "voltage", "current", *more))


def detect_frozen(readings: DataFrame, z: float = S.DEFAULT_Z_THRESHOLD,
                  current_z: float | None = None,
                  sustained_s: float = S.DEFAULT_SUSTAINED_THRESHOLD_S,
                  window: int = S.DEFAULT_WINDOW_SIZE, min_n: int = S.DEFAULT_MIN_BASELINE_READINGS,
                  full_scale: float = S.CONFIDENCE_Z_FULL_SCALE, source: str | None = S.SYNTHETIC,
                  num_partitions: int | None = None, digits: int = 3,
                  segment_rows: int | None = 1_000_000, warmup: int = 300, bucket_seconds: int = 60) -> DataFrame:
    """Emissions of the frozen-baseline detector, in batch.

    Columns: event_id, device_id, feeder_id, timestamp (of the emitting
    reading), fault_type (NULL = opened), confidence_score, reading_id."""
    params = dict(window=window, min_n=min_n, vth=float(z),
                  cth=float(z if current_z is None else current_z), sustained_s=float(sustained_s))
    r = _prepared(readings, source)
    if segment_rows:
        from .detect_segments import walk_segmented
        return _finish(walk_segmented(r, params, segment_rows, warmup, bucket_seconds), full_scale, digits)
    # by count: the walk is CPU-bound Python, so AQE must not coalesce its
    # input into a few tasks (at scale every partition is large anyway)
    n = num_partitions or int(r.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = r.repartition(n, "device_id").sortWithinPartitions("device_id", "ts_us", "reading_id")
    emits = ordered.mapInPandas(_walk(params), EMIT_SCHEMA)
    return _finish(emits, full_scale, digits)


def event_status(emissions: DataFrame) -> DataFrame:
    """One row per event -- its latest emission (by time, then reading).

    ``max_by`` is combined map-side, so a long event is never gathered."""
    cols = ["device_id", "feeder_id", "timestamp", "fault_type", "confidence_score"]
    picked = F.max_by(F.struct(*cols), F.struct("timestamp", "reading_id"))
    return (emissions.groupBy("event_id").agg(picked.alias("_r"))
                     .select("event_id", *[F.col(f"_r.{c}").alias(c) for c in cols]))


def event_summary(emissions: DataFrame) -> DataFrame:
    """One row per event with its *start* as ``timestamp`` (the opening
    emission) and its latest type and confidence -- the shape of the
    windowed detector's events, for scoring and serving."""
    latest = F.max_by(F.struct("fault_type", "confidence_score"), F.struct("timestamp", "reading_id"))
    return (emissions.groupBy("event_id")
            .agg(F.first("device_id").alias("device_id"),
                 F.min_by("feeder_id", F.struct("timestamp", "reading_id")).alias("feeder_id"),
                 F.min("timestamp").alias("timestamp"), latest.alias("_l"))
            .select("event_id", "device_id", "feeder_id", "timestamp",
                    F.col("_l.fault_type").alias("fault_type"),
                    F.col("_l.confidence_score").alias("confidence_score")))


def score_detections(events: DataFrame, schedule: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Score detected events against known fault intervals.

    Each event takes the fault active on its device at its start (the as-of
    overlay of ``overlay.py``, no pair enumeration).  Output, one row:
    faults, faults_detected, recall, events, false_alarms, type_agreement."""
    from .overlay import asof_active
    hit = asof_active(events.select("event_id", "device_id", F.col(time_col).alias("ts"), "fault_type"),
                      schedule)
    per_event = hit.select(
        "event_id", "fault_id",
        (F.col("fault_id").isNotNull() & (F.col("fault_type") == F.col("truth_type"))).alias("agree"))
    ev = per_event.agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("fault_id").isNull()).alias("false_alarms"),
        F.count_if(F.col("agree")).alias("type_agreement"),
        F.count_distinct("fault_id").alias("faults_detected"))
    total = schedule.select(F.count(F.lit(1))).scalar()  # scalar subquery, no join
    return ev.select(total.alias("faults"), "faults_detected",
                     F.round(F.col("faults_detected") / F.nullif(total, F.lit(0)), 6).alias("recall"),
                     "events", "false_alarms", "type_agreement")
