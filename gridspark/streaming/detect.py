"""D3: the frozen-baseline detector on a stream (T6s).

``groupBy(device_id).transformWithStateInPandas`` keeps one value state per
device: the baseline values, the open event (start, peak, feeder) and the
last processed (ts, reading_id).  Within a micro-batch a device's rows may
arrive as several unsorted frames, so they are packed into sorted runs, which
are merged by (ts, reading_id) a stretch at a time; bound them with ``maxFilesPerTrigger`` / ``maxBytesPerTrigger``
at the source, since that is what one task holds of a device at a time.  Rows
at or before the last processed position are late: the walk cannot go back, so
they are skipped and counted in the query's observed metric ``late_readings``
(``late_policy="raise"`` fails instead).

With a ``delay`` readings wait instead (``WaitingProcessor``): they are kept as
list state, and an event-time timer walks them in order once the watermark has
passed them, so readings up to ``delay`` behind the newest one change nothing
about the result; Spark drops and counts later ones (``numRowsDroppedByWatermark``).
Emissions come out ``delay`` behind, and a device without readings for
``idle`` of event time is forgotten.

Output is the append-only stream of emissions (same columns as D2); D4 /
the ``foreachBatch`` upsert turn it into one row per event.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StringType, StructField, StructType

from .. import schemas as S
from ..operators.detect_state import EMIT_SCHEMA, FrozenBaseline, _finish, _prepared, emitted

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Marks the rows in which the processor counts late readings.
LATE = "_late"

STATE_SCHEMA = StructType([
    StructField("bv", ArrayType(DoubleType())),
    StructField("bc", ArrayType(DoubleType())),
    StructField("start_us", LongType()),
    StructField("peak", DoubleType()),
    StructField("feeder", StringType()),
    StructField("last_ts", LongType()),
    StructField("last_rid", StringType()),
])


def _seconds(spark, interval: str) -> float:
    """The length of an interval of days or shorter units."""
    return float(spark.range(1).select(F.expr(f"unix_micros(timestamp_seconds(0) + interval {interval})")).first()[0]) / 1e6


# ---- a device's readings, packed ---------------------------------------------------

ROW = pa.schema([("ts_us", pa.int64()), ("reading_id", pa.string()), ("feeder_id", pa.string()), ("voltage", pa.float64()), ("current", pa.float64())])
ORDER = [("ts_us", "ascending"), ("reading_id", "ascending")]
#: Readings sorted into one run, of one compressed batch of a run, and walked at a time.
RUN_ROWS, BATCH_ROWS, PART_ROWS = 200_000, 4_000, 200_000


def _packed(rows: pa.Table) -> bytes:
    """Sorted readings as a compressed Arrow file of small batches."""
    out = pa.BufferOutputStream()
    with pa.ipc.new_file(out, ROW, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(rows.combine_chunks(), max_chunksize=BATCH_ROWS)
    return out.getvalue().to_pybytes()


def packed_runs(frames: Iterator[pd.DataFrame]) -> Iterator[bytes]:
    """Runs of about ``RUN_ROWS`` readings, each in order and packed."""
    held, n = [], 0
    for pdf in frames:
        if len(pdf):
            held.append(pa.Table.from_pandas(pdf[ROW.names], schema=ROW, preserve_index=False))
            n += len(pdf)
        if n >= RUN_ROWS:
            yield _packed(pa.concat_tables(held).sort_by(ORDER))
            held, n = [], 0
    if held:
        yield _packed(pa.concat_tables(held).sort_by(ORDER))


def _spans(run: bytes) -> list[tuple[int, int]]:
    """The first and last time of each batch of a run."""
    times = pa.ipc.open_file(pa.BufferReader(run), options=pa.ipc.IpcReadOptions(included_fields=[0]))
    found = (times.get_batch(i).column(0) for i in range(times.num_record_batches))
    return [(ts[0].as_py(), ts[-1].as_py()) for ts in found]


def _between(run: bytes, spans: list[tuple[int, int]], lo: int | None, hi: int | None) -> Iterator[pa.RecordBatch]:
    """The readings of a run from time ``lo`` on and before ``hi``."""
    file = pa.ipc.open_file(pa.BufferReader(run))
    for i, (first, last) in enumerate(spans):
        if (lo is None or last >= lo) and (hi is None or first < hi):
            batch = file.get_batch(i)
            ts = batch.column(0).to_numpy()
            a = 0 if lo is None else int(np.searchsorted(ts, lo))
            b = len(ts) if hi is None else int(np.searchsorted(ts, hi))
            if b > a:
                yield batch.slice(a, b - a)


def _behind(run: bytes, passed: int) -> bytes | None:
    """What a run holds after the time ``passed``; None if nothing."""
    spans = _spans(run)
    if spans[0][0] > passed:
        return run
    rest = list(_between(run, spans, passed + 1, None))
    return _packed(pa.Table.from_batches(rest, ROW)) if rest else None


def in_order(runs: list[bytes], passed: int | None = None) -> Iterator[tuple]:
    """The runs' readings up to the time ``passed`` in (ts, reading_id) order:
    stretches of about ``PART_ROWS``, cut at batches' first times, as arrays
    (ts, reading id, feeder, voltage, current).  Only a stretch is unpacked at
    a time; readings of one time stay together."""
    spans = [_spans(run) for run in runs]
    starts = sorted(first for own in spans for first, _ in own)
    end = None if passed is None else passed + 1
    cuts = sorted({x for x in starts[::max(1, PART_ROWS // BATCH_ROWS)][1:] if end is None or x < end})
    for lo, hi in zip([None, *cuts], [*cuts, end]):
        some = [b for run, own in zip(runs, spans) for b in _between(run, own, lo, hi)]
        if some:
            part = pa.Table.from_batches(some, ROW).sort_by(ORDER).combine_chunks()
            yield tuple(part.column(x).to_pandas().to_numpy() for x in ROW.names)


class FrozenBaselineProcessor(StatefulProcessor):
    def __init__(self, params: dict, late_policy: str = "skip"):
        self.params, self.late_policy = params, late_policy

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("device", STATE_SCHEMA)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        device = key[0]
        m = FrozenBaseline(**self.params)
        last, walked = None, False
        if self.state.exists():
            st = self.state.get()
            m.set_state((list(st[0] or []), list(st[1] or []), st[2], st[3], st[4]))
            last = (st[5], st[6])
        n_late = 0
        for ts, rid, feeder, v, c in in_order(list(packed_runs(rows))):
            if last is not None:
                # in order: rows at or before the last position come first
                late = (ts < last[0]) | ((ts == last[0]) & (rid <= last[1])) if ts[0] <= last[0] else np.zeros(len(ts), bool)
                if not walked and late.any():
                    n_late += int(late.sum())
                    if self.late_policy == "raise":
                        raise ValueError(f"{n_late} late reading(s) for device {device}")
                    ts, rid, feeder, v, c = (x[~late] for x in (ts, rid, feeder, v, c))
            if not len(ts):
                continue
            e = m.run(ts, v, c, feeder)
            last, walked = (int(ts[-1]), rid[-1]), True
            if len(e):  # an empty frame does not convert under every pyarrow
                yield emitted(e, device, rid, ts).astype({"ts_us": "int64", "start_us": "int64", "peak_z": "float64"})
        if last is not None:
            bv, bc, start, peak, feeder = m.get_state()
            self.state.update((bv, bc, start, float(peak), feeder, last[0], last[1]))
        if n_late:  # one row that only counts them; the caller splits it off
            yield pd.DataFrame({"device_id": [device], "feeder_id": [None], "reading_id": [None], "ts_us": [n_late],
                                "start_us": [None], "fault_type": [LATE], "peak_z": [None]}).astype(
                {"start_us": "Int64", "peak_z": "float64"})

    def close(self) -> None:
        pass


WAITING_SCHEMA = StructType([StructField("run", BinaryType())])


class WaitingProcessor(StatefulProcessor):
    """Readings wait until the watermark has passed them.

    The list state holds a device's waiting readings as packed runs, each in
    order.  One timer stands at the earliest of them; when it fires, all that
    the watermark has passed are walked in (ts, reading_id) order and the rest
    goes back.  No reading at or before the watermark can come any more, so
    the walk never meets one that belongs before its position."""

    def __init__(self, params: dict, idle_ms: int | None = None):
        self.params, self.idle_ms = params, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("device", STATE_SCHEMA)
        self.waiting = handle.getListState("waiting", WAITING_SCHEMA)

    def _wake(self, ts_us: int) -> None:
        """A timer for the moment the watermark passes this reading."""
        self.handle.registerTimer(-(-int(ts_us) // 1000))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for run in packed_runs(rows):
            self.waiting.appendValue((run,))
            low = _spans(run)[0][0]
            first = low if first is None else min(first, low)
        if first is not None:
            self._wake(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        st = self.state.get() if self.state.exists() else None
        runs = [e[0] for e in self.waiting.get()] if self.waiting.exists() else []
        if not runs:
            if st is not None and self.idle_ms is not None and st[5] + self.idle_ms * 1000 <= passed:
                self.state.clear()
            return
        m = FrozenBaseline(**self.params)
        if st is not None:
            m.set_state((list(st[0] or []), list(st[1] or []), st[2], st[3], st[4]))
        last = None
        for ts, rid, feeder, v, c in in_order(runs, passed):
            e = m.run(ts, v, c, feeder)
            last = (int(ts[-1]), rid[-1])
            if len(e):
                yield emitted(e, key[0], rid, ts).astype({"ts_us": "int64", "start_us": "int64", "peak_z": "float64"})
        rest = [run for run in (_behind(run, passed) for run in runs) if run is not None]
        if rest:
            self.waiting.put([(run,) for run in rest])
            self._wake(min(_spans(run)[0][0] for run in rest))
        else:
            self.waiting.clear()
        if last is None:
            return
        bv, bc, start, peak, feeder = m.get_state()
        self.state.update((bv, bc, start, float(peak), feeder, *last))
        if self.idle_ms is not None:
            self._wake(last[0] + self.idle_ms * 1000)

    def close(self) -> None:
        pass


def detect_frozen_stream(readings: DataFrame, z: float = S.DEFAULT_Z_THRESHOLD,
                         current_z: float | None = None,
                         sustained_s: float = S.DEFAULT_SUSTAINED_THRESHOLD_S,
                         window: int = S.DEFAULT_WINDOW_SIZE, min_n: int = S.DEFAULT_MIN_BASELINE_READINGS,
                         full_scale: float = S.CONFIDENCE_Z_FULL_SCALE, source: str | None = S.SYNTHETIC,
                         digits: int = 3, late_policy: str = "skip", delay: str | None = None,
                         idle: str | None = None) -> DataFrame:
    """Streaming emissions (D2's columns) from a stream of silver readings.

    ``delay`` and ``idle`` are intervals of event time (``"10 minutes"``).
    Without ``delay`` readings are walked as they come, per micro-batch; with
    it they wait for the watermark and come out in order.  ``idle`` (with
    ``delay`` only) forgets devices, an event left open included: their next
    readings begin a new baseline."""
    spark = readings.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        raise ValueError(f"this detector's state needs spark.sql.streaming.stateStore.providerClass={ROCKSDB}")
    params = dict(window=window, min_n=min_n, vth=float(z),
                  cth=float(z if current_z is None else current_z), sustained_s=float(sustained_s))
    if delay is not None:
        timed = readings.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
        idle_ms = None if idle is None else int(_seconds(spark, idle) * 1000)
        emits = (_prepared(timed, source, ["ts"]).groupBy("device_id")
                 .transformWithStateInPandas(WaitingProcessor(params, idle_ms), EMIT_SCHEMA, "Append", "EventTime"))
        return _finish(emits, full_scale, digits)
    if idle is not None:
        raise ValueError("idle devices are forgotten by event time: give a delay too")
    emits = (_prepared(readings, source).groupBy("device_id")
             .transformWithStateInPandas(FrozenBaselineProcessor(params, late_policy),
                                         EMIT_SCHEMA, "Append", "None"))
    late = F.col("fault_type").eqNullSafe(LATE)
    emits = emits.observe("late_readings", F.coalesce(F.sum(F.when(late, F.col("ts_us"))), F.lit(0)).alias("n"))
    return _finish(emits.filter(~late), full_scale, digits)
