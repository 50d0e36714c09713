"""Segmented walk of the frozen-baseline detector: a hot device over many tasks.

A device with more than ``segment_rows`` readings is cut into time ranges of
about as many (``windows.time_segments``), the segments; each also receives
the ``warmup`` readings before it.  Round 0 walks all segments in parallel:
a segment starts from an empty state, walks its warm-up readings without
emitting, records that state as its *guessed* start, walks its own
readings and records its end state.  Segment 0 has no warm-up, so its start
is exact.  A segment is right when its start state equals the end state of
the segment before it (states are the baseline values, the open event's
start, peak and feeder, so equality is exact).  Every segment whose start
disagrees is walked again from its predecessor's end state, in rounds,
until no segment disagrees; where that state holds an open event, one scan
finds the segment in which it closes and all segments up to there are walked
in the same round.  Round k also walks on over the 2**(k - 1) - 1 segments
behind each device's first wrong one, with the state carried from one to the
next, so the rounds are at most log2(segments) + 1 behind round 0, whatever
the guesses were.  In practice a warm-up of a few hundred readings makes round 0
right almost everywhere else.

Each round's output is written under ``spark.checkpoint.dir`` (lineage
cut; a lost executor recomputes one round, not the walk); the readings with
their segments are written only if a fix-up round is needed.  Only the small
per-segment state table decides the rounds; no reading passes through the
driver.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, LongType, StringType, StructField, StructType,
)

from ..session import checkpoint_dir
from .windows import time_segments

_ARR = ArrayType(DoubleType())
STATE_FIELDS = [("bv", _ARR), ("bc", _ARR), ("start", LongType()), ("peak", DoubleType()),
                ("feeder", StringType())]
STATE = StructType([StructField(n, t) for n, t in STATE_FIELDS])

OUT_SCHEMA = StructType([
    StructField("device_id", StringType()),
    StructField("seg", LongType()),
    StructField("is_state", BooleanType()),
    # emission columns
    StructField("feeder_id", StringType()),
    StructField("reading_id", StringType()),
    StructField("ts_us", LongType()),
    StructField("start_us", LongType()),
    StructField("fault_type", StringType()),
    StructField("peak_z", DoubleType()),
    # state columns: start state used (g_*) and end state (e_*)
    *[StructField(f"g_{n}", t) for n, t in STATE_FIELDS],
    *[StructField(f"e_{n}", t) for n, t in STATE_FIELDS],
])

_INT_COLS = {"seg", "ts_us", "start_us", "g_start", "e_start"}


def _clean(v):
    """pandas -> plain Python (NaN-as-NULL for nullable numerics)."""
    if v is None:
        return None
    if isinstance(v, float) and v != v:
        return None
    return v


def _walk_groups(params: dict):
    from .detect_state import FrozenBaseline, emitted

    names = [f.name for f in OUT_SCHEMA.fields]

    def frame(parts: list[pd.DataFrame]) -> pd.DataFrame:
        out = pd.concat([p.reindex(columns=names).astype(object) for p in parts], ignore_index=True)
        out = out.where(out.notna(), None)
        return out.assign(**{c: pd.array(out[c], dtype="Int64") for c in _INT_COLS},
                          is_state=out["is_state"].astype(bool), peak_z=out["peak_z"].astype(float))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, walk, m, guess = None, None, None, None

        def summary() -> pd.DataFrame:
            state = {f"g_{n}": [x] for (n, _), x in zip(STATE_FIELDS, guess)}
            state |= {f"e_{n}": [x] for (n, _), x in zip(STATE_FIELDS, m.get_state())}
            return pd.DataFrame({"device_id": [key[0]], "seg": [key[1]], "is_state": [True], **state})

        for pdf in batches:
            if not len(pdf):
                continue
            d, f, rid, sg, halo = (pdf[x].to_numpy() for x in ("device_id", "feeder_id", "reading_id", "seg", "is_halo"))
            t, v, c = (pdf[x].to_numpy(dtype=k) for x, k in (("ts_us", np.int64), ("voltage", np.float64), ("current", np.float64)))
            wk = pdf["walk"].to_numpy()
            # stretches of equal (device, seg, is_halo); warm-up rows stand before own rows
            brk = np.flatnonzero((d[1:] != d[:-1]) | (sg[1:] != sg[:-1]) | (halo[1:] != halo[:-1])) + 1
            found = []
            for a, b in zip(np.r_[0, brk], np.r_[brk, len(pdf)]):
                if m is None or key != (d[a], int(sg[a])):
                    if guess is not None:
                        found.append(summary())
                    if m is not None and walk == (d[a], wk[a]):  # the same walk goes on into its next segment
                        key, guess = (d[a], int(sg[a])), None
                    else:
                        key, walk, m, guess = (d[a], int(sg[a])), (d[a], wk[a]), FrozenBaseline(**params), None
                        if pdf["s_known"].iat[a]:
                            m.set_state((pdf["s_bv"].iat[a], pdf["s_bc"].iat[a], *(
                                _clean(pdf[x].iat[a]) for x in ("s_start", "s_peak", "s_feeder"))))
                            if m.start_us is not None:
                                m.start_us = int(m.start_us)
                if not halo[a] and guess is None:
                    guess = m.get_state()
                e = m.run(t[a:b], v[a:b], c[a:b], f[a:b])
                if len(e) and not halo[a]:  # the warm-up emits nothing
                    found.append(emitted(e, key[0], rid[a:b], t[a:b]).assign(seg=key[1], is_state=False))
            if found:
                yield frame(found)
        if guess is not None:
            yield frame([summary()])
    return run


def _walk(rows: DataFrame, params: dict, path: str) -> DataFrame:
    """One round: walk every (device, seg) group of ``rows``; write and
    re-read the output (emissions and one state row per segment)."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # by count: keep the Python walk parallel; a range's warm-up readings sort before its own
    ordered = (rows.repartition(n, "device_id", "walk").sortWithinPartitions("device_id", "walk", "seg", "ts_us", "reading_id"))
    ordered.mapInPandas(_walk_groups(params), OUT_SCHEMA).write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.parquet(path)


def _no_state(df: DataFrame) -> DataFrame:
    df = df.withColumn("s_known", F.lit(False))
    for n, t in STATE_FIELDS:
        df = df.withColumn(f"s_{n}", F.lit(None).cast(t))
    return df


_SCAN_SCHEMA = StructType([StructField("device_id", StringType()), StructField("seg", LongType()),
                           StructField("closes", BooleanType()), StructField("top", DoubleType())])


def _scan_groups(params: dict):
    """Per (device, seg): whether a reading there is normal under the state
    given with its rows, and the largest score before the first such one."""
    from .detect_state import FrozenBaseline

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for (d, s), g in pdf.groupby(["device_id", "seg"], sort=False, dropna=False):
                m = FrozenBaseline(**params)
                m.set_state((g["s_bv"].iat[0], g["s_bc"].iat[0], int(g["s_start"].iat[0]), None, None))
                m.run(g["ts_us"].to_numpy(np.int64), g["voltage"].to_numpy(float), g["current"].to_numpy(float),
                      g["feeder_id"].to_numpy(), until_closed=True)
                out.append((d, s, m.start_us is None, m.top))
            if out:
                yield pd.DataFrame(out, columns=["device_id", "seg", "closes", "top"])
    return run


def _carry_open_events(own: DataFrame, bad: DataFrame, params: dict, path: str) -> DataFrame:
    """``bad`` with the true start states of all segments that an open event covers.

    While an event is open the baseline stands still, so whether a reading
    closes it does not depend on the readings before: one scan of the segments
    behind each device's first wrong one finds the segment in which the event
    closes, and the highest score up to any segment.  All segments up to that
    one are then walked in the same round, however many they are."""
    first = bad.groupBy("device_id").agg(F.min_by(F.struct("seg", *[f"s_{n}" for n, _ in STATE_FIELDS]), "seg").alias("_f"))
    opened = first.filter(F.col("_f.s_start").isNotNull()).select(F.col("device_id").alias("_d"), "_f")
    states = [F.col(f"_f.s_{n}").alias(f"s_{n}") for n, _ in STATE_FIELDS]
    rows = own.join(opened, own["device_id"].eqNullSafe(F.col("_d")) & (F.col("seg") >= F.col("_f.seg")))
    n = int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    scanned = (rows.select("device_id", "seg", "reading_id", "ts_us", "voltage", "current", "feeder_id", *states)
               .repartition(n, "device_id", "seg").sortWithinPartitions("device_id", "seg", "ts_us", "reading_id")
               .mapInPandas(_scan_groups(params), _SCAN_SCHEMA))
    # a segment may arrive in several Arrow batches: what stands behind its close only adds to scores nobody reads
    per_seg = scanned.groupBy("device_id", "seg").agg(F.max("closes").alias("closes"), F.max("top").alias("top"))
    before = Window.partitionBy("device_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    per_seg = (per_seg.withColumn("_over", F.max("closes").over(before)).withColumn("_top", F.max("top").over(before))
               .filter(F.col("_top").isNotNull() & ~F.col("_over")))  # behind the first, up to the one that closes
    peak = F.greatest(F.col("_f.s_peak"), F.col("_top"))
    covered = (per_seg.join(opened, per_seg["device_id"].eqNullSafe(F.col("_d")))
               .select("device_id", "seg", F.lit(True).alias("s_known"), *[peak.alias("s_peak") if n == "peak" else F.col(f"_f.s_{n}").alias(f"s_{n}")
                                                                      for n, _ in STATE_FIELDS]))
    covered.write.parquet(path)
    covered = own.sparkSession.read.parquet(path)
    mine = covered.select(F.col("device_id").alias("_d"), F.col("seg").alias("_s"))
    rest = bad.join(mine, bad["device_id"].eqNullSafe(F.col("_d")) & (bad["seg"] == F.col("_s")), "left_anti")
    return rest.unionByName(covered)


def _doubled(states: DataFrame, bad: DataFrame, k: int, path: str) -> DataFrame:
    """The segments that round ``k`` walks: those of ``bad``, each as a walk of
    its own, and the 2**(k - 1) - 1 segments behind the last one that is known
    to start right in an unbroken row from each device's first.

    The longer walk carries its state over the segments' borders, so whatever
    the guesses were, 2**(k - 1) more segments of a device are right after
    round k: the rounds are bounded by the logarithm of its segments."""
    first = bad.groupBy("device_id").agg(F.min("seg").alias("_first"))
    near = bad.join(first.withColumnRenamed("device_id", "_d"), bad["device_id"].eqNullSafe(F.col("_d"))).drop("_d")
    # an open event's segments come in an unbroken row; the walk goes on from the last of them
    w = Window.partitionBy("device_id").orderBy("seg")
    row = near.withColumn("_nth", F.row_number().over(w)).filter(F.col("seg") - F.col("_first") == F.col("_nth") - 1)
    head = row.groupBy("device_id").agg(F.max("seg").alias("_head")).withColumnRenamed("device_id", "_d")
    empty = [F.lit(None).cast(t).alias(f"s_{n}") for n, t in STATE_FIELDS]
    behind = (states.select("device_id", "seg").join(head, F.col("device_id").eqNullSafe(F.col("_d")))
              .filter((F.col("seg") > F.col("_head")) & (F.col("seg") < F.col("_head") + F.lit(1 << (k - 1))))
              .select("device_id", "seg", F.lit(True).alias("s_known"), *empty, F.col("_head").alias("walk")))
    covered = behind.select(F.col("device_id").alias("_d"), F.col("seg").alias("_s"))
    alone = bad.join(covered, bad["device_id"].eqNullSafe(F.col("_d")) & (bad["seg"] == F.col("_s")), "left_anti")
    alone.withColumn("walk", F.col("seg")).unionByName(behind).write.parquet(path)
    return states.sparkSession.read.parquet(path)


def walk_segmented(r: DataFrame, params: dict, segment_rows: int, warmup: int,
                   bucket_seconds: int = 60) -> DataFrame:
    """Emissions (EMIT_SCHEMA of ``detect_state``) of the exact detector.

    Jobs: round 0 (segments, walk; written), one check over the per-segment
    state table.  Only when some segment disagrees are the readings with their
    segments written (once) and the fix-up rounds run."""
    spark = r.sparkSession
    base = f"{checkpoint_dir(spark).rstrip('/')}/gridspark-frozen/{uuid.uuid4().hex}"
    ranged = time_segments(r.withColumn("_ts", F.timestamp_micros("ts_us")), halo=warmup, size=segment_rows,
                           order=("_ts", "reading_id"), time_col="_ts", bucket_seconds=bucket_seconds).drop("_ts")
    out0 = _walk(_no_state(ranged.withColumn("walk", F.col("seg"))), params, f"{base}/round=0")
    gcols = [f"g_{n}" for n, _ in STATE_FIELDS]
    ecols = [f"e_{n}" for n, _ in STATE_FIELDS]
    emits = [out0.filter(~F.col("is_state")).withColumn("rnd", F.lit(0))]
    states = out0.filter(F.col("is_state")).select("device_id", "seg", F.lit(0).alias("rnd"), *gcols, *ecols)
    own = None

    for k in count(1):  # round k settles 2**(k - 1) segments of each wrong device at least
        prev = Window.partitionBy("device_id").orderBy("seg")
        g = F.struct(*[F.col(c) for c in gcols])
        checked = states.withColumn(
            "_prev", F.lag(F.struct(*[F.col(f"e_{n}").alias(n) for n, _ in STATE_FIELDS])).over(prev))
        end = F.struct(*[F.col(f"_prev.{n}").alias(f"g_{n}") for n, _ in STATE_FIELDS])
        checked = checked.withColumn("_bad", (F.col("seg") > 0) & ~g.eqNullSafe(end))
        # a segment behind a wrong one waits: what it would start from is about to change
        bad = (checked.withColumn("_waits", F.lag("_bad").over(prev)).filter(F.col("_bad") & ~F.col("_waits"))
               .select("device_id", "seg", F.lit(True).alias("s_known"),
                       *[F.col(f"_prev.{n}").alias(f"s_{n}") for n, _ in STATE_FIELDS]))
        if bad.isEmpty():
            break
        bad.write.mode("overwrite").parquet(f"{base}/bad={k}")
        bad = spark.read.parquet(f"{base}/bad={k}")
        if own is None:  # first fix-up: keep the readings with their ranges once
            ranged.filter(~F.col("is_halo")).write.mode("overwrite").parquet(f"{base}/rows")
            own = spark.read.parquet(f"{base}/rows")
        bad = _carry_open_events(own, bad, params, f"{base}/covered={k}")
        walks = _doubled(states, bad, k, f"{base}/walks={k}")
        wrong = walks.withColumnsRenamed({"device_id": "_d", "seg": "_s"})
        rows_k = own.join(wrong, own["device_id"].eqNullSafe(wrong["_d"]) & (own["seg"] == wrong["_s"])).drop("_d", "_s")
        out_k = _walk(rows_k, params, f"{base}/round={k}")
        emits.append(out_k.filter(~F.col("is_state")).withColumn("rnd", F.lit(k)))
        new_states = out_k.filter(F.col("is_state")).select("device_id", "seg", F.lit(k).alias("rnd"),
                                                          *gcols, *ecols)
        again = states["device_id"].eqNullSafe(wrong["_d"]) & (states["seg"] == wrong["_s"])
        merged = states.join(wrong.select("_d", "_s"), again, "left_anti").unionByName(new_states)
        merged.write.mode("overwrite").parquet(f"{base}/states={k}")
        states = spark.read.parquet(f"{base}/states={k}")

    final = states.select("device_id", "seg", "rnd")
    allem = emits[0]
    for e in emits[1:]:
        allem = allem.unionByName(e)
    last = allem["device_id"].eqNullSafe(final["device_id"]) & (allem["seg"] == final["seg"]) & (allem["rnd"] == final["rnd"])
    return (allem.join(final, last, "left_semi")
                 .select("device_id", "feeder_id", "reading_id", "ts_us", "start_us", "fault_type", "peak_z"))
