"""Frozen-baseline detector: the reference's three scenarios, plus plan
independence (partitions, Arrow batch size, segmentation)."""
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from fixtures import schedule, telemetry
from gridspark import schemas as S
from gridspark.operators import detect, detect_state, overlay

T0 = 100000.0


def _scenario(spark, n_dev, n_fdr, warm, fault, after, seed):
    """warm-up seconds, then a fault (device, type, duration) and ``after`` more seconds."""
    r = telemetry(spark, n_dev, n_fdr, warm + after, T0, seed)
    if fault is None:
        return r
    dev, kind, dur = fault
    fdr = f"feeder_{int(dev[-4:]) % n_fdr:03d}"
    sch = schedule(spark, [("f1", dev, fdr, kind, T0 + warm, dur)])
    return overlay.overlay_faults(r, sch).drop("event_flag", "_fault_id", "_fault_type_truth")


def _emits(df, device):
    return [r.asDict() for r in df.filter(F.col("device_id") == device)
            .orderBy("timestamp", "reading_id").collect()]


def test_transient_fault_detected_and_classified(spark):
    r = _scenario(spark, 10, 2, 15, ("dev_0003", S.TRANSIENT, 1.5), 5, seed=10)
    ev = _emits(detect_state.detect_frozen(r, sustained_s=5.0), "dev_0003")
    assert len(ev) >= 2
    assert ev[0]["fault_type"] is None
    assert ev[-1]["fault_type"] == S.TRANSIENT
    assert ev[-1]["event_id"] == ev[0]["event_id"]
    assert 0.0 < ev[-1]["confidence_score"] <= 1.0


def test_sustained_fault_upgraded_while_active(spark):
    r = _scenario(spark, 10, 2, 15, ("dev_0007", S.SUSTAINED, 10.0), 7, seed=11)
    ev = _emits(detect_state.detect_frozen(r, sustained_s=5.0), "dev_0007")
    assert any(e["fault_type"] == S.SUSTAINED for e in ev)
    # still open: no transient verdict, one event id
    assert all(e["fault_type"] != S.TRANSIENT for e in ev)
    assert len({e["event_id"] for e in ev}) == 1


def test_no_false_positives_during_normal_operation(spark):
    r = _scenario(spark, 20, 4, 60, None, 0, seed=12)
    assert detect_state.detect_frozen(r).count() == 0


def test_windowed_detector_misses_sustained(spark):
    """The rolling baseline absorbs the fault's own readings (a long fault
    stops scoring), so the windowed detector does not call it sustained."""
    r = _scenario(spark, 10, 2, 40, ("dev_0007", S.SUSTAINED, 12.0), 20, seed=11)
    ev = detect.detect_windowed(r, strategy="device").filter(F.col("device_id") == "dev_0007").collect()
    assert all(e["fault_type"] != S.SUSTAINED for e in ev)
    fr = detect_state.event_status(detect_state.detect_frozen(r)).filter(F.col("device_id") == "dev_0007")
    assert [e["fault_type"] for e in fr.collect()] == [S.SUSTAINED]


def test_boundary_exactly_sustained_threshold(spark):
    """Anomalous at t..t+4, normal at t+5: closes at duration 5.0 -> sustained
    (the walk measures to the first normal reading)."""
    r = _scenario(spark, 4, 1, 20, ("dev_0001", S.SUSTAINED, 5.0), 8, seed=3)
    st = detect_state.event_status(detect_state.detect_frozen(r, sustained_s=5.0))
    types = [e["fault_type"] for e in st.filter(F.col("device_id") == "dev_0001").collect()]
    assert types == [S.SUSTAINED]


def test_plan_independence(spark):
    r = _scenario(spark, 6, 2, 40, ("dev_0002", S.SUSTAINED, 8.0), 30, seed=5)
    base = detect_state.detect_frozen(r, num_partitions=1)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        small = detect_state.detect_frozen(r, num_partitions=5)
        assert base.exceptAll(small).count() == 0 and small.exceptAll(base).count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    for seg, warm in ((25, 5), (40, 1), (60, 30)):
        s = detect_state.detect_frozen(r, segment_rows=seg, warmup=warm)
        assert base.exceptAll(s).count() == 0 and s.exceptAll(base).count() == 0


def test_ties_on_ts_are_ordered_by_reading_id(spark):
    r = telemetry(spark, 2, 1, 40, T0, 7)
    dup = r.withColumn("reading_id", F.concat(F.col("reading_id"), F.lit("_b")))
    both = r.unionByName(dup)
    a = detect_state.detect_frozen(both, num_partitions=1)
    b = detect_state.detect_frozen(both.repartition(7), num_partitions=3)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_empty_input(spark):
    r = spark.createDataFrame([], S.READINGS)
    assert detect_state.detect_frozen(r).count() == 0
    assert detect.detect_windowed(r, strategy="device").count() == 0
    assert detect.detect_windowed(r, strategy="segmented").count() == 0


def test_a_long_event_takes_few_rounds(spark):
    """A fault over 50 segments, and a level shift that never closes."""
    import glob

    from gridspark.session import checkpoint_dir
    rng = np.random.default_rng(3)
    frames = []
    for d, (a, b) in {"long": (120, 2220), "shift": (300, 2600), "calm": (0, 0)}.items():
        v, c = 100 + rng.normal(0, 1, 2600), 10 + rng.normal(0, 0.1, 2600)
        v[a:b] += 500
        frames.append(pd.DataFrame({"reading_id": [f"{d}{i:05d}" for i in range(2600)], "device_id": d, "feeder_id": "f",
                                    "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(2600), unit="s"),
                                    "voltage": v, "current": c, "frequency": 50.0, "source": "synthetic"}))
    r = spark.createDataFrame(pd.concat(frames)[S.READINGS.names], S.READINGS)
    kept = set(glob.glob(f"{checkpoint_dir(spark)}/gridspark-frozen/*"))
    got = detect_state.detect_frozen(r, segment_rows=40, warmup=36)
    want = detect_state.detect_frozen(r, segment_rows=None)
    assert got.count() == want.count() > 4000 and got.exceptAll(want).count() == 0
    (base,) = set(glob.glob(f"{checkpoint_dir(spark)}/gridspark-frozen/*")) - kept
    assert len(glob.glob(f"{base}/round=*")) <= 1 + 3  # round 0 and at most three rounds of mending
