"""Property tests: the hot-key plans equal the plain ones on random data."""
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridspark import schemas as S
from gridspark.operators import detect
from gridspark.operators.windows import positions

T0 = datetime(2024, 1, 1)


@st.composite
def readings(draw):
    n_dev = draw(st.integers(1, 3))
    rows = []
    for d in range(n_dev):
        n = draw(st.integers(0, 120))
        t = 0
        for k in range(n):
            t += draw(st.sampled_from([0, 1, 1, 1, 60, 3600]))   # ties and gaps across buckets
            spike = draw(st.sampled_from([1.0] * 12 + [0.3, 3.0]))
            rows.append((f"r{d}_{k:04d}", f"d{d}", "f0", T0 + timedelta(seconds=t),
                         100.0 * spike + draw(st.floats(-1, 1)), 10.0 + draw(st.floats(-0.5, 0.5)),
                         60.0, S.SYNTHETIC))
    return rows


SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(rows=readings(), bucket=st.sampled_from([30, 600, 3600]))
def test_positions_equal_row_number(spark, rows, bucket):
    df = spark.createDataFrame(rows, S.READINGS)
    p = positions(df, bucket_seconds=bucket).select("reading_id", "pos")
    w = Window.partitionBy("device_id").orderBy("ts", "reading_id")
    ref = df.select("reading_id", (F.row_number().over(w) - 1).cast("long").alias("pos"))
    assert p.exceptAll(ref).count() == 0 and ref.exceptAll(p).count() == 0


@SETTINGS
@given(rows=readings(), seg=st.integers(11, 80), bucket=st.sampled_from([30, 3600]))
def test_segmented_windowed_detector_equals_per_device(spark, rows, seg, bucket):
    df = spark.createDataFrame(rows, S.READINGS)
    kw = dict(z=2.5, sustained_s=30.0, window=10, min_n=3)
    a = detect.detect_windowed(df, strategy="device", **kw)
    b = detect.detect_windowed(df, strategy="segmented", segment_rows=seg, bucket_seconds=bucket, **kw)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=readings(), seg=st.integers(12, 70), warm=st.integers(1, 11))
def test_segmented_frozen_walk_equals_sequential(spark, rows, seg, warm):
    from gridspark.operators import detect_state
    df = spark.createDataFrame(rows, S.READINGS)
    kw = dict(z=2.5, sustained_s=30.0, window=10, min_n=3)
    a = detect_state.detect_frozen(df, segment_rows=None, **kw)
    b = detect_state.detect_frozen(df, segment_rows=seg, warmup=warm, **kw)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@st.composite
def schedules(draw):
    faults = []
    for i in range(draw(st.integers(0, 12))):
        faults.append((f"f{i:02d}", f"d{draw(st.integers(0, 1))}", "f0",
                       draw(st.sampled_from(["transient", "sustained"])),
                       draw(st.integers(0, 400)), float(draw(st.integers(1, 200)))))
    return faults


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=readings(), faults=schedules(), bucket=st.sampled_from([20, 300, 3600]))
def test_overlay_equals_brute_force(spark, rows, faults, bucket):
    import pandas as pd
    from gridspark.operators import overlay
    df = spark.createDataFrame(rows, S.READINGS)
    sched = spark.createDataFrame(pd.DataFrame(
        [(fid, dev, fdr, kind, T0 + timedelta(seconds=st_), dur, 0.5, 3.0, 0.1)
         for fid, dev, fdr, kind, st_, dur in faults], columns=S.FAULT_SCHEDULE.names), S.FAULT_SCHEDULE)
    got = {r.reading_id: r._fault_id for r in overlay.overlay_faults(df, sched, bucket_seconds=bucket).collect()}
    assert len(got) == len(rows)
    for rid, dev, _, ts, *_ in rows:
        t = (ts - T0).total_seconds()
        cands = [f for f in faults if f[1] == dev and f[4] <= t]
        want = None
        if cands:
            f = max(cands, key=lambda f: (f[4], f[0]))   # newest start; ties -> larger id
            want = f[0] if t < f[4] + f[5] else None
        assert got[rid] == want


@st.composite
def meter_rows(draw):
    rows = []
    for _ in range(draw(st.integers(0, 60))):
        day = draw(st.sampled_from(["2012-01-31", "2012-02-29", "2012-03-15", "2012-04-30", "2012-05-31",
                                    "2012-08-31", "2012-11-30", "2013-01-31", "2013-02-28", "bad"]))
        rows.append((f"H{draw(st.integers(0, 15)):02d}", "Std",
                     day if day == "bad" else f"{day} {draw(st.sampled_from(['00:00:00', '12:30:00']))}",
                     "0.1", draw(st.integers(0, 6))))
    return rows


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=meter_rows(), n=st.integers(1, 12), months=st.integers(1, 13), mb=st.integers(1, 7))
def test_cohort_equals_brute_force(spark, rows, n, months, mb):
    import pandas as pd
    from gridspark.operators import cohort
    from test_cohort import _brute
    cols = ["LCLid", "stdorToU", "DateTime", "kwh_per_half_hour", "block"]
    pdf = pd.DataFrame(rows, columns=cols)
    df = spark.createDataFrame(pdf if len(pdf) else [], "LCLid string, stdorToU string, DateTime string, "
                                                       "kwh_per_half_hour string, block long")
    got = sorted(tuple(r) for r in cohort.cohort_sample(df, n, months, mb).select(*cols).collect())
    want = sorted(tuple(x) for x in _brute(pdf, n, months, mb).itertuples(index=False)) if len(pdf) else []
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=st.dictionaries(st.integers(0, 30), st.integers(0, 9), max_size=20),
       updates=st.dictionaries(st.integers(0, 30), st.integers(10, 19), max_size=20))
def test_upsert_equals_dict_merge(spark, target, updates):
    from gridspark.sources import tables
    schema = "event_id string, v int"
    t = spark.createDataFrame([(str(k), v) for k, v in target.items()], schema)
    u = spark.createDataFrame([(str(k), v) for k, v in updates.items()], schema)
    got = {r.event_id: r.v for r in tables.upsert(t, u, ["event_id"]).collect()}
    assert got == {str(k): v for k, v in {**target, **updates}.items()}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 50), st.integers(0, 99)), max_size=40))
def test_latest_per_equals_pandas(spark, rows):
    import pandas as pd
    from gridspark.operators.windows import latest_per
    dedup = {(k, t): v for k, t, v in rows}           # (key, time) unique, as window_end per feeder
    data = [(k, t, v) for (k, t), v in dedup.items()]
    df = spark.createDataFrame(data, "k string, t int, v int")
    got = sorted(tuple(r) for r in latest_per(df, "k", "t").select("k", "t", "v").collect())
    pdf = pd.DataFrame(data, columns=["k", "t", "v"])
    want = sorted(tuple(x) for x in pdf.loc[pdf.groupby("k")["t"].idxmax()].itertuples(index=False)) \
        if len(pdf) else []
    assert got == want
