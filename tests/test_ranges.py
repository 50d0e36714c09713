"""Time ranges of hot devices, bounded mending, the overlay's single scan, sketches, lines, pairs, stream reports."""
import glob
import math
import os
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridspark import schemas as S
from gridspark.operators import detect, detect_state, health, overlay, quality, windows
from gridspark.session import checkpoint_dir
from gridspark.sources import files, landing, tables

T0 = datetime(2024, 1, 1)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 400))), max_size=150),
       halo=st.integers(1, 8), size=st.integers(9, 40), bucket=st.sampled_from([1, 10, 1000]))
def test_time_segments_against_brute_force(spark, rows, halo, size, bucket):
    data = [(i, d, None if t is None else T0 + timedelta(seconds=t)) for i, (d, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "reading_id int, device_id string, ts timestamp")
    got = windows.time_segments(df, halo, size, bucket_seconds=bucket).collect()
    for device in ("a", "b", None):
        order = [r[0] for r in sorted((x for x in data if x[1] == device), key=lambda x: (x[2] is not None, x[2] or T0, x[0]))]
        own = {r.reading_id: r.seg for r in got if r.device_id == device and not r.is_halo}
        assert sorted(own) == sorted(order)
        segs = [own[i] for i in order]
        assert segs == sorted(segs) and sorted(set(segs)) == list(range(len(set(segs))))  # ranges follow one another
        for s in set(segs):
            before = [i for i in order if own[i] < s]
            assert sorted(r.reading_id for r in got if r.device_id == device and r.is_halo and r.seg == s) == sorted(before[-halo:])
            assert s == max(segs) or segs.count(s) >= halo
            if bucket == 1 and len(set(data)) == len({(x[1], x[2]) for x in data}):  # one row a bucket
                assert segs.count(s) <= max(size, 2 * halo) + halo
    if all(sum(r[1] == d for r in data) <= size for d in ("a", "b", None)):
        assert all(r.seg == 0 for r in got)


def test_rows_do_not_widen_with_the_number_of_ranges(spark):
    r = spark.createDataFrame([(i, "a", T0 + timedelta(seconds=i)) for i in range(300)], "reading_id int, device_id string, ts timestamp")
    cut = windows.time_segments(r, halo=3, size=10, bucket_seconds=1)
    assert cut.select("seg").distinct().count() == 30
    plan = cut._jdf.queryExecution().optimizedPlan()
    wide = [plan.apply(i) for i in range(plan.toString().count("\n"))]
    types = [a for p in wide for a in p.schema().catalogString().split(",")]
    assert types and not any("array<" in a for a in types)


def test_islands_of_segments_equal_those_of_devices(spark):
    rng = np.random.default_rng(2)
    rows = [(f"r{i:04d}", d, "f", T0 + timedelta(seconds=int(i)), 100.0 + float(rng.normal()) + (60 if i % 50 > 35 or rng.random() < .05 else 0), 10.0 + float(rng.normal()))
            for d in ("a", "b", None) for i in range(300)]
    r = spark.createDataFrame(rows, "reading_id string, device_id string, feeder_id string, ts timestamp, voltage double, current double")
    kw = dict(n=10, z=2.0, min_n=3)
    whole = windows.islands(windows.flag_anomalies(windows.zscore(windows.rolling_baseline(r, n=10)), 2.0, 3))
    cols = ["reading_id", "device_id", "baseline_n", "is_anomalous", "is_event_start", F.col("event_seq").cast("long")]
    for size in (25, 100, 10_000):
        cut = windows.islands_of_segments(windows.flagged_segments(r, size=size, bucket_seconds=5, **kw))
        assert cut.select("seg").distinct().count() == (1 if size == 10_000 else 300 // size)
        a, b = whole.select(*cols), cut.select(*cols)
        assert a.count() == b.count() > 500 and a.exceptAll(b).count() == 0
    assert whole.agg(F.max("event_seq")).first()[0] > 10


def test_the_windowed_detector_shuffles_readings_once(spark):
    r = spark.createDataFrame([], S.READINGS)
    plan = detect.detect_windowed(r)._jdf.queryExecution().executedPlan().toString()
    # every other exchange is of counts, cuts, halos or runs: only one carries all channels of all readings to (device, range)
    full = [line for line in plan.splitlines() if "Exchange hashpartitioning(device_id" in line and ", seg" in line]
    assert len(full) >= 1
    assert "WindowGroupLimit" in plan  # halos are cut down before they are shuffled


def test_wrong_guesses_take_few_rounds(spark):
    """A warm-up of one reading: every segment starts from a wrong state."""
    rng = np.random.default_rng(5)
    n, frames = 640, []
    for d in ("a", "b"):
        v = 100 + rng.normal(0, 1, n)
        v[rng.integers(0, n, 40)] += 50
        frames.append(pd.DataFrame({"reading_id": [f"{d}{i:05d}" for i in range(n)], "device_id": d, "feeder_id": "f",
                                    "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n), unit="s"),
                                    "voltage": v, "current": 10 + rng.normal(0, 0.1, n), "frequency": 50.0, "source": "synthetic"}))
    r = spark.createDataFrame(pd.concat(frames)[S.READINGS.names], S.READINGS)
    kept = set(glob.glob(f"{checkpoint_dir(spark)}/gridspark-frozen/*"))
    got = detect_state.detect_frozen(r, z=4.0, segment_rows=10, warmup=1, bucket_seconds=1)
    want = detect_state.detect_frozen(r, z=4.0, segment_rows=None)
    assert got.count() == want.count() > 50 and got.exceptAll(want).count() == 0
    (base,) = set(glob.glob(f"{checkpoint_dir(spark)}/gridspark-frozen/*")) - kept
    rounds = len(glob.glob(f"{base}/round=*")) - 1
    assert 1 < rounds <= math.log2(n / 10) + 1  # 64 segments a device


def test_overlay_reads_the_readings_once(spark, scratch):
    rows = [(f"r{i}", "d", "f", T0 + timedelta(seconds=i), 1.0, 1.0, 60.0, 0, "synthetic") for i in range(50)]
    spark.createDataFrame(rows, "reading_id string, device_id string, feeder_id string, ts timestamp, voltage double, current double, frequency double, event_flag long, source string").write.parquet(f"{scratch}/readings")
    r = spark.read.parquet(f"{scratch}/readings")
    fault = lambda i, start, length: (i, "d", "f", "sustained", T0 + timedelta(seconds=start), length, 0.5, 3.0, 0.1)
    sch = spark.createDataFrame([fault("a", 3, 40.0), fault("b", 10, 2.0), fault("c", 10, 4.0), fault("d", 20, None), fault("e", 30, -1.0), fault("f", 44, 3600.0)],
                                "fault_id string, device_id string, feeder_id string, fault_type string, start_time timestamp, duration_s double, voltage_factor double, current_factor double, freq_offset_hz double")
    for bucket in (1, 7, 3600):
        o = overlay.overlay_faults(r, sch, bucket_seconds=bucket)
        got = {int(x.reading_id[1:]): x._fault_id for x in o.collect()}
        assert got == {i: "a" if 3 <= i < 10 else "c" if 10 <= i < 14 else "f" if i >= 44 else None for i in range(50)}
        plan = o._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("FileScan parquet") == 1


def test_rolled_up_sketches(spark):
    rows = [(f"r{i}", f"d{i % 500}", f"f{i % 2}", T0 + timedelta(seconds=i), float(i), 1.0, 60.0, "synthetic") for i in range(7200)]
    rows += [("x", None, "f0", T0, None, 1.0, 60.0, "synthetic"), ("y", "d1", "f0", None, 1.0, 1.0, 60.0, "synthetic")]
    r = spark.createDataFrame(rows, "reading_id string, device_id string, feeder_id string, ts timestamp, voltage double, current double, frequency double, source string")
    minutes = health.window_sketches(r)
    assert minutes.count() == 240
    key = lambda x: (x.window_start, x.feeder_id)
    got, want = sorted(health.rollup_sketches(minutes, "1 hour").collect(), key=key), sorted(health.feeder_windows(r, "1 hour").collect(), key=key)
    assert len(got) == len(want) == 4
    for g, w in zip(got, want):
        assert g.window_end == w.window_end and g.avg_voltage == pytest.approx(w.avg_voltage)
        assert w.device_count == 250 and abs(g.device_count - 250) <= 12
    assert health.rollup_sketches(health.window_sketches(r.limit(0)), "1 hour").count() == 0


def test_lines_sink_counts_committed_files_only(spark, scratch):
    schema = spark.range(1).select(F.col("id"), F.lit("x").alias("name"), F.lit(None).cast("double").alias("v")).schema
    assert files.read_lines(spark, f"{scratch}/none", schema).count() == 0
    df = spark.range(40).select("id", F.concat(F.lit('a "quoted"\n line '), F.col("id").cast("string")).alias("name"), F.lit(None).cast("double").alias("v"))
    files.write_lines(df.repartition(4), f"{scratch}/out")
    files.write_lines(df.limit(0), f"{scratch}/out")
    with open(f"{scratch}/out/lines-left-by-a-failed-task.json", "w") as f:
        f.write('{"id": 99}\n')
    got = files.read_lines(spark, f"{scratch}/out", schema)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))
    files.write_lines(df, f"{scratch}/out")  # appended
    assert files.read_lines(spark, f"{scratch}/out", schema).count() == 80


def test_pairs_of_files_however_late(spark, scratch):
    os.makedirs(f"{scratch}/in/v1.0")
    def put(name, text):
        with open(f"{scratch}/in/v1.0/{name}", "wb") as f:
            f.write(text.encode())
    def run():
        from gridspark.streaming.detect import ROCKSDB
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        q = landing.pair_files(spark, f"{scratch}/in", stream=True).writeStream.format("parquet").option("checkpointLocation", f"{scratch}/ck")
        q.trigger(availableNow=True).start(f"{scratch}/out").awaitTermination()
        out = spark.read.schema("base_name string, content_cfg binary, cfg_mod_time timestamp, content_dat binary, dat_mod_time timestamp").parquet(f"{scratch}/out")
        return sorted((r.base_name.split("/")[-1], bytes(r.content_cfg).decode(), bytes(r.content_dat).decode()) for r in out.collect())
    for name in ("a.cfg", "a.dat", "b.x.cfg", "b.y.dat", "c.dat"):
        put(name, name)
    assert run() == [("a", "a.cfg", "a.dat")]
    put("other.txt", "no part of any pair")
    put("c.cfg", "c.cfg")
    assert run() == [("a", "a.cfg", "a.dat"), ("c", "c.cfg", "c.dat")]
    put("b.x.dat", "b.x.dat")
    assert run() == [("a", "a.cfg", "a.dat"), ("b.x", "b.x.cfg", "b.x.dat"), ("c", "c.cfg", "c.dat")]
    batch = landing.pair_files(spark, f"{scratch}/in")
    assert sorted(r.base_name.split("/")[-1] for r in batch.collect()) == ["a", "b.x", "c"]


def test_stream_report_of_retried_batches(spark, scratch):
    rows = [(None, 1.0), ("a", None), ("b", -1.0), ("c", 2.0), ("d", 3.0)]
    df = spark.createDataFrame(rows, "reading_id string, voltage double")
    fn = quality.expect_and_report(quality.READING_RULES, lambda good, i: tables.append_batch(good, f"{scratch}/good", "1", i),
                                   lambda report, i: tables.append_batch(report, f"{scratch}/report", "1", i))
    for i in (0, 1, 1):  # the last batch twice
        fn(df, i)
    fn(df.limit(0), 2)
    want = {r.rule: (2 * r.failed_rows, 2 * r.total_rows, 2 * r.kept_rows) for r in quality.expectation_report(df).collect()}
    got = quality.total_report(spark.read.schema(quality.REPORT).parquet(f"{scratch}/report"))
    assert {r.rule: (r.failed_rows, r.total_rows, r.kept_rows) for r in got.collect()} == want
    assert spark.read.parquet(f"{scratch}/good").count() == 4
