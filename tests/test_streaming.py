"""Streaming: D3 equals D2 on the same readings fed in order; exact windowed
stream equals batch for closed windows; late rows; foreachBatch upsert;
stream union; readers start on an empty folder."""
import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import SF001
from gridspark import schemas as S
from gridspark.operators import detect_state, health, quality
from gridspark.plans import catalog as C
from gridspark.plans import oracle as O
from gridspark.plans import proxies as X
from gridspark.sources import landing, tables
from gridspark.streaming import detect as SD
from gridspark.streaming import gold as SG

PARAMS = dict(z=O.Z, sustained_s=O.SUSTAINED_S, window=O.WINDOW, min_n=O.MIN_N)


def _land(spark, folder, chunks=5):
    """Land the proxy readings as ``chunks`` files in time order."""
    pdf = X.readings_raw(spark, SF001).toPandas().sort_values("ts")
    os.makedirs(folder)
    step = -(-len(pdf) // chunks)
    for i in range(chunks):
        p = f"{folder}/part-{i:04d}.parquet"
        part = pdf.iloc[i * step:(i + 1) * step]
        pq.write_table(pa.Table.from_pandas(part, preserve_index=False,
                                            schema=pa.schema([(f.name, {"string": pa.string(), "double": pa.float64(),
                                                                        "bigint": pa.int64()}[f.dataType.simpleString()])
                                                              for f in S.READINGS_RAW.fields])), p)
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))


def _silver_stream(spark, folder):
    s = landing.read_readings_stream(spark, folder, max_files_per_trigger=1).drop("_ingested_at")
    return quality.expect_or_drop(quality.clean_readings(s))


def _run(df, name, ckpt, mode="append"):
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
           .option("checkpointLocation", ckpt).start())
    q.processAllAvailable()
    q.stop()
    return df.sparkSession.table(name)


def test_stream_detector_equals_batch(spark, scratch):
    _land(spark, f"{scratch}/in")
    got = _run(SD.detect_frozen_stream(_silver_stream(spark, f"{scratch}/in"), **PARAMS), "d3", f"{scratch}/ck")
    silver = quality.expect_or_drop(quality.clean_readings(X.readings_raw(spark, SF001)))
    want = detect_state.detect_frozen(silver, **PARAMS)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def test_stream_windows_equal_batch_for_closed_windows(spark, scratch):
    _land(spark, f"{scratch}/in")
    silver = quality.expect_or_drop(quality.clean_readings(X.readings_raw(spark, SF001)))
    batch = health.feeder_windows(silver, "1 hour")
    r6 = lambda d: d.select(*[F.round(c, 6).alias(c) if c.startswith("avg") else F.col(c) for c in d.columns])
    for exact, name in ((True, "fw_exact"), (False, "fw_approx")):
        got = _run(SG.feeder_windows_stream(_silver_stream(spark, f"{scratch}/in"), "1 hour", "30 seconds", exact),
                   name, f"{scratch}/ck_{name}")
        # append mode: only windows the (global) watermark has passed are out
        wm = silver.select(F.max("ts") - F.expr("INTERVAL 30 SECONDS")).first()[0]
        closed = batch.filter(F.col("window_end") <= F.lit(wm))
        assert got.count() == closed.count() < batch.count()
        if exact:
            assert r6(got).exceptAll(r6(closed)).count() == 0


def test_late_rows_are_dropped_after_watermark(spark, scratch):
    folder = f"{scratch}/late"
    os.makedirs(folder)
    def put(i, rows):
        p = f"{folder}/part-{i}.parquet"
        spark_rows = [dict(zip(S.READINGS_RAW.names, r)) for r in rows]
        pq.write_table(pa.Table.from_pylist(spark_rows), p)
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    row = lambda rid, ts: (rid, "d", "f", ts, 1.0, 1.0, 60.0, 0, "synthetic", None, None)
    put(0, [row("a", "2024-01-01 00:00:10"), row("b", "2024-01-01 00:01:10")])
    put(1, [row("c", "2024-01-01 00:05:00")])        # watermark moves to 00:04:30
    put(2, [row("late", "2024-01-01 00:00:20")])     # window [00:00, 00:01) already closed
    put(3, [row("d", "2024-01-01 00:10:00")])
    got = _run(SG.feeder_windows_stream(_silver_stream(spark, folder), "1 minute", "30 seconds"),
               "late", f"{scratch}/ck")
    first = got.filter(F.minute("window_start") == 0).first()
    assert first.device_count == 1 and first.avg_voltage == 1.0
    assert got.count() == 3  # [00:00), [00:01), [00:05); [00:10) still open


def test_foreach_batch_upsert_and_union(spark, scratch):
    _land(spark, f"{scratch}/in")
    syn = _silver_stream(spark, f"{scratch}/in")
    em = SD.detect_frozen_stream(syn, **PARAMS)
    path = f"{scratch}/gold"
    q = (em.writeStream.foreachBatch(SG.upsert_events_batch(path, tables.new_run()))
           .option("checkpointLocation", SG.fresh_checkpoint(scratch)).start())
    q.processAllAvailable()
    q.stop()
    got = detect_state.event_status(tables.read_log(spark, path, em.schema)).select(*S.FAULTS.names)
    silver = quality.expect_or_drop(quality.clean_readings(X.readings_raw(spark, SF001)))
    want = detect_state.event_status(detect_state.detect_frozen(silver, **PARAMS))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*S.FAULTS.names)).count() == 0


def test_stream_union_and_empty_start(spark, scratch):
    os.makedirs(f"{scratch}/syn")
    os.makedirs(f"{scratch}/meter")
    syn = quality.clean_readings(landing.read_readings_stream(spark, f"{scratch}/syn").drop("_ingested_at"))
    met = quality.derive_meter_readings(landing.read_meter_stream(spark, f"{scratch}/meter"))
    u = quality.unify_readings(syn, met)
    assert u.isStreaming
    assert _run(u, "u_empty", f"{scratch}/ck").count() == 0


def test_observed_expectations_on_stream(spark, scratch):
    _land(spark, f"{scratch}/in", chunks=2)
    s = landing.read_readings_stream(spark, f"{scratch}/in").drop("_ingested_at")
    c = quality.clean_readings(s)
    obs = quality.observe_expectations(c)
    q = (quality.expect_or_drop(obs).writeStream.format("memory").queryName("obs")
         .option("checkpointLocation", f"{scratch}/ck").start())
    q.processAllAvailable()
    m = q.lastProgress["observedMetrics"]["expectations"]
    q.stop()
    raw = quality.clean_readings(X.readings_raw(spark, SF001))
    rep = {r.rule: r.failed_rows for r in quality.expectation_report(raw).collect()}
    assert int(m["total_rows"]) == raw.count()
    assert int(m["failed_valid_voltage"]) == rep["valid_voltage"]


def test_stream_static_health_join(spark, scratch):
    _land(spark, f"{scratch}/in")
    silver = quality.expect_or_drop(quality.clean_readings(X.readings_raw(spark, SF001)))
    faults = C.detect_faults(spark, SF001, "device")
    got = _run(SG.feeder_health_stream(_silver_stream(spark, f"{scratch}/in"), faults, "1 hour"),
               "health_s", f"{scratch}/ck")
    want = health.feeder_health(silver, faults, "1 hour")
    wm = silver.select(F.max("ts") - F.expr("INTERVAL 30 SECONDS")).first()[0]
    want = want.filter(F.col("window_end") <= F.lit(wm))
    r6 = lambda d: d.select(*[F.round(c, 6).alias(c) if c.startswith("avg") else F.col(c) for c in d.columns])
    assert got.count() == want.count()
    assert r6(got).exceptAll(r6(want)).count() == 0
    assert got.filter(F.col("health_status") == "fault").count() > 0


def test_foreach_batch_health_refreshes_counts(spark, scratch):
    _land(spark, f"{scratch}/in")
    faults = C.detect_faults(spark, SF001, "device")
    w = SG.feeder_windows_stream(_silver_stream(spark, f"{scratch}/in"), "1 hour", "30 seconds")
    path = f"{scratch}/health"
    q = (w.writeStream.outputMode("append")
           .foreachBatch(SG.upsert_health_batch(path, lambda s: faults, "1 hour"))
           .option("checkpointLocation", SG.fresh_checkpoint(scratch)).start())
    q.processAllAvailable()
    q.stop()
    got = SG.read_health(spark, path).drop("day")
    silver = quality.expect_or_drop(quality.clean_readings(X.readings_raw(spark, SF001)))
    wm = silver.select(F.max("ts") - F.expr("INTERVAL 30 SECONDS")).first()[0]
    want = health.feeder_health(silver, faults, "1 hour").filter(F.col("window_end") <= F.lit(wm))
    r6 = lambda d: d.select(*[F.round(c, 6).alias(c) if c.startswith("avg") else F.col(c) for c in sorted(d.columns)])
    assert got.count() == want.count()
    assert r6(got).exceptAll(r6(want)).count() == 0


def test_late_faults_and_only_touched_days_are_rewritten(spark, scratch):
    from datetime import datetime
    path = f"{scratch}/health"
    windows = spark.createDataFrame(
        [(datetime(2024, 1, d, 0, 0), datetime(2024, 1, d, 0, 1), "f1", 1.0, 1.0, 60.0, 2) for d in (1, 2, 3)],
        "window_start timestamp, window_end timestamp, feeder_id string, avg_voltage double, avg_current double, avg_frequency double, device_count long")
    now = {"faults": spark.createDataFrame([], S.FAULTS)}
    fn = SG.upsert_health_batch(path, lambda s: now["faults"])
    fn(windows.filter("day(window_start) < 3"), 0)
    files = {d: set(os.listdir(f"{path}/day=2024-01-0{d}")) for d in (1, 2)}
    now["faults"] = spark.createDataFrame([("e", "d", "f1", datetime(2024, 1, 2, 0, 0, 30), "transient", 0.5)], S.FAULTS)
    for _ in range(2):  # the batch, and its retry
        fn(windows.filter("day(window_start) = 3"), 1)
        got = {r.window_start.day: r.fault_count for r in SG.read_health(spark, path).collect()}
        assert got == {1: 0, 2: 1, 3: 0} and SG.read_health(spark, path).count() == 3
    assert set(os.listdir(f"{path}/day=2024-01-01")) == files[1]
    assert set(os.listdir(f"{path}/day=2024-01-02")) != files[2]


def test_late_readings_are_counted(spark, scratch):
    folder = f"{scratch}/in"
    os.makedirs(folder)
    def put(i, ids):
        rows = [(f"r{k}", "d", "f", f"2024-01-01 00:00:{k:02d}", 1.0, 1.0, 60.0, 0, "synthetic", None, None) for k in ids]
        pq.write_table(pa.Table.from_pylist([dict(zip(S.READINGS_RAW.names, r)) for r in rows]), f"{folder}/part-{i}.parquet")
        os.utime(f"{folder}/part-{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    put(0, [1, 2, 9])
    put(1, [3, 4, 10])
    q = (SD.detect_frozen_stream(_silver_stream(spark, folder), **PARAMS).writeStream.format("noop")
         .option("checkpointLocation", f"{scratch}/ck").start())
    q.processAllAvailable()
    late = [p["observedMetrics"]["late_readings"]["n"] for p in q.recentProgress if "late_readings" in (p.get("observedMetrics") or {})]
    q.stop()
    assert sum(int(n) for n in late) == 2
