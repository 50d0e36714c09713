"""T7s/T8s: versions of tables, full refreshes, the keyed event table; readings that wait (D3)."""
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridspark import schemas as S
from gridspark.operators import detect_state
from gridspark.plans import flows
from gridspark.sources import keyed, landing, tables, versions
from gridspark.streaming import detect as SD
from gridspark.streaming import gold as SG

T0 = datetime(2024, 1, 1)
NOW = {"availableNow": True}


def raw(spark, ids, device="d"):
    rows = [(f"r{i}", device, "f", str(T0 + timedelta(seconds=i)), 100.0, 10.0, 60.0, 0, "synthetic", None, None) for i in ids]
    return spark.createDataFrame(rows, S.READINGS_RAW)


def ids(df):
    return sorted(r.reading_id for r in df.collect())


def test_a_refresh_loses_nothing(spark, scratch):
    landed, silver = f"{scratch}/landed", f"{scratch}/silver"
    raw(spark, [1, 2, 3]).write.parquet(landed)
    flows.silver_stream(spark, landed, None, silver, f"{scratch}/ck", NOW).awaitTermination()
    assert ids(flows.read_silver(spark, silver)) == ["r1", "r2", "r3"]
    raw(spark, [4, 5]).write.mode("append").parquet(landed)
    # a stream from another checkpoint on the same table, as after a lost one
    flows.silver_stream(spark, landed, None, silver, SG.fresh_checkpoint(scratch), NOW).awaitTermination()
    assert ids(flows.read_silver(spark, silver)) == ["r1", "r2", "r3", "r4", "r5"]
    # the landed files vanish; some rows come again, one is new
    raw(spark, [2, 6]).write.mode("overwrite").parquet(landed)
    ck = flows.refresh(flows.silver_stream, spark, silver, scratch, spark, landed, None, silver)
    assert ids(flows.read_silver(spark, silver)) == ["r2", "r6"]
    raw(spark, [7]).write.mode("append").parquet(landed)  # and goes on from the refresh's checkpoint
    flows.silver_stream(spark, landed, None, silver, ck, NOW).awaitTermination()
    assert ids(flows.read_silver(spark, silver)) == ["r2", "r6", "r7"]


def test_readers_see_the_old_rows_until_the_switch(spark, scratch):
    path = f"{scratch}/t"
    assert versions.current(spark, path) is None and versions.current_folder(spark, path) == path
    versions.write_version(spark.range(3), path)
    first = versions.current(spark, path)
    spark.range(5).write.parquet(versions.folder(path, "next"))  # written, not yet published
    assert spark.read.parquet(versions.current_folder(spark, path)).count() == 3
    versions.publish(spark, path, "next")
    versions.publish(spark, path, "next")
    assert spark.read.parquet(versions.current_folder(spark, path)).count() == 5
    versions.publish(spark, path, first)  # back again
    assert spark.read.parquet(versions.current_folder(spark, path)).count() == 3


def emissions(spark, rows):
    return spark.createDataFrame([(e, "d", "f", T0 + timedelta(seconds=t), kind, 0.5, f"r{t:03d}") for e, t, kind in rows], S.EMISSIONS)


def test_one_batch_with_all_emissions_shows_the_last_status(spark, scratch):
    """The opening and the end of an event in one batch, in both kinds of table."""
    e = emissions(spark, [("a", 1, None), ("a", 2, "transient"), ("b", 2, "transient"), ("b", 1, None), ("c", 1, None)]).repartition(4)
    want = {r.event_id: r.fault_type for r in detect_state.event_status(e).collect()}
    SG.upsert_events_batch(f"{scratch}/log", "1")(e, 0)
    SG.upsert_keyed_batch(f"{scratch}/keyed", "1")(e, 0)
    for got in (tables.read_table(spark, f"{scratch}/log", S.EMISSIONS), keyed.read_keyed(spark, f"{scratch}/keyed", S.EMISSIONS)):
        assert {r.event_id: r.fault_type for r in got.collect()} == want == {"a": "transient", "b": "transient", "c": None}


def test_keyed_table_over_batches(spark, scratch):
    path = f"{scratch}/t"
    upsert = lambda rows, i, run="1": SG.upsert_keyed_batch(path, run)(emissions(spark, rows), i)
    read = lambda: {r.event_id: (r.timestamp.second, r.fault_type) for r in keyed.read_keyed(spark, path, S.EMISSIONS).collect()}
    assert read() == {}
    upsert([(f"e{i}", 1, None) for i in range(100)], 0)
    upsert([("e5", 9, "sustained"), ("new", 3, None)], 1)
    after = read()
    assert len(after) == 101 and after["e5"] == (9, "sustained") and after["e6"] == (1, None)
    upsert([("e5", 9, "sustained"), ("new", 3, None)], 1)  # a retry
    upsert([], 2)
    upsert([("e5", 4, "transient")], 3)  # an earlier emission that comes late changes nothing
    assert read() == after
    upsert([("e6", 8, "transient")], 0, run="2")  # a later run counts from 0 again
    assert read() == {**after, "e6": (8, "transient")}
    # a batch writes the buckets of its keys and no others
    import glob
    assert len(glob.glob(f"{path}/rows/_run=1/_batch=3/_bucket=*")) == 1


def test_keyed_table_without_an_order(spark, scratch):
    df = lambda rows: spark.createDataFrame(rows, "k string, v int")
    keyed.upsert_keyed(df([("a", 1), (None, 2)]), f"{scratch}/t", "1", 0, ["k"])
    keyed.upsert_keyed(df([("a", 0), (None, 3), ("b", 5)]), f"{scratch}/t", "1", 1, ["k"])
    got = {r.k: r.v for r in keyed.read_keyed(spark, f"{scratch}/t", df([]).schema).collect()}
    assert got == {"a": 0, None: 3, "b": 5}
    with pytest.raises(Exception, match="duplicate"):
        keyed.upsert_keyed(df([("a", 1), ("a", 2)]), f"{scratch}/t", "1", 2, ["k"])
    assert {r.k: r.v for r in keyed.read_keyed(spark, f"{scratch}/t", df([]).schema).collect()} == got


PARAMS = dict(z=4.0, sustained_s=5.0, window=10, min_n=3)


def wave(spark, seconds, device="d"):
    """Readings with spikes at multiples of 17 and a long fault at 60..75."""
    rows = [(f"r{i:04d}", device, "f", str(T0 + timedelta(seconds=i)), 100.0 + (i * 7) % 5 + (400.0 if i % 17 == 0 or 60 <= i <= 75 else 0.0),
             10.0 + (i * 3) % 4, 60.0, 0, "synthetic", None, None) for i in seconds]
    return spark.createDataFrame(rows, S.READINGS_RAW)


def waiting(spark, scratch, batches, **how):
    for part in batches:
        part.coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        s = landing.read_readings_stream(spark, f"{scratch}/in").drop("_ingested_at").withColumn("ts", F.col("ts").cast("timestamp"))
        e = SD.detect_frozen_stream(s, **PARAMS, **how)
        (e.writeStream.format("parquet").option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True)
         .start(f"{scratch}/out").awaitTermination())
    return spark.read.schema(e.schema).parquet(f"{scratch}/out")


def test_late_readings_wait_for_the_watermark(spark, scratch):
    late = [i for i in range(100) if i % 3 == 0]
    first = [i for i in range(100) if i % 3]
    end = [200, 201]  # moves the watermark past all the others
    got = waiting(spark, scratch, [wave(spark, first), wave(spark, late), wave(spark, end)], delay="100 seconds")
    want = detect_state.detect_frozen(wave(spark, range(100)).withColumn("ts", F.col("ts").cast("timestamp")), **PARAMS)
    assert got.count() == want.count() > 10 and got.exceptAll(want).count() == 0


def test_readings_beyond_the_delay_are_dropped_and_idle_devices_forgotten(spark, scratch):
    parts = [wave(spark, range(40)), wave(spark, [300], "clock"), wave(spark, [20]), wave(spark, [900], "clock"),
             wave(spark, range(901, 940)), wave(spark, [2000], "clock")]
    got = waiting(spark, scratch, parts, delay="10 seconds", idle="60 seconds")
    both = [detect_state.detect_frozen(wave(spark, r).withColumn("ts", F.col("ts").cast("timestamp")), **PARAMS)
            for r in (range(40), range(901, 940))]
    want = both[0].unionAll(both[1])  # a new baseline after the gap
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    with pytest.raises(ValueError, match="delay"):
        SD.detect_frozen_stream(landing.read_readings_stream(spark, f"{scratch}/in").withColumn("ts", F.col("ts").cast("timestamp")), idle="1 minute")


def test_health_follows_the_faults_that_came_since(spark, scratch):
    """Days of changed faults are rewritten, a moved event's old day included; other days are left alone."""
    import os

    from gridspark.operators import health
    path, log = f"{scratch}/health", f"{scratch}/faults"
    windows = spark.createDataFrame(
        [(datetime(2024, 1, d, 0, 0), datetime(2024, 1, d, 0, 1), "f1", 1.0, 1.0, 60.0, 2) for d in range(1, 8)],
        "window_start timestamp, window_end timestamp, feeder_id string, avg_voltage double, avg_current double, avg_frequency double, device_count long")
    def fault(event, day):
        return spark.createDataFrame([(event, "d", "f1", datetime(2024, 1, day, 0, 0, 30), "transient", 0.5)], S.FAULTS)
    def counts():
        return {r.window_start.day: r.fault_count for r in SG.read_health(spark, path).collect()}
    def kept():
        return {d: os.listdir(f"{path}/day=2024-01-0{d}") for d in range(1, 8) if os.path.isdir(f"{path}/day=2024-01-0{d}")}
    fn = SG.upsert_health_batch(path, lambda s: tables.read_table(s, log, S.FAULTS), faults_log=log)
    tables.ensure_table(spark, log, S.FAULTS)
    fn(windows.filter("day(window_start) <= 3"), 0)
    assert counts() == {1: 0, 2: 0, 3: 0}
    tables.upsert_table(spark, log, fault("a", 2), ["event_id"], S.FAULTS, "1", 0)
    tables.upsert_table(spark, log, fault("b", 5), ["event_id"], S.FAULTS, "1", 1)
    before = kept()
    for _ in range(2):  # the batch, and its retry
        fn(windows.filter("day(window_start) = 4"), 1)
        assert counts() == {1: 0, 2: 1, 3: 0, 4: 0}
        assert kept()[1] == before[1] and kept()[3] == before[3] and kept()[2] != before[2]
    tables.upsert_table(spark, log, fault("a", 3), ["event_id"], S.FAULTS, "1", 2)  # the event moves to another day
    before = kept()
    fn(windows.filter("day(window_start) = 5"), 2)
    assert counts() == {1: 0, 2: 0, 3: 1, 4: 0, 5: 1}
    assert kept()[1] == before[1] and kept()[4] == before[4]
    before = kept()
    fn(windows.filter("day(window_start) = 6"), 3)  # nothing changed: the new day alone is written
    assert {d: f for d, f in kept().items() if d < 6} == before and counts()[6] == 0
    want = health.with_fault_counts(windows.filter("day(window_start) <= 6"), tables.read_table(spark, log, S.FAULTS), "1 minute")
    got = SG.read_health(spark, path).drop("day")
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count()
