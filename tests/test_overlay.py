"""J3 overlay: isolation, clearing, activity at +5 s, newer fault replaces
older, bucket-size independence, and brute force on a small fixture."""
from datetime import datetime, timezone

from pyspark.sql import functions as F

from fixtures import schedule, telemetry
from gridspark.operators import overlay

T0 = 2000.0


def _at(df, device, second):
    ts = datetime.fromtimestamp(T0 + second, tz=timezone.utc).replace(tzinfo=None)
    return df.filter((F.col("device_id") == device) & (F.col("ts") == F.lit(ts))).first()


def test_fault_isolated_and_clears(spark):
    r = telemetry(spark, 20, 4, 5, T0, 2)
    sch = schedule(spark, [("f1", "dev_0005", "feeder_001", "transient", T0, 1.0)])
    o = overlay.overlay_faults(r, sch)
    hit = _at(o, "dev_0005", 0)
    base = _at(r, "dev_0005", 0)
    assert hit.event_flag == 1 and hit._fault_id == "f1" and hit._fault_type_truth == "transient"
    assert hit.voltage == base.voltage * 0.5 and hit.voltage < 6800
    assert hit.current == base.current * 3.0
    assert _at(o, "dev_0000", 0).event_flag == 0
    after = _at(o, "dev_0005", 2)
    assert after.event_flag == 0 and after._fault_type_truth is None


def test_long_fault_active_at_five_seconds(spark):
    r = telemetry(spark, 10, 2, 12, T0, 3)
    o = overlay.overlay_faults(r, schedule(spark, [("f2", "dev_0002", "feeder_000", "sustained", T0, 10.0)]))
    assert _at(o, "dev_0002", 5).event_flag == 1
    assert _at(o, "dev_0002", 10).event_flag == 0  # active on [start, start + duration)


def test_newer_fault_replaces_older(spark):
    r = telemetry(spark, 2, 1, 30, T0, 4)
    sch = schedule(spark, [("old", "dev_0000", "feeder_000", "sustained", T0, 25.0),
                           ("new", "dev_0000", "feeder_000", "transient", T0 + 5, 2.0)])
    o = overlay.overlay_faults(r, sch)
    assert _at(o, "dev_0000", 3)._fault_id == "old"
    assert _at(o, "dev_0000", 6)._fault_id == "new"
    assert _at(o, "dev_0000", 10).event_flag == 0   # the newer one ended; the older was replaced
    assert o.count() == r.count()                    # no duplicated rows


def test_bucket_size_independent_and_brute_force(spark):
    r = telemetry(spark, 3, 1, 200, T0, 9)
    faults = [(f"f{i}", f"dev_{i % 3:04d}", "feeder_000", "transient", T0 + 7 * i, 3.0 + (i % 5) * 4)
              for i in range(25)]
    sch = schedule(spark, faults)
    a = overlay.overlay_faults(r, sch, bucket_seconds=3600)
    b = overlay.overlay_faults(r, sch, bucket_seconds=10)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # brute force: latest start <= ts per device, active on [start, start + dur)
    got = {(x.device_id, x.reading_id): x._fault_id for x in a.collect()}
    for row in r.collect():
        t = row.ts.replace(tzinfo=timezone.utc).timestamp()
        cands = [f for f in faults if f[1] == row.device_id and f[4] <= t]
        want = None
        if cands:
            f = max(cands, key=lambda f: (f[4], f[0]))
            want = f[0] if t < f[4] + f[5] else None
        assert got[(row.device_id, row.reading_id)] == want
