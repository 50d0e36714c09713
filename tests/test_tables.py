"""Upsert semantics and tables as logs of batches."""
import pytest
from pyspark.sql import functions as F

from gridspark import schemas as S
from gridspark.sources import tables


def _f(spark, rows):
    return spark.createDataFrame(rows, "event_id string, device_id string, v int")


def test_upsert_replaces_and_inserts(spark):
    t = _f(spark, [("a", "d1", 1), ("b", "d1", 1)])
    u = _f(spark, [("b", "d1", 2), ("c", "d2", 2)])
    out = sorted(tuple(r) for r in tables.upsert(t, u, ["event_id"]).collect())
    assert out == [("a", "d1", 1), ("b", "d1", 2), ("c", "d2", 2)]
    rep = sorted(tuple(r) for r in tables.upsert(t, u, ["event_id"], mode="replace",
                                                 replace_on=["device_id"]).collect())
    assert rep == [("b", "d1", 2), ("c", "d2", 2)]


def test_upsert_duplicate_keys_raise(spark):
    t = _f(spark, [("a", "d1", 1)])
    u = _f(spark, [("b", "d1", 2), ("b", "d1", 3)])
    with pytest.raises(Exception, match="duplicate"):
        tables.upsert(t, u, ["event_id"]).collect()


def test_table_lifecycle_and_idempotent_batches(spark, scratch):
    path = f"{scratch}/faults"
    def f(event, kind, score):
        return spark.createDataFrame([(event, "d", "f", None, kind, score)], S.FAULTS)
    assert tables.read_table(spark, path, S.FAULTS).count() == 0
    assert tables.ensure_table(spark, path, S.FAULTS).count() == 0
    run = tables.new_run()
    # the first batch of a query counts, though the table existed before it
    assert tables.upsert_table(spark, path, f("e1", None, 0.5), ["event_id"], S.FAULTS, run, 0).count() == 1
    assert tables.upsert_table(spark, path, f("e1", "transient", 0.7), ["event_id"], S.FAULTS, run, 1).first().fault_type == "transient"
    # a retried batch replaces what it wrote
    assert tables.upsert_table(spark, path, f("e2", None, 0.1), ["event_id"], S.FAULTS, run, 2).count() == 2
    assert tables.upsert_table(spark, path, f("e2", None, 0.1), ["event_id"], S.FAULTS, run, 2).count() == 2
    assert tables.read_log(spark, path, S.FAULTS).count() == 3
    # a restarted checkpoint counts its batches from 0 again, as another run that comes later
    got = tables.upsert_table(spark, path, f("e1", "sustained", 0.9), ["event_id"], S.FAULTS, tables.new_run(), 0)
    assert {r.event_id: r.fault_type for r in got.collect()} == {"e1": "sustained", "e2": None}
    assert tables.ensure_table(spark, path, S.FAULTS).count() == 2
    assert tables.reset_table(spark, path, S.FAULTS).count() == 0
    assert tables.upsert_table(spark, path, f("e3", None, 0.1), ["event_id"], S.FAULTS).count() == 1


def test_read_errors_raise(spark, scratch):
    import os
    path = f"{scratch}/faults"
    tables.upsert_table(spark, path, spark.createDataFrame([("e1", "d", "f", None, None, 0.5)], S.FAULTS), ["event_id"], S.FAULTS, "1", 0)
    os.makedirs(f"{path}/_run=1/_batch=1")
    with open(f"{path}/_run=1/_batch=1/part-0.parquet", "wb") as out:
        out.write(b"no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        tables.read_table(spark, path, S.FAULTS).collect()


def test_refresh_fault_counts_fixes_late_faults(spark):
    from datetime import datetime
    from gridspark.operators import health
    h = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 0), "f1", datetime(2024, 1, 1, 0, 1), 1.0, 1.0, 60.0, 2, 0, "healthy")],
        "window_start timestamp, feeder_id string, window_end timestamp, avg_voltage double, "
        "avg_current double, avg_frequency double, device_count long, fault_count long, health_status string")
    late = spark.createDataFrame([("e1", "d", "f1", datetime(2024, 1, 1, 0, 0, 30), "transient", 0.5)], S.FAULTS)
    r = health.refresh_fault_counts(h, late).first()
    assert (r.fault_count, r.health_status) == (1, "fault")
    assert health.refresh_fault_counts(h, late).columns == h.columns
