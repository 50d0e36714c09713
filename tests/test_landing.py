"""Sources and sinks: explicit schemas, header rename, block numbers,
file pairing, sink formats."""
import os

import pytest
from pyspark.sql import functions as F

from gridspark import schemas as S
from gridspark.sources import landing, sinks


def test_meter_csv_rename_and_block(spark, scratch):
    d = f"{scratch}/meter"
    os.makedirs(d)
    for n in (3, 12):
        with open(f"{d}/LCL-June2015v2_{n}.csv", "w") as f:
            f.write(f"LCLid,stdorToU,DateTime,{S.METER_KWH_SOURCE_COLUMN}\n")
            f.write(f"MAC{n},Std,2012-01-01 00:30:00.0000000,0.1\nMAC{n},Std,2012-01-01 01:00:00.0000000,Null\n")
    df = landing.read_meter(spark, d)
    assert S.METER_KWH_COLUMN in df.columns and "_ingested_at" in df.columns
    assert sorted((r.LCLid, r.block) for r in df.select("LCLid", "block").distinct().collect()) == \
        [("MAC12", 12), ("MAC3", 3)]


def test_sinks_roundtrip_and_unknown_kind(spark, scratch):
    rows = [("r1", "d", "f", "2024-01-01T00:00:00Z", 1.0, 2.0, 60.0, 0, "synthetic")]
    df = spark.createDataFrame(rows, "reading_id string, device_id string, feeder_id string, ts string, "
                                     "voltage double, current double, frequency double, event_flag long, source string")
    for fmt in ("parquet", "jsonl", "csv"):
        sinks.write_readings(df, f"{scratch}/{fmt}", fmt)
        sinks.write_readings(df, f"{scratch}/{fmt}", fmt)  # append
    back = landing.read_readings(spark, f"{scratch}/parquet")
    assert back.count() == 2 and back.schema["_fault_id"].dataType.simpleString() == "string"
    assert spark.read.schema(S.READINGS_RAW).json(f"{scratch}/jsonl").count() == 2
    assert spark.read.option("header", True).csv(f"{scratch}/csv").count() == 2
    with pytest.raises(ValueError):
        sinks.write_readings(df, f"{scratch}/x", "avro")


def test_pair_files(spark, scratch):
    d = f"{scratch}/cap"
    os.makedirs(d)
    for base in ("a", "b"):
        for ext in ("cfg", "dat"):
            with open(f"{d}/{base}.{ext}", "wb") as f:
                f.write(f"{base}-{ext}".encode())
    with open(f"{d}/c.cfg", "wb") as f:
        f.write(b"lonely")
    p = landing.pair_files(spark, d).collect()
    assert sorted(bytes(r.content_cfg).decode() for r in p) == ["a-cfg", "b-cfg"]
    assert all(r.base_name.endswith(("/a", "/b")) for r in p)


def test_empty_table_and_stream_on_empty_folder(spark, scratch):
    assert landing.empty_table(spark, S.CONTEXT_RAW).count() == 0
    os.makedirs(f"{scratch}/empty")
    s = landing.read_readings_stream(spark, f"{scratch}/empty")
    assert s.isStreaming and "_ingested_at" in s.columns
    q = s.writeStream.format("memory").queryName("empty_in").option(
        "checkpointLocation", f"{scratch}/ck").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("empty_in").count() == 0


def test_stream_sink_and_fresh_checkpoint(spark, scratch):
    from gridspark.streaming.gold import fresh_checkpoint
    rows = [("r1", "d", "f", "2024-01-01T00:00:00Z", 1.0, 2.0, 60.0, 0, "synthetic", None, None)]
    spark.createDataFrame(rows, S.READINGS_RAW).write.parquet(f"{scratch}/in1")
    src = landing.read_readings_stream(spark, f"{scratch}/in1")
    ck = fresh_checkpoint(scratch)
    q = sinks.stream_readings(src, f"{scratch}/out", ck, "jsonl", trigger={"availableNow": True})
    q.awaitTermination(120)
    assert spark.read.schema(S.READINGS_RAW).json(f"{scratch}/out").count() == 1
    # full refresh onto new landing files: a new checkpoint folder, everything re-read
    spark.createDataFrame(rows * 2, S.READINGS_RAW).write.parquet(f"{scratch}/in2")
    ck2 = fresh_checkpoint(scratch)
    assert ck2 != ck
    q = sinks.stream_readings(landing.read_readings_stream(spark, f"{scratch}/in2"), f"{scratch}/out2", ck2,
                              "parquet", trigger={"availableNow": True})
    q.awaitTermination(120)
    assert spark.read.parquet(f"{scratch}/out2").count() == 2


def test_pairs_by_file_name_in_dotted_folders(spark, scratch):
    for folder in ("cap.v1", "cap.v2"):
        os.makedirs(f"{scratch}/in/{folder}")
        for base in ("a", "b.x", "c"):
            for ext in ("cfg", "dat"):
                with open(f"{scratch}/in/{folder}/{base}.{ext}", "wb") as f:
                    f.write(f"{folder}/{base}".encode())
    rows = landing.pair_files(spark, f"{scratch}/in").collect()
    assert len(rows) == 6 and all(r.content_cfg == r.content_dat for r in rows)


def test_console_prints_every_row(spark, capsys):
    df = spark.createDataFrame([(f"r{i}", float(i)) for i in range(200)], "reading_id string, voltage double")
    sinks.write_readings(df, fmt="console")
    out = capsys.readouterr().out.splitlines()
    assert len(out) == 200 and '"reading_id":"r199"' in out[-1]
