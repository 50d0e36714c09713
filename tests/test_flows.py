"""End-to-end flows over landed files (batch and streaming)."""
import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import SF001
from gridspark import schemas as S
from gridspark.operators import detect_state, health
from gridspark.plans import catalog as C
from gridspark.plans import flows
from gridspark.plans import oracle as O
from gridspark.plans import proxies as X
from gridspark.streaming.gold import read_health

PARAMS = dict(z=O.Z, sustained_s=O.SUSTAINED_S, window=O.WINDOW, min_n=O.MIN_N)


def _land(spark, root):
    rd, md = f"{root}/readings", f"{root}/meter"
    os.makedirs(rd)
    os.makedirs(md)
    pdf = X.readings_raw(spark, SF001).toPandas().sort_values("ts")
    arrow_schema = pa.schema([(f.name, {"string": pa.string(), "double": pa.float64(), "bigint": pa.int64()}
                               [f.dataType.simpleString()]) for f in S.READINGS_RAW.fields])
    for i in range(3):
        part = pdf.iloc[i::3]
        pq.write_table(pa.Table.from_pandas(part, preserve_index=False, schema=arrow_schema),
                       f"{rd}/part-{i}.parquet")
    meter = X.meter_raw(spark, SF001).toPandas()
    for b, g in meter.groupby("block"):
        g.drop(columns=["block", "o_orderkey"]).rename(
            columns={S.METER_KWH_COLUMN: S.METER_KWH_SOURCE_COLUMN}).to_csv(
            f"{md}/LCL-June2015v2_{b}.csv", index=False)
    return rd, md


def test_batch_flow(spark, scratch):
    rd, md = _land(spark, scratch)
    silver = flows.silver_batch(spark, rd, md, f"{scratch}/silver")
    want = C.build_silver(spark, SF001)
    assert silver.count() == want.count()
    assert silver.select(*S.READINGS.names).exceptAll(want.select(*S.READINGS.names)).count() == 0
    counts = {r.source: r.row_count for r in flows.count_by_source(silver).collect()}
    assert counts["lcl"] < X.meter_raw(spark, SF001).count()   # 'Null' energy rows dropped

    faults = flows.detect_and_upsert(spark, silver, f"{scratch}/faults", "1", **PARAMS)
    emissions = detect_state.detect_frozen(want, **PARAMS)
    ref = detect_state.event_summary(emissions)
    assert faults.count() == ref.count() > 0
    assert faults.exceptAll(ref.select(*S.FAULTS.names)).count() == 0
    # an event stands at its start, not at its last emission
    opened = emissions.filter(F.col("fault_type").isNull()).select("event_id", "timestamp")
    assert faults.select("event_id", "timestamp").exceptAll(opened).count() == 0
    # the same batch again changes nothing; another one merges (same events -> same rows)
    for run in ("1", "2"):
        assert flows.detect_and_upsert(spark, silver, f"{scratch}/faults", run, **PARAMS).count() == ref.count()

    h = flows.health_batch(spark, silver, f"{scratch}/faults", f"{scratch}/health", "1 hour")
    assert h.count() == health.feeder_health(want, ref, "1 hour").count()
    assert h.filter(F.col("health_status") == "fault").count() > 0


def test_waveform_and_context_flows(spark, scratch):
    raw = X.waveform_raw(spark, SF001)
    long, wide = flows.waveform_batch(raw, f"{scratch}/long", f"{scratch}/wide")
    assert long.count() == 4 * wide.count() > 0
    context = flows.context_batch(X.context_raw(spark, SF001), f"{scratch}/context")
    assert context.columns == ["region", "period", "demand_mwh", "generation_mwh"] and context.count() > 0


def test_streaming_flow(spark, scratch):
    rd, md = _land(spark, scratch)
    q = flows.silver_stream(spark, rd, md, f"{scratch}/silver", f"{scratch}/ck_silver",
                            trigger={"availableNow": True})
    q.awaitTermination(300)
    silver = flows.read_silver(spark, f"{scratch}/silver")
    assert silver.count() == C.build_silver(spark, SF001).count()
    flows.detect_and_upsert(spark, silver, f"{scratch}/faults", "1", **PARAMS)
    q = flows.health_stream(spark, flows.read_silver(spark, f"{scratch}/silver", stream=True),
                            f"{scratch}/faults", f"{scratch}/health", f"{scratch}/ck_health", "1 hour",
                            trigger={"availableNow": True})
    q.awaitTermination(300)
    h = read_health(spark, f"{scratch}/health")
    assert h.count() > 0 and h.filter(F.col("health_status") == "fault").count() > 0
