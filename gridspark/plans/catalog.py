"""Registered queries: Spark builders and their DuckDB oracles.

Every builder takes ``(spark, sf_dir)``, reads the driver's tables (through
the proxies) and returns a DataFrame over the whole tables.  Timestamps
are returned as ``timestamp_ntz`` and aggregated doubles rounded to 6
digits so that the comparison with DuckDB is exact.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, TimestampType

from .. import schemas as S
from ..operators import cohort, detect, detect_state, health, overlay, quality, serving, waveform
from ..sources import tables
from . import layers
from . import oracle as O
from . import proxies as X

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
FLAGSHIP = "d2_detect_frozen"

WIDTH = "1 hour"          # feeder windows on the proxy data
SERIES_FEEDERS = ["feeder_0", "feeder_1"]
SERIES_RANGE = ("2024-01-08 00:00:00", "2024-01-22 00:00:00")
Q5_FEEDER, Q5_LOOKBACK = "feeder_1", "6 hours"
Q9_DEVICE = "dev_3"
COHORT = dict(n=300, months=3)


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def naive(df: DataFrame, digits: int | None = None, round_cols=None) -> DataFrame:
    """Session-zone timestamps -> wall-clock ``timestamp_ntz`` (UTC session);
    optionally round the named (or all) double columns."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        elif digits is not None and isinstance(f.dataType, DoubleType) and (round_cols is None or f.name in round_cols):
            c = F.round(c, digits)
        out.append(c.alias(f.name))
    return df.select(*out)


def _r6(cols):
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


# ---------------------------------------------------------------- shared parts

def build_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.silver_readings(X.readings_raw(spark, sf_dir), X.meter_raw(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored silver readings table (built on first use)."""
    return layers.materialized(spark, "silver_readings", sf_dir, lambda: build_silver(spark, sf_dir),
                               partition_by=["source"])


def detect_faults(spark: SparkSession, sf_dir: str, strategy: str = "segmented",
                  segment_rows: int = 1_000_000) -> DataFrame:
    return detect.detect_windowed(silver(spark, sf_dir), z=O.Z, sustained_s=O.SUSTAINED_S,
                                  window=O.WINDOW, min_n=O.MIN_N, strategy=strategy,
                                  segment_rows=segment_rows, digits=6)


def faults_windowed(spark: SparkSession, sf_dir: str, strategy: str | None = None,
                    segment_rows: int = 1_000_000) -> DataFrame:
    """Gold fault classifications: detected with the given strategy, or the
    stored gold table when no strategy is asked for."""
    if strategy is not None:
        return detect_faults(spark, sf_dir, strategy, segment_rows)
    return layers.materialized(spark, "fault_classifications", sf_dir,
                               lambda: detect_faults(spark, sf_dir))


def detect_emissions(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return detect_state.detect_frozen(silver(spark, sf_dir), z=O.Z, sustained_s=O.SUSTAINED_S,
                                      window=O.WINDOW, min_n=O.MIN_N, **kw)


def emissions_frozen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored emissions: the walk runs once for all that read them."""
    return layers.materialized(spark, "emissions", sf_dir, lambda: detect_emissions(spark, sf_dir))


def build_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.feeder_health(silver(spark, sf_dir), faults_windowed(spark, sf_dir), WIDTH)


def feeder_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored gold feeder health, partitioned by ``day``."""
    return layers.materialized(spark, "feeder_health", sf_dir,
                               lambda: health.by_day(build_health(spark, sf_dir)).repartition("day"), ["day"])


FAULTS_SQL = (*O.BASE, O.DETECT_WINDOWED)
HEALTH_SQL = (*FAULTS_SQL, O.HEALTH)
HEALTH_COLS = ["avg_voltage", "avg_current", "avg_frequency"]

# ---------------------------------------------------------------- silver

@register("p1_clean_readings", O.with_ctes(O.READINGS_RAW, body="""
SELECT reading_id, device_id, feeder_id, TRY_CAST(ts AS TIMESTAMP) AS ts, voltage, "current", frequency,
       'synthetic' AS source FROM readings_raw"""))
def p1_clean_readings(spark, sf_dir):
    return naive(quality.clean_readings(X.readings_raw(spark, sf_dir)))


@register("p2_expect_or_drop", O.with_ctes(*O.BASE, body="SELECT * FROM silver_syn"))
def p2_expect_or_drop(spark, sf_dir):
    return naive(quality.expect_or_drop(quality.clean_readings(X.readings_raw(spark, sf_dir))))


@register("p3_expectation_report", O.with_ctes(O.READINGS_RAW, body="""
, c AS (SELECT coalesce(voltage IS NOT NULL AND voltage > 0, false) AS r1,
               coalesce(reading_id IS NOT NULL, false) AS r2 FROM readings_raw)
SELECT 'valid_voltage' AS rule, count(*) FILTER (WHERE NOT r1) AS failed_rows, count(*) AS total_rows,
       count(*) FILTER (WHERE r1 AND r2) AS kept_rows FROM c
UNION ALL
SELECT 'valid_reading_id', count(*) FILTER (WHERE NOT r2), count(*), count(*) FILTER (WHERE r1 AND r2) FROM c"""))
def p3_expectation_report(spark, sf_dir):
    return quality.expectation_report(quality.clean_readings(X.readings_raw(spark, sf_dir)))


@register("p3_stream_report", ORACLE["p3_expectation_report"])
def p3_stream_report(spark, sf_dir, slices: int = 3):
    """P3 on a stream: what each micro-batch's rules counted while its rows
    were written, stored by batch and summed."""
    from ..sources import landing
    base, run = scratch_folder(spark, "p3s"), tables.new_run()
    fn = quality.expect_and_report(
        quality.READING_RULES, lambda rows, i: tables.append_batch(rows, f"{base}/silver", run, i),
        lambda report, i: tables.append_batch(report, f"{base}/report", run, i))

    def query(landed):
        s = quality.clean_readings(landing.read_readings_stream(spark, landed).drop("_ingested_at"))
        (s.writeStream.foreachBatch(fn).option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True)
         .start().awaitTermination())

    _land_in_slices(spark, sf_dir, base, slices, query)
    return quality.total_report(spark.read.schema(quality.REPORT).parquet(f"{base}/report"))


@register("p4_meter_readings", O.with_ctes(*O.BASE, body="SELECT * FROM silver_lcl"))
def p4_meter_readings(spark, sf_dir):
    return naive(quality.derive_meter_readings(X.meter_raw(spark, sf_dir)))


@register("p4_meter_row_loss", O.with_ctes(O.METER_RAW, body="""
SELECT count(*) AS bronze_rows,
       count(*) FILTER (WHERE TRY_CAST(kwh_per_half_hour AS DOUBLE) IS NOT NULL) AS silver_rows,
       count(*) FILTER (WHERE TRY_CAST(kwh_per_half_hour AS DOUBLE) IS NULL) AS dropped_rows
FROM meter_raw"""))
def p4_meter_row_loss(spark, sf_dir):
    return quality.meter_row_loss(X.meter_raw(spark, sf_dir))


@register("p5_only_source", O.with_ctes(*O.BASE, body="SELECT * FROM silver WHERE source = 'lcl'"))
def p5_only_source(spark, sf_dir):
    return naive(quality.only_source(silver(spark, sf_dir), S.METER_SOURCE))


@register("p6_grid_context", O.with_ctes(O.CONTEXT_RAW, body="SELECT * FROM context_raw"))
def p6_grid_context(spark, sf_dir):
    return quality.grid_context(X.context_raw(spark, sf_dir))


@register("p7_safe_columns", O.with_ctes(O.METER_RAW, body="SELECT * FROM meter_raw"))
def p7_safe_columns(spark, sf_dir):
    landed = X.meter_raw(spark, sf_dir).withColumnRenamed(S.METER_KWH_COLUMN, S.METER_KWH_SOURCE_COLUMN)
    return quality.safe_columns(landed)


@register("u1_unified_readings", O.with_ctes(*O.BASE, body="SELECT * FROM silver"))
def u1_unified_readings(spark, sf_dir):
    return naive(build_silver(spark, sf_dir))


@register("a8_source_counts", O.with_ctes(*O.BASE, body="""
SELECT source, count(*) AS row_count FROM silver GROUP BY source"""))
def a8_source_counts(spark, sf_dir):
    return quality.source_counts(silver(spark, sf_dir))


@register("r1_flatten_waveform", O.with_ctes(O.WAVE_LONG, body="SELECT * FROM wave_long"))
def r1_flatten_waveform(spark, sf_dir):
    return naive(waveform.flatten_waveform(X.waveform_raw(spark, sf_dir)))


@register("r2_pivot_channels", O.with_ctes(O.WAVE_LONG, body="""
SELECT event_id, ts, station_name,
       arg_min(analog_value, channel_pos) FILTER (WHERE analog_channel_name = 'IA') AS IA,
       arg_min(analog_value, channel_pos) FILTER (WHERE analog_channel_name = 'IB') AS IB,
       arg_min(analog_value, channel_pos) FILTER (WHERE analog_channel_name = 'IC') AS IC
FROM wave_long WHERE analog_value IS NOT NULL AND station_name IS NOT NULL
GROUP BY event_id, ts, station_name"""))
def r2_pivot_channels(spark, sf_dir):
    return naive(waveform.pivot_channels(waveform.flatten_waveform(X.waveform_raw(spark, sf_dir))))


# ---------------------------------------------------------------- detection

def gappy_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic silver in which some readings lack a time and some a device."""
    r = quality.only_source(silver(spark, sf_dir))
    n = F.substring("reading_id", 3, 20).cast("long")
    return (r.withColumn("device_id", F.when(n % 103 != 0, F.col("device_id")))
             .withColumn("ts", F.when(n % 101 != 0, F.col("ts"))))


DETECTOR = dict(z=O.Z, sustained_s=O.SUSTAINED_S, window=O.WINDOW, min_n=O.MIN_N)


@register("d1_detect_windowed", O.with_ctes(*FAULTS_SQL, body="SELECT * FROM faults"))
def d1_detect_windowed(spark, sf_dir):
    return naive(detect_faults(spark, sf_dir))


@register("d1_detect_windowed_segmented", O.with_ctes(*FAULTS_SQL, body="SELECT * FROM faults"))
def d1_detect_windowed_segmented(spark, sf_dir):
    """D1 with small segments, so that every device is split."""
    return naive(detect_faults(spark, sf_dir, segment_rows=500))


@register("d1_detect_windowed_by_device", O.with_ctes(*FAULTS_SQL, body="SELECT * FROM faults"))
def d1_detect_windowed_by_device(spark, sf_dir):
    return naive(detect_faults(spark, sf_dir, "device"))


GAPPY_FAULTS = O.with_ctes(*O.GAPPY_BASE, O.DETECT_WINDOWED, body="SELECT * FROM faults")


@register("d1_gaps_segmented", GAPPY_FAULTS)
def d1_gaps_segmented(spark, sf_dir):
    """D1 over readings without times and devices, every device split."""
    return naive(detect.detect_windowed(gappy_silver(spark, sf_dir), segment_rows=100, digits=6, **DETECTOR))


@register("d1_gaps_by_device", GAPPY_FAULTS)
def d1_gaps_by_device(spark, sf_dir):
    return naive(detect.detect_windowed(gappy_silver(spark, sf_dir), strategy="device", digits=6, **DETECTOR))


GAPPY_FROZEN = O.with_ctes_rec(*O.GAPPY_BASE, O.DETECT_FROZEN, body="SELECT * FROM emissions")


@register("d2_gaps_segmented", GAPPY_FROZEN)
def d2_gaps_segmented(spark, sf_dir):
    """D2 over readings without times and devices, every device split."""
    return naive(detect_state.detect_frozen(gappy_silver(spark, sf_dir), segment_rows=400, **DETECTOR))


@register("d2_gaps_by_device", GAPPY_FROZEN)
def d2_gaps_by_device(spark, sf_dir):
    return naive(detect_state.detect_frozen(gappy_silver(spark, sf_dir), segment_rows=None, **DETECTOR))


def marked_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 rolling baseline -> W2 max |z| -> W3 filter and flag, per reading, every device split into time ranges."""
    from ..operators import windows as W
    r = quality.only_source(silver(spark, sf_dir)).select("reading_id", "device_id", "feeder_id", "ts", "voltage", "current")
    return W.flagged_segments(r, O.WINDOW, O.Z, O.MIN_N, size=500)


@register("w4_islands", O.with_ctes(*FAULTS_SQL, body=f"""
SELECT j.device_id, j.reading_id, CASE WHEN any_value(j.abs_z) >= {O.Z} THEN 1 ELSE 0 END AS is_anomalous,
       CAST(max(CASE WHEN r.first_n = j.n THEN 1 ELSE 0 END) AS INTEGER) AS is_event_start, count(r.first_n) AS event_seq
FROM judged j LEFT JOIN runs r ON r.device_id = j.device_id AND r.first_n <= j.n GROUP BY j.device_id, j.reading_id"""))
def w4_islands(spark, sf_dir):
    from ..operators import windows as W
    return W.islands_of_segments(marked_readings(spark, sf_dir)).select(
        "device_id", "reading_id", "is_anomalous", "is_event_start", F.col("event_seq").cast("long").alias("event_seq"))


W3_COLS = ["voltage_mean", "voltage_std", "current_mean", "current_std", "abs_z"]


@register("w3_flag_anomalies", O.with_ctes(*FAULTS_SQL, body=f"""
SELECT device_id, reading_id, baseline_n, {_r6(W3_COLS)}, CASE WHEN abs_z >= {O.Z} THEN 1 ELSE 0 END AS is_anomalous FROM usable"""))
def w3_flag_anomalies(spark, sf_dir):
    return naive(marked_readings(spark, sf_dir).select("device_id", "reading_id", "baseline_n", *W3_COLS, "is_anomalous"), 6)


@register(FLAGSHIP, O.with_ctes_rec(*O.BASE, O.DETECT_FROZEN, body="SELECT * FROM emissions"))
def d2_detect_frozen(spark, sf_dir):
    return naive(detect_emissions(spark, sf_dir))


@register("d2_detect_frozen_segmented", O.with_ctes_rec(*O.BASE, O.DETECT_FROZEN, body="SELECT * FROM emissions"))
def d2_detect_frozen_segmented(spark, sf_dir):
    """D2 with every device split into segments (the hot-device plan)."""
    return naive(detect_emissions(spark, sf_dir, segment_rows=500))


def state_store(spark: SparkSession) -> None:
    """The state store that the streaming detector needs, for the registered streams' session."""
    from ..streaming.detect import ROCKSDB
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _land_in_slices(spark, sf_dir, base, slices, run_slice):
    """Land the proxy readings in ``slices`` time slices under ``base``;
    call ``run_slice(landing_path)`` after each one (one micro-batch each)."""
    raw = X.readings_raw(spark, sf_dir)
    ts = F.col("ts").cast("timestamp")
    b = raw.select(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()
    span = (b.hi - b.lo) / slices if b.lo is not None else None
    for i in range(slices if span is not None else 1):
        cond = F.lit(True) if i == 0 else ts >= F.lit(b.lo + span * i)   # first slice: also NULL times
        if span is not None and i < slices - 1:
            cond = cond & (ts.isNull() | (ts < F.lit(b.lo + span * (i + 1))))
        raw.filter(cond).write.mode("append").parquet(f"{base}/landing")
        run_slice(f"{base}/landing")


@register("d3_detect_frozen_stream", O.with_ctes_rec(*O.BASE, O.DETECT_FROZEN, body="SELECT * FROM emissions"))
def d3_detect_frozen_stream(spark, sf_dir, slices: int = 4):
    """D3: the streaming detector run incrementally.  The proxy readings
    land in ``slices`` time slices; after each slice lands, one
    ``availableNow`` run of the same query (same checkpoint, so the
    per-device state carries over) consumes it as a micro-batch.  The
    emitted rows must equal D2's."""
    import uuid

    from ..session import checkpoint_dir
    from ..sources import landing
    from ..streaming.detect import detect_frozen_stream
    state_store(spark)
    base = f"{checkpoint_dir(spark).rstrip('/')}/gridspark-d3/{uuid.uuid4().hex}"
    state = {}

    def run(path):
        if "q" not in state:
            s = landing.read_readings_stream(spark, path, max_files_per_trigger=64).drop("_ingested_at")
            state["q"] = detect_frozen_stream(quality.expect_or_drop(quality.clean_readings(s)), z=O.Z,
                                              sustained_s=O.SUSTAINED_S, window=O.WINDOW, min_n=O.MIN_N)
        q = (state["q"].writeStream.format("parquet").option("checkpointLocation", f"{base}/ckpt")
             .trigger(availableNow=True).start(f"{base}/out"))
        q.awaitTermination()

    _land_in_slices(spark, sf_dir, base, slices, run)
    return naive(spark.read.schema(state["q"].schema).parquet(f"{base}/out"))


@register("d3_late_readings_stream", O.with_ctes_rec(*O.BASE, O.DETECT_FROZEN, body="SELECT * FROM emissions"))
def d3_late_readings_stream(spark, sf_dir, slices: int = 4):
    """D3 with a delay: a third of the readings land a slice or two after
    their time, and a last reading of another device moves the watermark past
    all of them.  Nothing is skipped: the emissions are D2's."""
    from ..sources import landing
    from ..streaming.detect import detect_frozen_stream
    state_store(spark)
    base, raw = scratch_folder(spark, "d3l"), X.readings_raw(spark, sf_dir)
    ts = F.col("ts").cast("timestamp")
    b = raw.select(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()
    if b.lo is None:
        return naive(detect_state.detect_frozen(build_silver(spark, sf_dir), **DETECTOR))
    span = (b.hi - b.lo) / slices
    delay = f"{int(3 * span.total_seconds()) + 1} seconds"
    nth = F.least(F.lit(slices - 1), F.floor((F.unix_micros(ts) - F.unix_micros(F.lit(b.lo))) / F.lit(span.total_seconds() * 1e6)))
    behind = F.when(F.pmod(F.hash("reading_id"), F.lit(3)) == 0, 1 + F.pmod(F.xxhash64("reading_id"), F.lit(2))).otherwise(0)
    raw = raw.withColumn("_slice", F.coalesce(nth + behind, F.lit(0)))
    last = spark.range(1).select(F.lit("last").alias("reading_id"), F.lit("clock").alias("device_id"), F.lit("none").alias("feeder_id"),
                                 F.lit(str(b.hi + 5 * span)).alias("ts"), F.lit(1.0).alias("voltage"), F.lit(1.0).alias("current"),
                                 F.lit(60.0).alias("frequency"), F.lit(0).cast("long").alias("event_flag"), F.lit(S.SYNTHETIC).alias("source"))
    for i in range(slices + 3):
        part = raw.filter(F.col("_slice") == i).drop("_slice") if i < slices + 2 else last
        part.write.mode("append").parquet(f"{base}/landing")
        s = landing.read_readings_stream(spark, f"{base}/landing").drop("_ingested_at")
        emits = detect_frozen_stream(quality.expect_or_drop(quality.clean_readings(s)), delay=delay, **DETECTOR)
        (emits.writeStream.format("parquet").option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True)
         .start(f"{base}/out").awaitTermination())
    return naive(spark.read.schema(emits.schema).parquet(f"{base}/out"))


@register("t4s_feeder_health_stream", O.with_ctes(*HEALTH_SQL, body=f"""
SELECT window_start, feeder_id, window_end, {_r6(HEALTH_COLS)}, device_count, fault_count, health_status
FROM health
WHERE window_end <= (SELECT max(ts) FROM silver WHERE source = 'synthetic') - INTERVAL 30 SECOND"""))
def t4s_feeder_health_stream(spark, sf_dir, slices: int = 4):
    """T1s-T4s: watermark (30 s), tumbling windows in append mode, exact
    distinct devices by chained aggregates, stream-static join with the
    gold fault table -- run incrementally over landed slices.  Only windows
    the watermark has closed are emitted."""
    import uuid

    from ..session import checkpoint_dir
    from ..sources import landing
    from ..streaming.gold import feeder_health_stream
    base = f"{checkpoint_dir(spark).rstrip('/')}/gridspark-t4s/{uuid.uuid4().hex}"
    faults = faults_windowed(spark, sf_dir)
    state = {}

    def run(path):
        if "q" not in state:
            s = landing.read_readings_stream(spark, path).drop("_ingested_at")
            state["q"] = feeder_health_stream(quality.expect_or_drop(quality.clean_readings(s)), faults,
                                              WIDTH, "30 seconds")
        q = (state["q"].writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start(f"{base}/out"))
        q.awaitTermination()

    _land_in_slices(spark, sf_dir, base, slices, run)
    return naive(spark.read.schema(state["q"].schema).parquet(f"{base}/out"), 6)


@register("d4_event_status", O.with_ctes_rec(*O.BASE, O.DETECT_FROZEN, O.EVENT_STATUS,
                                             body="SELECT * FROM statuses"))
def d4_event_status(spark, sf_dir):
    return naive(detect_state.event_status(emissions_frozen(spark, sf_dir)))


@register("j3_overlay_faults", O.with_ctes(*O.BASE, O.FAULT_SCHEDULE, O.ASOF_OVERLAY, body="""
SELECT reading_id, device_id, feeder_id, ts, source,
       CASE WHEN fid IS NOT NULL THEN voltage * voltage_factor ELSE voltage END AS voltage,
       CASE WHEN fid IS NOT NULL THEN "current" * current_factor ELSE "current" END AS "current",
       CASE WHEN fid IS NOT NULL THEN frequency + freq_offset_hz ELSE frequency END AS frequency,
       CAST(CASE WHEN fid IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS event_flag,
       fid AS _fault_id, CASE WHEN fid IS NOT NULL THEN ftype END AS _fault_type_truth
FROM overlaid"""))
def j3_overlay_faults(spark, sf_dir):
    syn = quality.only_source(silver(spark, sf_dir))
    return naive(overlay.overlay_faults(syn, X.fault_schedule(spark, sf_dir)))


@register("d5_score_detections", O.with_ctes(*FAULTS_SQL, O.FAULT_SCHEDULE, body="""
, hit AS (
  SELECT e.event_id, e.fault_type,
         CASE WHEN f.fault_id IS NOT NULL AND epoch_us(e."timestamp") <
              epoch_us(f.start_time) + CAST(round(f.duration_s * 1e6) AS BIGINT) THEN f.fault_id END AS fid,
         f.fault_type AS tt
  FROM faults e ASOF LEFT JOIN fault_schedule f ON e.device_id = f.device_id AND e."timestamp" >= f.start_time
)
SELECT (SELECT count(*) FROM fault_schedule) AS faults, count(DISTINCT fid) AS faults_detected,
       round(count(DISTINCT fid) / (SELECT count(*) FROM fault_schedule), 6) AS recall,
       count(*) AS events, count(*) FILTER (WHERE fid IS NULL) AS false_alarms,
       count(*) FILTER (WHERE fid IS NOT NULL AND fault_type = tt) AS type_agreement
FROM hit"""))
def d5_score_detections(spark, sf_dir):
    return detect_state.score_detections(faults_windowed(spark, sf_dir), X.fault_schedule(spark, sf_dir))


@register("d5_score_frozen", O.with_ctes_rec(*O.BASE, O.DETECT_FROZEN, O.FAULT_SCHEDULE, body="""
, ev AS (
  SELECT event_id, min("timestamp") AS "timestamp", any_value(device_id) AS device_id,
         arg_max(fault_type, ("timestamp", reading_id)) AS fault_type
  FROM emissions GROUP BY event_id
),
hit AS (
  SELECT e.event_id, e.fault_type,
         CASE WHEN f.fault_id IS NOT NULL AND epoch_us(e."timestamp") <
              epoch_us(f.start_time) + CAST(round(f.duration_s * 1e6) AS BIGINT) THEN f.fault_id END AS fid,
         f.fault_type AS tt
  FROM ev e ASOF LEFT JOIN fault_schedule f ON e.device_id = f.device_id AND e."timestamp" >= f.start_time
)
SELECT (SELECT count(*) FROM fault_schedule) AS faults, count(DISTINCT fid) AS faults_detected,
       round(count(DISTINCT fid) / (SELECT count(*) FROM fault_schedule), 6) AS recall,
       count(*) AS events, count(*) FILTER (WHERE fid IS NULL) AS false_alarms,
       count(*) FILTER (WHERE fid IS NOT NULL AND fault_type = tt) AS type_agreement
FROM hit"""))
def d5_score_frozen(spark, sf_dir):
    """D5 on the frozen detector's events (start = opening emission)."""
    events = detect_state.event_summary(emissions_frozen(spark, sf_dir))
    return detect_state.score_detections(events, X.fault_schedule(spark, sf_dir))


# ---------------------------------------------------------------- gold

@register("a1_feeder_windows", O.with_ctes(*HEALTH_SQL, body=f"""
SELECT window_start, window_end, feeder_id, {_r6(HEALTH_COLS)}, device_count FROM fw"""))
def a1_feeder_windows(spark, sf_dir):
    return naive(health.feeder_windows(silver(spark, sf_dir), WIDTH), 6)


@register("a3_fault_counts", O.with_ctes(*HEALTH_SQL, body="SELECT * FROM fc"))
def a3_fault_counts(spark, sf_dir):
    return naive(health.fault_counts(faults_windowed(spark, sf_dir), WIDTH))


@register("a2_feeder_health", O.with_ctes(*HEALTH_SQL, body=f"""
SELECT window_start, feeder_id, window_end, {_r6(HEALTH_COLS)}, device_count, fault_count, health_status
FROM health"""))
def a2_feeder_health(spark, sf_dir):
    return naive(build_health(spark, sf_dir), 6)


@register("a4_feeder_windows_approx", O.with_ctes(*HEALTH_SQL, body="""
SELECT window_start, feeder_id, device_count, true AS within_bound FROM fw"""))
def a4_feeder_windows_approx(spark, sf_dir):
    """A4: the approximate device count lies within its bound of the exact one."""
    return naive(health.approx_devices_within(silver(spark, sf_dir), WIDTH))


@register("a4_rollup", O.with_ctes(*HEALTH_SQL, body=f"""
SELECT window_start, window_end, feeder_id, {_r6(HEALTH_COLS)}, device_count, true AS within_bound FROM fw"""))
def a4_rollup(spark, sf_dir):
    """A4: sketches stored by the minute, hours rolled up from them; means are
    exact, device counts within three standard errors of the exact count."""
    path = f"{scratch_folder(spark, 'a4')}/minutes"
    health.window_sketches(silver(spark, sf_dir), "1 minute").write.parquet(path)
    hours = health.rollup_sketches(spark.read.parquet(path), WIDTH)
    exact = health.feeder_windows(silver(spark, sf_dir), WIDTH).select(*health.KEY, F.col("device_count").alias("exact"))
    near = F.abs(F.col("device_count") - F.col("exact")) <= F.greatest(F.lit(1.0), 3 * 0.016 * F.col("exact"))
    joined = hours.join(exact, health.KEY).withColumn("within_bound", near).withColumn("device_count", F.col("exact")).drop("exact")
    return naive(joined.select("window_start", "window_end", "feeder_id", *HEALTH_COLS, "device_count", "within_bound"), 6)


FROZEN_HEALTH = O.HEALTH.replace("FROM faults", "FROM starts")


@register("a2_feeder_health_frozen", O.with_ctes_rec(*O.BASE, O.DETECT_FROZEN, """
starts AS (SELECT event_id, min("timestamp") AS "timestamp", arg_min(feeder_id, ("timestamp", reading_id)) AS feeder_id
           FROM emissions GROUP BY event_id)""", FROZEN_HEALTH, body=f"""
SELECT window_start, feeder_id, window_end, {_r6(HEALTH_COLS)}, device_count, fault_count, health_status FROM health"""))
def a2_feeder_health_frozen(spark, sf_dir):
    """Feeder health over the frozen detector's events, counted where they start."""
    events = detect_state.event_summary(emissions_frozen(spark, sf_dir))
    return naive(health.feeder_health(silver(spark, sf_dir), events, WIDTH), 6)


@register("a9_cohort_sample", O.with_ctes(O.METER_RAW, body=f"""
, timed AS (SELECT *, TRY_CAST(DateTime AS TIMESTAMP) AS _t FROM meter_raw
            WHERE TRY_CAST(DateTime AS TIMESTAMP) IS NOT NULL
              AND block IS NOT NULL AND LCLid IS NOT NULL),
first_block AS (SELECT LCLid, min(block) AS block FROM timed GROUP BY LCLid),
chosen AS (SELECT * FROM first_block ORDER BY block, LCLid LIMIT {COHORT['n']}),
kept AS (SELECT * FROM timed WHERE (LCLid, block) IN (SELECT (LCLid, block) FROM chosen)),
starts AS (SELECT LCLid, min(_t) AS _start FROM kept GROUP BY LCLid)
SELECT LCLid, stdorToU, DateTime, kwh_per_half_hour, block, o_orderkey
FROM kept JOIN starts USING (LCLid) WHERE _t < _start + INTERVAL {COHORT['months']} MONTH"""))
def a9_cohort_sample(spark, sf_dir):
    return cohort.cohort_sample(X.meter_raw(spark, sf_dir), **COHORT)


@register("s8_upsert", O.with_ctes_rec(*FAULTS_SQL, O.DETECT_FROZEN, O.EVENT_STATUS, body="""
SELECT * FROM statuses
UNION ALL
SELECT * FROM faults WHERE event_id NOT IN (SELECT event_id FROM statuses)"""))
def s8_upsert(spark, sf_dir):
    target = faults_windowed(spark, sf_dir)
    updates = detect_state.event_status(emissions_frozen(spark, sf_dir))
    return naive(tables.upsert(target, updates, ["event_id"]))


# ---------------------------------------------------------------- serving

@register("q1_latest_fault_feeder", O.with_ctes(*FAULTS_SQL, body="""
SELECT feeder_id, max("timestamp") AS last_fault FROM faults
GROUP BY feeder_id ORDER BY last_fault DESC, feeder_id LIMIT 1"""))
def q1_latest_fault_feeder(spark, sf_dir):
    return naive(serving.latest_fault_feeder(faults_windowed(spark, sf_dir)))


@register("q2_week_over_week", O.with_ctes(*FAULTS_SQL, body="""
, ref AS (SELECT date_trunc('week', CAST(max("timestamp") AS DATE)) AS wk FROM faults)
SELECT CAST(coalesce(sum(CASE WHEN "timestamp" >= wk THEN 1 ELSE 0 END), 0) AS BIGINT) AS this_week,
       CAST(coalesce(sum(CASE WHEN "timestamp" >= wk - INTERVAL 7 DAY AND "timestamp" < wk THEN 1 ELSE 0 END), 0)
            AS BIGINT) AS last_week
FROM faults, ref"""))
def q2_week_over_week(spark, sf_dir):
    return serving.week_over_week(faults_windowed(spark, sf_dir))


@register("q3_type_share", O.with_ctes(*FAULTS_SQL, body="""
SELECT fault_type, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS pct FROM faults
WHERE CAST("timestamp" AS DATE) = (SELECT CAST(max("timestamp") AS DATE) FROM faults) AND fault_type IS NOT NULL
GROUP BY fault_type"""))
def q3_type_share(spark, sf_dir):
    return naive(serving.type_share(faults_windowed(spark, sf_dir)), 6)


@register("q3_type_share_frozen", O.with_ctes_rec(*O.BASE, O.DETECT_FROZEN, O.EVENT_STATUS, body="""
SELECT fault_type, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS pct FROM statuses
WHERE CAST("timestamp" AS DATE) = (SELECT CAST(max("timestamp") AS DATE) FROM statuses)
  AND fault_type IS NOT NULL
GROUP BY fault_type"""))
def q3_type_share_frozen(spark, sf_dir):
    """Q3 over the frozen detector's event statuses (open events, NULL type, excluded)."""
    statuses = detect_state.event_status(emissions_frozen(spark, sf_dir))
    return naive(serving.type_share(statuses), 6)


@register("q4_unhealthy_feeders", O.with_ctes(*HEALTH_SQL, body="""
SELECT feeder_id FROM health
WHERE health_status = 'fault' AND window_end = (SELECT max(window_end) FROM health WHERE health_status = 'fault')"""))
def q4_unhealthy_feeders(spark, sf_dir):
    """Q4 as of the last window with a fault."""
    h = feeder_health(spark, sf_dir)
    return serving.unhealthy_feeders(h, serving.last_fault_window(h))


@register("q5_feeder_mean_voltage", O.with_ctes(*HEALTH_SQL, body=f"""
SELECT round(avg(avg_voltage), 6) AS avg_voltage FROM health
WHERE feeder_id = '{Q5_FEEDER}' AND window_start >= (SELECT max(window_end) FROM health) - INTERVAL {Q5_LOOKBACK}"""))
def q5_feeder_mean_voltage(spark, sf_dir):
    return naive(serving.feeder_mean_voltage(feeder_health(spark, sf_dir), Q5_FEEDER, lookback=Q5_LOOKBACK), 6)


@register("q6_feeder_status_grid", O.with_ctes(*HEALTH_SQL, body="""
SELECT feeder_id, window_end, health_status, round(avg_voltage, 6) AS avg_voltage,
       round(avg_current, 6) AS avg_current, device_count FROM health
QUALIFY row_number() OVER (PARTITION BY feeder_id ORDER BY window_end DESC) = 1"""))
def q6_feeder_status_grid(spark, sf_dir):
    return naive(serving.feeder_status_grid(feeder_health(spark, sf_dir)), 6)


@register("q7_feeder_series", O.with_ctes(*HEALTH_SQL, body=f"""
SELECT window_start, feeder_id, round(avg_voltage, 6) AS avg_voltage, round(avg_current, 6) AS avg_current
FROM health WHERE feeder_id IN ({", ".join(f"'{f}'" for f in SERIES_FEEDERS)})
  AND window_start >= TIMESTAMP '{SERIES_RANGE[0]}' AND window_start < TIMESTAMP '{SERIES_RANGE[1]}'
ORDER BY feeder_id, window_start"""))
def q7_feeder_series(spark, sf_dir):
    return naive(serving.feeder_series(feeder_health(spark, sf_dir), SERIES_FEEDERS, *SERIES_RANGE), 6)


@register("q8_recent_faults", O.with_ctes(*FAULTS_SQL, body="""
SELECT "timestamp", feeder_id, device_id, fault_type, confidence_score, event_id FROM faults
ORDER BY "timestamp" DESC, event_id LIMIT 20"""))
def q8_recent_faults(spark, sf_dir):
    return naive(serving.recent_faults(faults_windowed(spark, sf_dir), 20))


@register("q9_latest_device_fault", O.with_ctes(*FAULTS_SQL, body=f"""
SELECT * FROM faults WHERE device_id = '{Q9_DEVICE}' ORDER BY "timestamp" DESC, event_id LIMIT 1"""))
def q9_latest_device_fault(spark, sf_dir):
    return naive(serving.latest_device_fault(faults_windowed(spark, sf_dir), Q9_DEVICE))


@register("q10_latest_context", O.with_ctes(O.CONTEXT_RAW, body="""
SELECT region, period, demand_mwh, generation_mwh FROM context_raw
QUALIFY row_number() OVER (PARTITION BY region ORDER BY period DESC) = 1"""))
def q10_latest_context(spark, sf_dir):
    return serving.latest_context(quality.grid_context(X.context_raw(spark, sf_dir)))


@register("q11_health_newest_first", O.with_ctes(*HEALTH_SQL, body=f"""
SELECT window_start, feeder_id, window_end, {_r6(HEALTH_COLS)}, device_count, fault_count, health_status
FROM health ORDER BY window_end DESC, feeder_id"""))
def q11_health_newest_first(spark, sf_dir):
    return naive(serving.health_newest_first(feeder_health(spark, sf_dir).drop("day")), 6)


# ---------------------------------------------------------------- landed files, tables and streams

def scratch_folder(spark: SparkSession, what: str) -> str:
    import uuid

    from ..session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/gridspark-{what}/{uuid.uuid4().hex}"


def land_meter(spark: SparkSession, sf_dir: str, base: str) -> str:
    """Meter rows as CSV, one folder ``meter_<block>.csv`` a block, under the original header."""
    rows = X.meter_raw(spark, sf_dir).drop("o_orderkey").withColumnRenamed(S.METER_KWH_COLUMN, S.METER_KWH_SOURCE_COLUMN)
    for block in range(X.N_METER_BLOCKS):
        rows.filter(F.col("block") == block).drop("block").write.option("header", True).csv(f"{base}/meter_{block}.csv")
    return f"{base}/*.csv"


READINGS_ALL = O.with_ctes(O.READINGS_RAW, body="""
SELECT *, CAST(NULL AS VARCHAR) AS _fault_id, CAST(NULL AS VARCHAR) AS _fault_type_truth FROM readings_raw""")


@register("s6_append_readings", READINGS_ALL)
def s6_append_readings(spark, sf_dir):
    """Two appends to a landing folder, read with the fixed schema and stamped."""
    from ..sources import landing, sinks
    base, raw = scratch_folder(spark, "s6"), X.readings_raw(spark, sf_dir)
    early = F.coalesce(F.pmod(F.hash("reading_id"), F.lit(2)) == 0, F.lit(True))
    for part in (raw.filter(early), raw.filter(~early).drop("_fault_id")):
        sinks.write_readings(part, f"{base}/landing")
    return landing.read_readings(spark, f"{base}/landing").filter(F.col("_ingested_at").isNotNull()).drop("_ingested_at")


@register("s7_text_sinks", READINGS_ALL)
def s7_text_sinks(spark, sf_dir):
    """JSON lines and CSV with a header, read back with the fixed schema."""
    from ..sources import sinks
    base, raw = scratch_folder(spark, "s7"), X.readings_raw(spark, sf_dir)
    early = F.coalesce(F.pmod(F.hash("reading_id"), F.lit(2)) == 0, F.lit(True))
    sinks.write_readings(raw.filter(early), f"{base}/json", "jsonl")
    sinks.write_readings(raw.filter(~early), f"{base}/csv", "csv")
    read = spark.read.schema(S.READINGS_RAW)
    return read.json(f"{base}/json").unionByName(spark.read.schema(S.READINGS_RAW).option("header", True).csv(f"{base}/csv"))


@register("s7_lines_sink", READINGS_ALL)
def s7_lines_sink(spark, sf_dir):
    """A sink of JSON lines that executors write and the driver commits by name, in batch and on a stream."""
    from ..sources import files, landing
    base, raw = scratch_folder(spark, "s7l"), X.readings_raw(spark, sf_dir)
    early = F.coalesce(F.pmod(F.hash("reading_id"), F.lit(2)) == 0, F.lit(True))
    files.write_lines(raw.filter(early), f"{base}/lines")
    raw.filter(~early).write.parquet(f"{base}/landing")
    s = landing.read_readings_stream(spark, f"{base}/landing").drop("_ingested_at")
    files.stream_lines(s, f"{base}/streamed", f"{base}/ckpt", {"availableNow": True}).awaitTermination()
    return files.read_lines(spark, f"{base}/lines", S.READINGS_RAW).unionByName(files.read_lines(spark, f"{base}/streamed", S.READINGS_RAW))


@register("s10_pair_files", """
SELECT concat('capture.', vec_id, '.v1') AS base_name, concat('label=', label) AS cfg,
       array_to_string([CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding], ',') AS dat FROM embeddings""")
def s10_pair_files(spark, sf_dir):
    """Both files of every capture, scanned as a stream of binary
    files; a third of the data files land a run after their partners."""
    from ..sources import files, landing
    state_store(spark)
    base, e = scratch_folder(spark, "s10"), X.table(spark, sf_dir, "embeddings")
    stem = F.concat(F.lit("capture."), F.col("vec_id").cast("string"), F.lit(".v1"))
    cfg = e.select(F.concat(stem, F.lit(".cfg")).alias("name"), F.concat(F.lit("label="), F.col("label").cast("string")).alias("content"))
    values = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("string"))
    dat = e.select(F.concat(stem, F.lit(".dat")).alias("name"), F.array_join(values, ",").alias("content"))
    late = F.pmod(F.hash("name"), F.lit(3)) == 0
    for part in (cfg.unionByName(dat.filter(~late)), dat.filter(late)):
        files.write_files(part, f"{base}/in").write.format("noop").mode("append").save()
        (landing.pair_files(spark, f"{base}/in", stream=True).writeStream.format("parquet").trigger(availableNow=True)
         .option("checkpointLocation", f"{base}/ckpt").start(f"{base}/out").awaitTermination())
    pairs = spark.read.schema("base_name string, content_cfg binary, content_dat binary").parquet(f"{base}/out")
    return pairs.select(F.element_at(F.split("base_name", "/"), -1).alias("base_name"),
                        F.col("content_cfg").cast("string").alias("cfg"), F.col("content_dat").cast("string").alias("dat"))


@register("s2_landed_meter", O.with_ctes(O.METER_RAW, body="SELECT LCLid, stdorToU, DateTime, kwh_per_half_hour, block FROM meter_raw"))
def s2_landed_meter(spark, sf_dir):
    """All landed CSV blocks in one scan, the block number from the path."""
    from ..sources import landing
    return landing.read_meter(spark, land_meter(spark, sf_dir, scratch_folder(spark, "s2"))).drop("_ingested_at")


@register("s4_unfed_source", O.with_ctes(*O.BASE, body="SELECT * FROM silver_syn"))
def s4_unfed_source(spark, sf_dir):
    """A source that never landed is an empty table, and silver is the other one."""
    from ..sources import landing
    meter = quality.safe_columns(landing.empty_table(spark, S.METER_RAW))
    return naive(quality.silver_readings(X.readings_raw(spark, sf_dir), meter))


@register("s9_reset_table", O.with_ctes(*FAULTS_SQL, body="SELECT * FROM faults"))
def s9_reset_table(spark, sf_dir):
    """Create, fill, truncate, and fill again by batches, the first one retried."""
    path, faults = f"{scratch_folder(spark, 's9')}/faults", faults_windowed(spark, sf_dir)
    tables.ensure_table(spark, path, S.FAULTS)
    tables.upsert_table(spark, path, faults.withColumn("device_id", F.lit("gone")), ["event_id"], S.FAULTS)
    tables.reset_table(spark, path, S.FAULTS)
    half = F.pmod(F.hash("event_id"), F.lit(2)) == 0
    run = tables.new_run()
    for batch, part in ((0, faults.filter(half)), (0, faults.filter(half)), (1, faults.filter(~half))):
        tables.upsert_table(spark, path, part, ["event_id"], S.FAULTS, run, batch)
    return naive(tables.read_table(spark, path, S.FAULTS))


@register("t5s_unified_stream", O.with_ctes(*O.BASE, body="SELECT * FROM silver"))
def t5s_unified_stream(spark, sf_dir):
    """T5s: both landing folders as streams, united and appended to silver."""
    from . import flows
    base = scratch_folder(spark, "t5s")
    X.readings_raw(spark, sf_dir).write.parquet(f"{base}/readings")
    flows.silver_stream(spark, f"{base}/readings", land_meter(spark, sf_dir, f"{base}/meter"), f"{base}/silver",
                        f"{base}/ckpt", {"availableNow": True}).awaitTermination()
    return naive(flows.read_silver(spark, f"{base}/silver"))


@register("t7s_upsert_stream", O.with_ctes_rec(*O.BASE, O.DETECT_FROZEN, O.EVENT_STATUS, body="SELECT * FROM statuses"))
def t7s_upsert_stream(spark, sf_dir, slices: int = 3):
    """T7s: the streaming detector's micro-batches merged into the keyed event
    table, then the log form of a table from one batch that holds every
    emission of every event; both show each event's last status."""
    from ..sources import keyed, landing
    from ..streaming.detect import detect_frozen_stream
    from ..streaming.gold import fresh_checkpoint, upsert_events_batch, upsert_keyed_batch
    state_store(spark)
    base, run = scratch_folder(spark, "t7s"), tables.new_run()
    checkpoint = fresh_checkpoint(base)

    def query(landed):
        s = landing.read_readings_stream(spark, landed, max_files_per_trigger=64).drop("_ingested_at")
        emits = detect_frozen_stream(quality.expect_or_drop(quality.clean_readings(s)), **DETECTOR)
        (emits.writeStream.foreachBatch(upsert_keyed_batch(f"{base}/keyed", run)).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())

    _land_in_slices(spark, sf_dir, base, slices, query)
    emissions = emissions_frozen(spark, sf_dir)
    tables.ensure_table(spark, f"{base}/log", emissions.schema)
    upsert_events_batch(f"{base}/log", run)(emissions, 0)
    stored = keyed.read_keyed(spark, f"{base}/keyed", S.EMISSIONS).drop("reading_id")
    logged = tables.read_table(spark, f"{base}/log", emissions.schema).drop("reading_id")
    # a status that only one of the two shows would be a row too many
    return naive(stored.union(logged.select(*stored.columns)).distinct())


@register("t8s_full_refresh", O.with_ctes_rec(*O.BASE, O.DETECT_FROZEN, O.EVENT_STATUS, body="""
SELECT 'silver' AS of_table, reading_id AS id, device_id, CAST(ts AS TIMESTAMP) AS at, CAST(NULL AS VARCHAR) AS status FROM silver
UNION ALL SELECT 'events', event_id, device_id, "timestamp", fault_type FROM statuses"""))
def t8s_full_refresh(spark, sf_dir):
    """T8s: land, stream silver and events, replace the landed files (the old
    ones vanish, some rows are new, some do not come again), refresh both."""
    from . import flows
    state_store(spark)
    base, raw = scratch_folder(spark, "t8s"), X.readings_raw(spark, sf_dir)
    readings, silver, events = f"{base}/readings", f"{base}/silver", f"{base}/events"
    meter = land_meter(spark, sf_dir, f"{base}/meter")
    some = F.coalesce(F.pmod(F.hash("reading_id"), F.lit(3)) > 0, F.lit(True))
    gone = raw.withColumn("reading_id", F.concat(F.lit("gone_"), "reading_id")).withColumn("device_id", F.lit("gone"))
    raw.filter(some).unionByName(gone).write.parquet(readings)
    now = {"availableNow": True}
    flows.silver_stream(spark, readings, meter, silver, f"{base}/ckpt-silver", now).awaitTermination()
    flows.events_stream(spark, flows.read_silver(spark, silver, stream=True), events, f"{base}/ckpt-events", now, **DETECTOR).awaitTermination()
    raw.write.mode("overwrite").parquet(readings)
    flows.refresh(flows.silver_stream, spark, silver, base, spark, readings, meter, silver)
    flows.refresh(flows.events_stream, spark, events, base, spark, flows.read_silver(spark, silver, stream=True), events, **DETECTOR)
    rows = flows.read_silver(spark, silver).select(
        F.lit("silver").alias("of_table"), F.col("reading_id").alias("id"), "device_id", F.col("ts").alias("at"), F.lit(None).cast("string").alias("status"))
    return naive(rows.union(flows.read_events(spark, events).select(F.lit("events"), "event_id", "device_id", "timestamp", "fault_type")))


@register("t7s_health_stream", ORACLE["t4s_feeder_health_stream"])
def t7s_health_stream(spark, sf_dir, slices: int = 3):
    """T7s: closed windows upserted by day, counts from the faults as they are
    at each batch -- empty at first, complete from the second on."""
    from ..streaming.gold import feeder_windows_stream, read_health, upsert_health_batch
    from ..sources import landing
    base, faults = scratch_folder(spark, "t7h"), faults_windowed(spark, sf_dir)
    seen = {"slices": 0}

    def run(landed):
        seen["slices"] += 1
        now = faults.limit(0) if seen["slices"] == 1 else faults
        s = landing.read_readings_stream(spark, landed).drop("_ingested_at")
        w = feeder_windows_stream(quality.expect_or_drop(quality.clean_readings(s)), WIDTH, "30 seconds")
        (w.writeStream.foreachBatch(upsert_health_batch(f"{base}/health", lambda _: now, WIDTH))
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start().awaitTermination())

    _land_in_slices(spark, sf_dir, base, slices, run)
    return naive(read_health(spark, f"{base}/health").drop("day"), 6)
