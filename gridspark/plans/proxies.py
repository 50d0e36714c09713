"""Bronze-shaped inputs derived from the driver's tables.

The test data carries no grid telemetry, so each bronze table is a
deterministic projection of a driver table (see FIXTURES.md).  Every row of
the source table is kept (the fault schedule is the table's ``error`` events); ``%`` only derives device/feeder names and
channel values, it never filters.  The same definitions in DuckDB's dialect
live in ``plans/oracle.py``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import ensure_conf

# Fixed values of the proxies (FIXTURES.md section 3-4).
N_DEVICES = 8
N_FEEDERS = 4
N_METER_BLOCKS = 12
WAVEFORM_CHANNELS = ["IA", "IB", "IC", "VA"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_conf(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c):
    return F.col(c).cast("string")


def readings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed synthetic readings, READINGS_RAW schema (truth columns NULL)."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    voltage = (F.when(eid % 97 == 0, F.lit(None).cast("double"))
               .when(eid % 89 == 0, -F.col("value"))
               .otherwise(F.col("value")))
    return ev.select(
        F.concat(F.lit("r_"), _s("event_id")).alias("reading_id"),
        F.concat(F.lit("dev_"), (F.col("user_id") % N_DEVICES).cast("string")).alias("device_id"),
        F.concat(F.lit("feeder_"), (F.col("user_id") % N_FEEDERS).cast("string")).alias("feeder_id"),
        _s("ts").alias("ts"),
        voltage.alias("voltage"),
        F.get_json_object("props", "$.k").try_cast("double").alias("current"),
        F.round(F.lit(60.0) + ((eid % 7) - 3) / F.lit(100.0), 4).alias("frequency"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).cast("long").alias("event_flag"),
        F.lit(S.SYNTHETIC).alias("source"),
        F.lit(None).cast("string").alias("_fault_id"),
        F.lit(None).cast("string").alias("_fault_type_truth"),
    )


def meter_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-hourly meter rows after the header rename; ``block`` stands for
    the number in the landed file name."""
    o = table(spark, sf_dir, "orders")
    kwh = (F.when(F.col("o_orderkey") % 250 == 0, F.lit("Null"))
           .otherwise(F.round(F.col("o_totalprice") / F.lit(100000.0), 3).cast("string")))
    return o.select(
        F.concat(F.lit("MAC"), _s("o_custkey")).alias("LCLid"),
        F.lit("Std").alias("stdorToU"),
        _s("o_orderdate").alias("DateTime"),
        kwh.alias(S.METER_KWH_COLUMN),
        (F.col("o_orderkey") % N_METER_BLOCKS).cast("int").alias("block"),
        F.col("o_orderkey"),
    )


def context_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regional demand/generation per region and month."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = (o.join(c, o.o_custkey == c.c_custkey)
         .join(n, F.col("c_nationkey") == n.n_nationkey)
         .join(r, F.col("n_regionkey") == r.r_regionkey))
    period = F.date_format(F.date_trunc("month", F.col("o_orderdate")), "yyyy-MM-dd'T'HH:mm:ss")
    return (j.groupBy(F.col("r_name").alias("region"), period.alias("period"))
            .agg(F.round(F.sum("o_totalprice"), 2).alias("demand_mwh"),
                 F.round(F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))
                               .otherwise(F.lit(0.0))), 2).alias("generation_mwh"))
            .withColumn("_ingested_at", F.lit(None).cast("timestamp")))


def waveform_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One capture per embedding: its values in rows of 4 channels, a row a time step."""
    e = table(spark, sf_dir, "embeddings")
    nch = len(WAVEFORM_CHANNELS)
    n = F.floor(F.size("embedding") / nch).cast("int")
    steps = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    micros = F.transform(steps, lambda i: (F.col("vec_id") * F.lit(1_000_000) + i * F.lit(1000)).cast("long"))
    analog = F.transform(steps, lambda i: F.transform(
        F.slice(F.col("embedding"), i * nch + 1, nch), lambda x: x.cast("double")))
    return e.select(
        F.concat(F.lit("cap_"), _s("vec_id")).alias("base_name"),
        F.lit(60.0).alias("frequency"),
        F.lit(None).cast("string").alias("rec_dev_id"),
        F.concat(F.lit("st_"), _s("label")).alias("station_name"),
        micros.alias("microseconds"),
        analog.alias("analog"),
        F.array(*[F.lit("A") for _ in WAVEFORM_CHANNELS]).alias("analog_units"),
        F.array(*[F.lit(c) for c in WAVEFORM_CHANNELS]).alias("analog_channel_names"),
        F.lit(None).cast("timestamp").alias("_ingested_at"),
    )


def fault_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known fault intervals: one per ``error`` event."""
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    eid = F.col("event_id")
    return ev.select(
        F.concat(F.lit("f_"), _s("event_id")).alias("fault_id"),
        F.concat(F.lit("dev_"), (F.col("user_id") % N_DEVICES).cast("string")).alias("device_id"),
        F.concat(F.lit("feeder_"), (F.col("user_id") % N_FEEDERS).cast("string")).alias("feeder_id"),
        F.when(eid % 10 < 7, F.lit(S.TRANSIENT)).otherwise(F.lit(S.SUSTAINED)).alias("fault_type"),
        F.col("ts").cast("timestamp").alias("start_time"),
        (F.lit(60.0) * (F.lit(1) + eid % 30)).cast("double").alias("duration_s"),
        F.lit(0.5).alias("voltage_factor"),
        F.lit(3.0).alias("current_factor"),
        F.lit(0.1).alias("freq_offset_hz"),
    )
