"""Explicit schemas of every layer.

Fixed values: column names, order and types below must equal the
reference's tables so that a user's data lands unchanged.
"""
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- fixed values: landed synthetic readings (bronze) -----------------------
READINGS_RAW = StructType([
    StructField("reading_id", StringType()),
    StructField("device_id", StringType()),
    StructField("feeder_id", StringType()),
    StructField("ts", StringType()),
    StructField("voltage", DoubleType()),
    StructField("current", DoubleType()),
    StructField("frequency", DoubleType()),
    StructField("event_flag", LongType()),
    StructField("source", StringType()),
    StructField("_fault_id", StringType()),
    StructField("_fault_type_truth", StringType()),
])

# --- fixed values: half-hourly household meter CSV (bronze) ------------------
# The source header of the energy column ends in a space and holds
# characters that table formats reject; it is renamed right after the read.
METER_KWH_SOURCE_COLUMN = "KWH/hh (per half hour) "
METER_KWH_COLUMN = "kwh_per_half_hour"
METER_RAW = StructType([
    StructField("LCLid", StringType()),
    StructField("stdorToU", StringType()),
    StructField("DateTime", StringType()),
    StructField(METER_KWH_SOURCE_COLUMN, StringType()),
])

# --- fixed values: waveform capture (bronze) ---------------------------------
WAVEFORM_RAW = StructType([
    StructField("base_name", StringType()),
    StructField("frequency", DoubleType()),
    StructField("rec_dev_id", StringType()),
    StructField("station_name", StringType()),
    StructField("microseconds", ArrayType(LongType())),
    StructField("analog", ArrayType(ArrayType(DoubleType()))),
    StructField("analog_units", ArrayType(StringType())),
    StructField("analog_channel_names", ArrayType(StringType())),
    StructField("_ingested_at", TimestampType()),
])

# --- fixed values: regional context (bronze) ---------------------------------
CONTEXT_RAW = StructType([
    StructField("region", StringType()),
    StructField("period", StringType()),
    StructField("demand_mwh", DoubleType()),
    StructField("generation_mwh", DoubleType()),
    StructField("_ingested_at", TimestampType()),
])

# --- fixed values: unified readings (silver) ----------------------------------
READINGS = StructType([
    StructField("reading_id", StringType()),
    StructField("device_id", StringType()),
    StructField("feeder_id", StringType()),
    StructField("ts", TimestampType()),
    StructField("voltage", DoubleType()),
    StructField("current", DoubleType()),
    StructField("frequency", DoubleType()),
    StructField("source", StringType()),
])

# --- fixed values: pivoted waveform (silver) ----------------------------------
WAVEFORM_WIDE = StructType([
    StructField("event_id", StringType(), False),
    StructField("ts", TimestampType(), False),
    StructField("station_name", StringType(), True),
    StructField("IA", DoubleType(), True),
    StructField("IB", DoubleType(), True),
    StructField("IC", DoubleType(), True),
])

# --- fixed values: fault classifications (gold) -------------------------------
FAULTS = StructType([
    StructField("event_id", StringType()),
    StructField("device_id", StringType()),
    StructField("feeder_id", StringType()),
    StructField("timestamp", TimestampType()),
    StructField("fault_type", StringType()),
    StructField("confidence_score", DoubleType()),
])

# the detector's emissions: an event's row and the reading it comes from
EMISSIONS = StructType([*FAULTS.fields, StructField("reading_id", StringType())])

# --- fixed values: fault schedule (intervals overlaid on readings) ------------
FAULT_SCHEDULE = StructType([
    StructField("fault_id", StringType()),
    StructField("device_id", StringType()),
    StructField("feeder_id", StringType()),
    StructField("fault_type", StringType()),
    StructField("start_time", TimestampType()),
    StructField("duration_s", DoubleType()),
    StructField("voltage_factor", DoubleType()),
    StructField("current_factor", DoubleType()),
    StructField("freq_offset_hz", DoubleType()),
])

# --- fixed values: reference defaults ---------------------------------------
TRANSIENT = "transient"
SUSTAINED = "sustained"
DEFAULT_WINDOW_SIZE = 30
DEFAULT_MIN_BASELINE_READINGS = 10
DEFAULT_Z_THRESHOLD = 6.0
DEFAULT_SUSTAINED_THRESHOLD_S = 5.0
CONFIDENCE_Z_FULL_SCALE = 20.0
NOMINAL_METER_VOLTAGE = 230.0
METER_FREQUENCY = 50.0
METER_FEEDER_ID = "feeder_lcl_reference"
SYNTHETIC = "synthetic"
METER_SOURCE = "lcl"
