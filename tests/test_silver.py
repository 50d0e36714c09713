"""Silver operators: quality rules, meter derivation, renames, waveform."""
import math

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from gridspark import schemas as S
from gridspark.operators import quality, waveform


def _raw(spark, rows):
    return spark.createDataFrame(rows, S.READINGS_RAW)


def test_expect_or_drop_null_fails_nan_passes(spark):
    rows = [("a", "d", "f", "2024-01-01T00:00:00Z", 1.0, 1.0, 60.0, 0, "x", None, None),
            ("b", "d", "f", "2024-01-01T00:00:01Z", None, 1.0, 60.0, 0, "x", None, None),
            ("c", "d", "f", "2024-01-01T00:00:02Z", -5.0, 1.0, 60.0, 0, "x", None, None),
            (None, "d", "f", "2024-01-01T00:00:03Z", 2.0, 1.0, 60.0, 0, "x", None, None),
            ("e", "d", "f", "2024-01-01T00:00:04Z", float("nan"), 1.0, 60.0, 0, "x", None, None)]
    c = quality.clean_readings(_raw(spark, rows))
    kept = sorted(r.reading_id for r in quality.expect_or_drop(c).collect())
    assert kept == ["a", "e"]  # NaN > 0 is true in Spark, as in the reference
    rep = {r.rule: (r.failed_rows, r.total_rows, r.kept_rows) for r in quality.expectation_report(c).collect()}
    assert rep == {"valid_voltage": (2, 5, 2), "valid_reading_id": (1, 5, 2)}
    assert all(r.source == S.SYNTHETIC for r in c.collect())


def test_event_time_parsing(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:07Z",), ("2024-01-01 00:00:07.5",), ("junk",),
                                ("2012-10-12 00:30:00.0000000",)], "ts string")
    from gridspark.functions import to_event_time
    out = [r[0] for r in df.select(to_event_time("ts")).collect()]
    assert out[0].second == 7 and out[1].microsecond == 500000 and out[2] is None
    assert (out[3].minute, out[3].microsecond) == (30, 0)  # meter files carry 7 fraction digits
    num = spark.createDataFrame([(1.5,)], "ts double")
    assert num.select(to_event_time("ts", num.schema["ts"].dataType)).first()[0].microsecond == 500000


def test_meter_derivation_drops_unparsable_energy(spark):
    raw = spark.createDataFrame([("MAC1", "Std", "2012-01-01 00:30:00", "0.23"),
                                 ("MAC1", "Std", "2012-01-01 01:00:00", "Null")],
                                "LCLid string, stdorToU string, DateTime string, kwh_per_half_hour string")
    out = quality.derive_meter_readings(raw).collect()
    assert len(out) == 1
    r = out[0]
    assert r.reading_id == "lcl_MAC1_2012-01-01 00:30:00" and r.feeder_id == S.METER_FEEDER_ID
    assert math.isclose(r.current, 0.23 * 2 * 1000 / 230.0) and r.voltage == 230.0 and r.frequency == 50.0
    assert r.source == S.METER_SOURCE


def test_safe_columns(spark):
    df = spark.createDataFrame([(1, 2)], [S.METER_KWH_SOURCE_COLUMN, "a b(c)"])
    assert quality.safe_columns(df).columns == [S.METER_KWH_COLUMN, "a_b_c"]


def test_union_keeps_provenance(spark):
    a = spark.createDataFrame([], S.READINGS).unionByName(
        spark.createDataFrame([("r", "d", "f", None, 1.0, 1.0, 60.0, "synthetic")], S.READINGS))
    b = spark.createDataFrame([("m", "d2", "f", None, 230.0, 1.0, 50.0, "lcl")], S.READINGS)
    u = quality.unify_readings(a, b)
    assert {r.source: r.row_count for r in quality.source_counts(u).collect()} == {"synthetic": 1, "lcl": 1}


WAVE = StructType([
    StructField("base_name", StringType()), StructField("station_name", StringType()),
    StructField("microseconds", ArrayType(LongType())), StructField("analog", ArrayType(ArrayType(DoubleType()))),
    StructField("analog_channel_names", ArrayType(StringType()))])


def test_flatten_and_pivot_edge_cases(spark):
    rows = [("c1", "s", [0, 1000], [[1.0, 2.0, 3.0], [4.0, 5.0]], ["IA", "IB", "IC"]),   # ragged: null pad
            ("c2", "s", None, [[1.0]], ["IA"]),                                          # null array: no rows
            ("c3", "s", [], [], ["IA"]),                                                 # empty: no rows
            ("c4", "s", [5], [[9.0]], ["VA"]),                                           # unlisted channel only
            ("c5", "s", [7], [[1.0, 2.0]], ["IA", "IA"])]                                # duplicate name
    long = waveform.flatten_waveform(spark.createDataFrame(rows, WAVE))
    assert long.filter(F.col("event_id").isin("c2", "c3")).count() == 0
    assert long.filter(F.col("event_id") == "c1").count() == 6
    wide = {(r.event_id, r.ts.microsecond): r for r in waveform.pivot_channels(long).collect()}
    assert (wide[("c1", 1000)].IA, wide[("c1", 1000)].IB, wide[("c1", 1000)].IC) == (4.0, 5.0, None)
    assert (wide[("c4", 5)].IA, wide[("c4", 5)].IB) == (None, None)
    assert wide[("c5", 7)].IA == 1.0  # the lowest channel position wins
