"""Silver-layer operators: typing, named quality rules, unit derivation,
provenance filters and the union of reading sources.

Everything is a narrow projection/filter, so Catalyst keeps it inside one
whole-stage-codegen span and pushes ``source``/time filters to the scan.
"""
from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import to_event_time

# The two drop rules on synthetic readings.
READING_RULES = {
    "valid_voltage": "voltage IS NOT NULL AND voltage > 0",
    "valid_reading_id": "reading_id IS NOT NULL",
}

# Characters table formats reject in column names (fixed value).
_UNSAFE = re.compile(r"[ ,;{}()\n\t=/]+")


def _double(c: str):
    return F.col(c).try_cast("double")


def clean_readings(raw: DataFrame, source: str = S.SYNTHETIC) -> DataFrame:
    """Project to the unified schema, parse ``ts``, cast the numeric
    channels and overwrite ``source``.  ``event_flag`` and the truth columns
    leave here."""
    ts_type = raw.schema["ts"].dataType
    return raw.select(
        F.col("reading_id").cast("string").alias("reading_id"),
        F.col("device_id").cast("string").alias("device_id"),
        F.col("feeder_id").cast("string").alias("feeder_id"),
        to_event_time("ts", ts_type).alias("ts"),
        _double("voltage").alias("voltage"),
        _double("current").alias("current"),
        _double("frequency").alias("frequency"),
        F.lit(source).alias("source"),
    )


def _rule(expr: str):
    # A NULL verdict counts as a failure, as in expect-or-drop.
    return F.coalesce(F.expr(expr), F.lit(False))


def expect_or_drop(df: DataFrame, rules: Mapping[str, str] = READING_RULES) -> DataFrame:
    """Keep only rows passing every named rule."""
    if not rules:
        return df
    return df.filter(reduce(lambda a, b: a & b, (_rule(r) for r in rules.values())))


def expectation_report(df: DataFrame, rules: Mapping[str, str] = READING_RULES) -> DataFrame:
    """One pass, one row per rule: rows failing it, rows seen, and rows
    passing all rules (what expect-or-drop keeps)."""
    all_pass = reduce(lambda a, b: a & b, (_rule(r) for r in rules.values()))
    aggs = [F.count(F.lit(1)).alias("total_rows"),
            F.count_if(all_pass).alias("kept_rows")]
    aggs += [F.count_if(~_rule(r)).alias(f"f_{i}") for i, r in enumerate(rules.values())]
    one = df.agg(*aggs)
    stack = ", ".join(f"'{name}', f_{i}" for i, name in enumerate(rules))
    return one.select(
        F.expr(f"stack({len(rules)}, {stack}) AS (rule, failed_rows)"),
        "total_rows", "kept_rows",
    )


def observe_expectations(df: DataFrame, rules: Mapping[str, str] = READING_RULES,
                         name: str = "expectations") -> DataFrame:
    """P3 on streams: attach per-rule failure counts as observed metrics
    (``query.lastProgress["observedMetrics"][name]``); rows pass unchanged."""
    metrics = [F.count(F.lit(1)).alias("total_rows")]
    metrics += [F.count_if(~_rule(r)).alias(f"failed_{n}") for n, r in rules.items()]
    return df.observe(name, *metrics)


REPORT = "rule string, failed_rows long, total_rows long, kept_rows long"


def expect_and_report(rules: Mapping[str, str], write_good, write_report):
    """P3 on streams, as a ``foreachBatch`` function: the rows of a micro-batch
    that pass every rule go to ``write_good(rows, batch_id)``; what the rules
    counted while they were written goes to ``write_report(report, batch_id)``
    as rows of ``REPORT``, a row a rule.  One pass over the batch.  A retried
    batch reports the same under the same id."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        kept = reduce(lambda a, b: a & b, (_rule(r) for r in rules.values()))
        metrics = [F.count(F.lit(1)).alias("total_rows"), F.count_if(kept).alias("kept_rows")]
        metrics += [F.count_if(~_rule(r)).alias(f"failed_{n}") for n, r in rules.items()]
        write_good(expect_or_drop(batch.observe(seen, *metrics), rules), batch_id)
        m = seen.get
        rows = [(n, m[f"failed_{n}"], m["total_rows"], m["kept_rows"]) for n in rules]
        write_report(batch.sparkSession.createDataFrame(rows, REPORT), batch_id)
    return fn


def total_report(reports: DataFrame) -> DataFrame:
    """The report of all batches together."""
    return reports.groupBy("rule").agg(*[F.sum(c).alias(c) for c in ("failed_rows", "total_rows", "kept_rows")])


def safe_columns(df: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Rename columns to storage-safe names.  Explicit mapping first
    (the meter kWh header), then any remaining unsafe character -> ``_``."""
    mapping = dict(mapping or {S.METER_KWH_SOURCE_COLUMN: S.METER_KWH_COLUMN})
    names = []
    for c in df.columns:
        n = mapping.get(c)
        if n is None:
            n = _UNSAFE.sub("_", c).strip("_") or c
        names.append(n)
    return df.toDF(*names)


def derive_meter_readings(raw: DataFrame, nominal_v: float = S.NOMINAL_METER_VOLTAGE,
                          frequency: float = S.METER_FREQUENCY,
                          feeder_id: str = S.METER_FEEDER_ID) -> DataFrame:
    """Half-hourly energy -> a current-like reading.

    ``I = kWh * 2 * 1000 / V`` (energy over half an hour -> mean power ->
    current at the nominal voltage).  Unparsable kWh (e.g. the text
    ``Null``) becomes NULL via ``try_cast`` and the row is dropped."""
    kwh = _double(S.METER_KWH_COLUMN)
    current = kwh * F.lit(2.0) * F.lit(1000.0) / F.lit(float(nominal_v))
    return raw.filter(kwh.isNotNull()).select(
        F.concat(F.lit("lcl_"), F.col("LCLid"), F.lit("_"), F.col("DateTime")).alias("reading_id"),
        F.col("LCLid").alias("device_id"),
        F.lit(feeder_id).alias("feeder_id"),
        to_event_time("DateTime").alias("ts"),
        F.lit(float(nominal_v)).alias("voltage"),
        current.alias("current"),
        F.lit(float(frequency)).alias("frequency"),
        F.lit(S.METER_SOURCE).alias("source"),
    )


def meter_row_loss(raw: DataFrame) -> DataFrame:
    """Bronze vs silver meter rows in one pass: rows whose energy does not
    parse (e.g. ``Null``) are the ones ``derive_meter_readings`` drops."""
    ok = _double(S.METER_KWH_COLUMN).isNotNull()
    return raw.agg(F.count(F.lit(1)).alias("bronze_rows"), F.count_if(ok).alias("silver_rows"),
                   F.count_if(~ok).alias("dropped_rows"))


def only_source(df: DataFrame, source: str = S.SYNTHETIC) -> DataFrame:
    """P5: provenance filter; pushed into the parquet scan / partition filter."""
    return df.filter(F.col("source") == F.lit(source))


def grid_context(raw: DataFrame) -> DataFrame:
    """The four context columns."""
    return raw.select("region", "period", "demand_mwh", "generation_mwh")


def health_status(fault_count) -> "F.Column":
    """``fault`` when any fault fell in the window, else ``healthy``."""
    c = F.col(fault_count) if isinstance(fault_count, str) else fault_count
    return F.when(c > 0, F.lit("fault")).otherwise(F.lit("healthy"))


def unify_readings(*frames: DataFrame) -> DataFrame:
    """Union by name; provenance stays in ``source``.  Works on batch and
    streaming frames alike."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def silver_readings(raw: DataFrame, meter_raw: DataFrame | None = None,
                    rules: Mapping[str, str] = READING_RULES) -> DataFrame:
    """Bronze -> unified silver readings: P1 + P2 on the synthetic feed,
    P4 on the meter feed, then U1."""
    synthetic = expect_or_drop(clean_readings(raw), rules)
    if meter_raw is None:
        return synthetic
    return unify_readings(synthetic, derive_meter_readings(meter_raw))


def source_counts(df: DataFrame) -> DataFrame:
    """Row counts per provenance."""
    return df.groupBy("source").agg(F.count(F.lit(1)).alias("row_count"))
