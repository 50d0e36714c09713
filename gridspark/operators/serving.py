"""Serving questions (Q1-Q11) over the gold tables.

Every question takes an explicit ``as_of`` so answers are repeatable.
``as_of=None`` means "the newest time in the table", evaluated as a scalar
subquery (one small aggregate, inlined by Catalyst) -- never a driver
round-trip and never a cross join.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import latest_per


def _as_of(df: DataFrame, col: str, as_of) -> Column:
    if as_of is None:
        return df.select(F.max(col)).scalar()
    return F.lit(as_of).cast("timestamp")


def latest_fault_feeder(faults: DataFrame) -> DataFrame:
    """Q1: the feeder with the most recent fault (ties -> smallest id)."""
    return (faults.groupBy("feeder_id").agg(F.max("timestamp").alias("last_fault"))
                  .orderBy(F.col("last_fault").desc(), "feeder_id").limit(1))


def week_over_week(faults: DataFrame, as_of=None) -> DataFrame:
    """Faults this week vs last week (weeks start Monday).

    Events are first counted per day (map-side combined), so the final
    conditional sums run over one row per day."""
    day = F.date_trunc("day", F.col("timestamp"))
    daily = faults.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))
    ref = F.to_date(_as_of(faults, "timestamp", as_of))
    week = F.date_trunc("week", ref)
    prev = week - F.expr("INTERVAL 7 DAYS")
    return daily.agg(
        F.coalesce(F.sum(F.when(F.col("day") >= week, F.col("n"))), F.lit(0)).cast("long").alias("this_week"),
        F.coalesce(F.sum(F.when((F.col("day") >= prev) & (F.col("day") < week), F.col("n"))), F.lit(0))
         .cast("long").alias("last_week"))


def type_share(faults: DataFrame, as_of=None) -> DataFrame:
    """Percentage of classified faults per type on one day."""
    ref = F.to_date(_as_of(faults, "timestamp", as_of))
    counts = (faults.filter((F.to_date("timestamp") == ref) & F.col("fault_type").isNotNull())
                    .groupBy("fault_type").agg(F.count(F.lit(1)).alias("n")))
    # at most one row per fault type: an unpartitioned window over <= 2 rows
    return counts.select("fault_type",
                         (F.col("n") * F.lit(100.0) / F.sum("n").over(Window.partitionBy())).alias("pct"))


def unhealthy_feeders(health: DataFrame, as_of=None) -> DataFrame:
    """Q4: feeders in ``fault`` status in the newest window (of those that end by ``as_of``)."""
    seen = health if as_of is None else health.filter(F.col("window_end") <= as_of)
    newest = seen.select(F.max("window_end")).scalar()
    return (health.filter((F.col("health_status") == "fault") & (F.col("window_end") == newest))
                  .select("feeder_id"))


def last_fault_window(health: DataFrame):
    """The end of the newest window with a fault, as a scalar."""
    return health.filter(F.col("health_status") == "fault").select(F.max("window_end")).scalar()


def feeder_mean_voltage(health: DataFrame, feeder_id: str, as_of=None, lookback: str = "1 hour") -> DataFrame:
    """Q5: mean of window mean voltages of one feeder over the lookback."""
    ref = _as_of(health, "window_end", as_of)
    return (health.filter((F.col("feeder_id") == F.lit(feeder_id)) &
                          (F.col("window_start") >= ref - F.expr(f"INTERVAL {lookback}")))
                  .agg(F.avg("avg_voltage").alias("avg_voltage")))


def feeder_status_grid(health: DataFrame) -> DataFrame:
    """Q6: the newest window's row per feeder."""
    cols = ["feeder_id", "window_end", "health_status", "avg_voltage", "avg_current", "device_count"]
    return latest_per(health.select(*cols), "feeder_id", "window_end")


def feeder_series(health: DataFrame, feeders: Sequence[str] | None = None, start=None, end=None) -> DataFrame:
    """Q7: voltage/current series for chosen feeders in ``[start, end)``."""
    h = health
    if feeders:
        h = h.filter(F.col("feeder_id").isin(list(feeders)))
    stored = "day" in h.columns  # partitioned by day: only the range's folders are read
    if start is not None:
        start = F.lit(start).cast("timestamp")
        h = h.filter(F.col("window_start") >= start)
        h = h.filter(F.col("day") >= F.to_date(start)) if stored else h
    if end is not None:
        end = F.lit(end).cast("timestamp")
        h = h.filter(F.col("window_start") < end)
        h = h.filter(F.col("day") <= F.to_date(end)) if stored else h
    return h.select("window_start", "feeder_id", "avg_voltage", "avg_current").orderBy("feeder_id", "window_start")


def recent_faults(faults: DataFrame, n: int = 20) -> DataFrame:
    """Q8: the newest ``n`` events (a top-k: per-partition top-n, then merge)."""
    return (faults.select("timestamp", "feeder_id", "device_id", "fault_type", "confidence_score", "event_id")
                  .orderBy(F.col("timestamp").desc(), "event_id").limit(n))


def latest_device_fault(faults: DataFrame, device_id: str) -> DataFrame:
    """Q9: the newest event of one device."""
    return (faults.filter(F.col("device_id") == F.lit(device_id))
                  .orderBy(F.col("timestamp").desc(), "event_id").limit(1))


def latest_context(context: DataFrame) -> DataFrame:
    """Q10: the newest context row per region."""
    return latest_per(context.select("region", "period", "demand_mwh", "generation_mwh"), "region", "period")


def health_newest_first(health: DataFrame) -> DataFrame:
    """Q11: the feeder health table, newest window first."""
    return health.orderBy(F.col("window_end").desc(), "feeder_id")
