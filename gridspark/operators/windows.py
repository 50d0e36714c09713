"""Window-function building blocks (W1-W6) and per-key ordinal positions.

Ordering is always ``(ts, reading_id)`` so ties on ``ts`` are deterministic.

Per-device windows put a whole device in one task.  ``positions`` gives
every row its ordinal inside its key *without* such a window: rows are
counted per (key, time bucket), a prefix sum over the (much smaller) bucket
counts gives each bucket's offset, and ``row_number`` runs per (key,
bucket).  ``segments`` then cuts each key into fixed-size segments with a
halo of preceding rows so that bounded look-back windows (rolling
baselines, LAG) can run per segment -- a hot key is spread over many tasks.

``time_segments`` does the same without ordinals: only keys with more rows than
a segment are cut, at time buckets; rows find their range in a join by time
bucket and are shuffled by range when their windows are.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import safe_div

DEFAULT_ORDER = ("ts", "reading_id")


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def rolling_baseline(df: DataFrame, cols: Sequence[str] = ("voltage", "current"), n: int = 30,
                     keys: Sequence[str] = ("device_id",), order: Sequence[str] = DEFAULT_ORDER,
                     count_col: str = "baseline_n") -> DataFrame:
    """Mean, sample stddev and count over the ``n`` rows before each row."""
    w = Window.partitionBy(*keys).orderBy(*_cols(order)).rowsBetween(-n, -1)
    out = df
    for c in cols:
        out = (out.withColumn(f"{c}_mean", F.avg(c).over(w))
                  .withColumn(f"{c}_std", F.stddev_samp(c).over(w)))
    return out.withColumn(count_col, F.count(F.lit(1)).over(w))


def zscore(df: DataFrame, cols: Sequence[str] = ("voltage", "current"), out: str = "abs_z") -> DataFrame:
    """Largest absolute z over channels; zero sigma -> NULL, NULLs skipped."""
    zs = [F.abs(safe_div(F.col(c) - F.col(f"{c}_mean"), F.col(f"{c}_std"))) for c in cols]
    return df.withColumn(out, zs[0] if len(zs) == 1 else F.greatest(*zs))


def flag_anomalies(df: DataFrame, z: float = 6.0, min_n: int = 10,
                   cols: Sequence[str] = ("voltage", "current"), z_col: str = "abs_z",
                   count_col: str = "baseline_n", out: str = "is_anomalous") -> DataFrame:
    """Keep rows with a full-enough baseline and non-zero sigma on every
    channel, then flag ``z >= threshold`` as 1 else 0."""
    keep = F.col(count_col) >= F.lit(min_n)
    for c in cols:
        keep = keep & (F.col(f"{c}_std") > F.lit(0.0))
    return (df.filter(keep)
              .withColumn(out, F.when(F.col(z_col) >= F.lit(float(z)), 1).otherwise(0)))


def islands(df: DataFrame, flag: str = "is_anomalous", keys: Sequence[str] = ("device_id",),
            order: Sequence[str] = DEFAULT_ORDER, out: str = "event_seq") -> DataFrame:
    """Gaps-and-islands.  A run starts where the flag is 1 after a 0 (or
    at the start); the running sum of starts numbers the runs."""
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    start = F.when((F.col(flag) == 1) & (F.coalesce(F.lag(flag).over(w), F.lit(0)) == 0), 1).otherwise(0)
    return (df.withColumn("is_event_start", start)
              .withColumn(out, F.sum("is_event_start").over(w.rowsBetween(Window.unboundedPreceding, 0))))


def flagged_segments(df: DataFrame, n: int = 30, z: float = 6.0, min_n: int = 10, cols: Sequence[str] = ("voltage", "current"),
                     size: int = 1_000_000, key: str = "device_id", bucket_seconds: int = 60) -> DataFrame:
    """W1-W3 with every hot key split: each row's baseline, score and flag, and
    the time range ``seg`` it was worked on in (``time_segments``)."""
    cut = time_segments(df, n, size, (key,), bucket_seconds=bucket_seconds)
    scored = zscore(rolling_baseline(cut, cols, n, keys=(key, "seg")), cols)
    return flag_anomalies(scored.filter(~F.col("is_halo")).drop("is_halo"), z, min_n, cols)


def islands_of_segments(df: DataFrame, flag: str = "is_anomalous", key: str = "device_id", order: Sequence[str] = DEFAULT_ORDER,
                        out: str = "event_seq") -> DataFrame:
    """W4 over the time ranges ``seg`` of a key: runs are numbered within each
    range, and a row a range (its runs, its first and last flag) says how many
    came before it and whether its first run only goes on from there."""
    w = Window.partitionBy(key, "seg").orderBy(*_cols(order))
    place = F.struct(*order)
    own = (df.withColumn("_nth", F.row_number().over(w))
             .withColumn("_begins", F.when((F.col(flag) == 1) & (F.coalesce(F.lag(flag).over(w), F.lit(0)) == 0), 1).otherwise(0)))
    per = own.groupBy(key, "seg").agg(F.sum("_begins").alias("_n"), F.min_by(flag, place).alias("_head"), F.max_by(flag, place).alias("_tail"))
    by_key = Window.partitionBy(key).orderBy("seg")
    on = (F.col("_head") == 1) & (F.coalesce(F.lag("_tail").over(by_key), F.lit(0)) == 1)
    per = per.withColumn("_on", F.when(on, 1).otherwise(0))
    earlier = F.sum(F.col("_n") - F.col("_on")).over(by_key.rowsBetween(Window.unboundedPreceding, -1))
    per = per.select(F.struct(key, "seg").alias("_of"), "_on", F.coalesce(earlier, F.lit(0)).alias("_earlier"))
    runs = own.withColumn("_runs", F.sum("_begins").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.join(per, runs[key].eqNullSafe(F.col(f"_of.{key}")) & (runs["seg"] == F.col("_of.seg")))
    return (runs.withColumn("is_event_start", F.when((F.col("_nth") == 1) & (F.col("_on") == 1), 0).otherwise(F.col("_begins")))
                .withColumn(out, F.col("_earlier") + F.col("_runs") - F.col("_on"))
                .drop("_nth", "_begins", "_runs", "_of", "_on", "_earlier"))


def latest_per(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """The newest row per key.

    ``max_by`` over a struct is a plain aggregate, so it is combined
    map-side: a hot key never lands whole in one task."""
    keys = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in keys]
    picked = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(picked.alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


# --------------------------------------------------------------------------
# positions and segments: splitting a hot key over many tasks
# --------------------------------------------------------------------------

def positions(df: DataFrame, keys: Sequence[str] = ("device_id",), order: Sequence[str] = DEFAULT_ORDER,
              time_col: str = "ts", bucket_seconds: int = 3600, out: str = "pos") -> DataFrame:
    """0-based ordinal of each row inside its key, ordered by ``order``.

    ``order`` must start with ``time_col`` so that buckets are monotone.  Rows
    without a time come first, as in a window ordered by it; a null key is a
    key of its own.  No row is lost."""
    keys = list(keys)
    first = F.lit(-(1 << 62))  # the bucket of rows without a time
    bucket = F.floor(F.unix_micros(F.col(time_col)) / F.lit(bucket_seconds * 1_000_000)).cast("long")
    b = df.withColumn("_bucket", F.coalesce(bucket, first))
    counts = b.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_cnt"))
    wo = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.struct(*keys, "_bucket").alias("_key"), F.coalesce(F.sum("_cnt").over(wo), F.lit(0)).alias("_off"))
    wl = Window.partitionBy(*keys, "_bucket").orderBy(*_cols(order))
    local = b.withColumn("_rn", F.row_number().over(wl))
    same = F.lit(True)
    for k in [*keys, "_bucket"]:
        same = same & local[k].eqNullSafe(F.col(f"_key.{k}"))
    return (local.join(offsets, same, "inner")
                 .withColumn(out, (F.col("_off") + F.col("_rn") - 1).cast("long"))
                 .drop("_off", "_rn", "_bucket", "_key"))


def segments(df: DataFrame, halo: int, size: int, pos: str = "pos",
             seg: str = "seg", is_halo: str = "is_halo") -> DataFrame:
    """Assign ``seg = pos // size``; the last ``halo`` rows of each segment
    are copied into the next one with ``is_halo = true``."""
    if halo >= size:
        raise ValueError("segment size must exceed the halo")
    s = (F.col(pos) / F.lit(size)).cast("long")
    own = F.struct(s.alias("s"), F.lit(False).alias("h"))
    nxt = F.struct((s + 1).alias("s"), F.lit(True).alias("h"))
    copies = F.when(F.col(pos) % F.lit(size) >= F.lit(size - halo), F.array(own, nxt)).otherwise(F.array(own))
    return (df.withColumn("_c", F.explode(copies))
              .withColumn(seg, F.col("_c.s")).withColumn(is_halo, F.col("_c.h")).drop("_c"))


def time_segments(df: DataFrame, halo: int, size: int, keys: Sequence[str] = ("device_id",),
                  order: Sequence[str] = DEFAULT_ORDER, time_col: str = "ts", bucket_seconds: int = 60,
                  seg: str = "seg", is_halo: str = "is_halo") -> DataFrame:
    """Rows with the time range (``seg``, from 0 per key) they lie in, and the
    last ``halo`` rows of each range once more in the next, ``is_halo = true``.

    A key with at most ``size`` rows is one range.  Others are cut where the
    rows before a time bucket reach a further multiple of ``size``, so a range
    holds about ``size`` rows (one bucket at least) and never fewer than
    ``halo`` before another.  A row finds its range by its key and time bucket,
    in a join whose rows do not widen with the number of ranges; only the keys
    with more than ``size`` rows are broadcast.  The halo comes from the
    buckets at a range's end, and is a limit within (key, range), which tasks
    apply before they shuffle.  Rows without a time come first, a null key is a
    key of its own.  ``order`` begins with ``time_col``."""
    if halo >= size:
        raise ValueError("segment size must exceed the halo")
    size, keys = max(size, 2 * halo), list(keys)
    first = F.lit(-(1 << 62))  # the bucket of rows without a time
    bucket = F.coalesce(F.floor(F.unix_micros(F.col(time_col)) / F.lit(bucket_seconds * 1_000_000)).cast("long"), first)

    def same(left: DataFrame, names: Sequence[str]) -> Column:
        on = F.lit(True)
        for k in names:
            on = on & left[k].eqNullSafe(F.col(f"_of.{k}"))
        return on

    hot = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > size)
           .select(F.struct(*keys).alias("_of")))
    places = df.select(*keys, bucket.alias("_bucket"))
    counts = places.join(F.broadcast(hot), same(places, keys)).groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_bucket")
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    cuts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    cuts = cuts.withColumn("_multiple", F.floor(F.col("_before") / F.lit(size)))
    cuts = cuts.withColumn("_passed", F.col("_multiple") > F.coalesce(F.lag("_multiple").over(w), F.lit(0)))
    last_passed = F.last(F.when(F.col("_passed"), F.col("_before")), ignorenulls=True).over(earlier)
    near = F.col("_before") - F.coalesce(last_passed, F.lit(0)) < halo  # too few rows for the next one's halo
    cuts = cuts.withColumn("_cut", F.col("_passed") & ~near)
    nth = F.sum(F.when(F.col("_cut"), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    # rows before the next range, from the last bucket backwards: a frame that runs to the end is worked out anew for each row
    ahead = Window.partitionBy(*keys).orderBy(F.col("_bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    behind = F.min(F.when(F.col("_cut"), F.col("_before"))).over(ahead) - F.col("_before") - F.col("_n")
    ranges = (cuts.withColumn(seg, nth).withColumn("_ends", F.coalesce(behind < halo, F.lit(False)))
              .select(F.struct(*keys, "_bucket").alias("_of"), seg, "_ends"))
    plain, own = df.columns, df.withColumn("_bucket", bucket)
    rows = own.join(ranges.drop("_ends"), same(own, [*keys, "_bucket"]), "left").withColumn(seg, F.coalesce(seg, F.lit(0).cast("long")))
    mine = own.join(ranges.filter("_ends").drop("_ends"), same(own, [*keys, "_bucket"]))
    last = Window.partitionBy(*keys, seg).orderBy(*[c.desc() for c in _cols(order)])
    tail = mine.withColumn("_nth", F.row_number().over(last)).filter(F.col("_nth") <= halo).withColumn(seg, F.col(seg) + 1)
    return (rows.select(*plain, seg, F.lit(False).alias(is_halo))
            .unionByName(tail.select(*plain, seg, F.lit(True).alias(is_halo))))
