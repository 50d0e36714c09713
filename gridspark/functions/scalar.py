"""Column expressions shared by the operators.  All are JVM built-ins."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..schemas import CONFIDENCE_Z_FULL_SCALE


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_event_time(c, dtype=None) -> Column:
    """ISO-8601 text (with or without a zone suffix such as ``Z``) or epoch
    seconds -> timestamp.  Unparsable text gives NULL, never an error."""
    c = col_of(c)
    if dtype is not None and isinstance(dtype, NumericType):
        return F.timestamp_micros(F.round(c.cast("double") * F.lit(1_000_000.0)).cast("long"))
    return F.try_to_timestamp(c.cast("string"))


def confidence(peak_z, full_scale: float = CONFIDENCE_Z_FULL_SCALE, digits: int | None = None) -> Column:
    """``least(1, z / full_scale)``; optionally rounded."""
    c = F.least(F.lit(1.0), col_of(peak_z) / F.lit(float(full_scale)))
    return F.round(c, digits) if digits is not None else c


def event_key(device_col, start_ts_col) -> Column:
    """Deterministic event id: md5 of ``device|start`` (start as text).

    Retries and re-runs give the same id, so upserts stay idempotent.  A null
    device or start stands as an empty text."""
    return F.md5(F.concat(F.coalesce(col_of(device_col), F.lit("")), F.lit("|"),
                          F.coalesce(col_of(start_ts_col).cast("string"), F.lit(""))))


def safe_div(num, den) -> Column:
    """num / den with a zero denominator giving NULL (ANSI ``/0`` raises)."""
    return col_of(num) / F.nullif(col_of(den), F.lit(0.0))
