"""Appending readings to a landing folder.

The parquet sink pins the schema so a truth column that is all NULL in one
write is still typed string (a drifting type breaks incremental readers).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S

FORMATS = ("parquet", "jsonl", "json", "csv", "console")


def pinned(df: DataFrame) -> DataFrame:
    """Project onto the landed-readings schema (missing truth columns NULL)."""
    cols = []
    for f in S.READINGS_RAW.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def print_rows(df: DataFrame) -> None:
    """Every row as a line of JSON on the driver's output, a partition at a time."""
    for line in df.toJSON().toLocalIterator():
        print(line)


def write_readings(df: DataFrame, path: str | None = None, fmt: str = "parquet") -> None:
    """Append readings as parquet, JSON lines or CSV with a header; ``console``
    prints every row as JSON.  Any other format is an error."""
    fmt = fmt.lower()
    if fmt not in FORMATS:
        raise ValueError(f"unknown sink kind {fmt!r} (expected one of {', '.join(FORMATS)})")
    out = pinned(df)
    if fmt == "console":
        print_rows(out)
        return
    if path is None:
        raise ValueError("path is required for file sinks")
    w = out.write.mode("append")
    if fmt == "parquet":
        w.parquet(path)
    elif fmt in ("jsonl", "json"):
        w.json(path)
    else:
        w.option("header", True).csv(path)


def stream_readings(df: DataFrame, path: str | None, checkpoint: str, fmt: str = "parquet",
                    trigger: dict | None = None):
    """Streaming variant of ``write_readings`` (append; console prints)."""
    fmt = fmt.lower()
    if fmt not in FORMATS:
        raise ValueError(f"unknown sink kind {fmt!r}")
    out = pinned(df)
    w = out.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    if fmt == "console":
        return w.foreachBatch(lambda batch, _: print_rows(batch)).start()
    w = w.format("json" if fmt in ("jsonl", "json") else fmt)
    if fmt == "csv":
        w = w.option("header", True)
    return w.start(path)
