"""S10/J2 on streams: the two files of a capture paired by keyed state.

A file waits in the state of its base name until its partner comes, in
whatever batch that is; no time range bounds the two.  With ``keep`` a
processing-time timer forgets a file whose partner has not come by then.
"""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

_WAITING = StructType([StructField("side", StringType()), StructField("content", BinaryType()), StructField("mod_us", LongType())])
_PAIR = StructType([StructField("base_name", StringType()), StructField("content_cfg", BinaryType()), StructField("cfg_us", LongType()),
                    StructField("content_dat", BinaryType()), StructField("dat_us", LongType())])


class PairProcessor(StatefulProcessor):
    """One base name: at most one file waits.  A file of the side that already
    waits replaces it (it was landed again)."""

    def __init__(self, keep_ms: int | None = None):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", _WAITING)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = tuple(self.waiting.get()) if self.waiting.exists() else None
        pairs = []
        for pdf in rows:
            for side, content, mod_us in zip(pdf["side"], pdf["content"], pdf["mod_us"]):
                if held is not None and held[0] != side:
                    files = {held[0]: (bytes(held[1]), int(held[2])), side: (bytes(content), int(mod_us))}
                    pairs.append((key[0], *files["cfg"], *files["dat"]))
                    held = None
                else:
                    held = (side, bytes(content), int(mod_us))
        if held is None:
            self.waiting.clear()
        else:
            self.waiting.update(held)
            if self.keep_ms is not None:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.keep_ms)
        if pairs:
            yield pd.DataFrame(pairs, columns=_PAIR.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.waiting.clear()
        return iter(())

    def close(self) -> None:
        pass


def pair_stream(cfg: DataFrame, dat: DataFrame, keep_ms: int | None = None) -> DataFrame:
    """Pairs of two streams (base_name, content, modificationTime), as they complete."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select("base_name", F.lit(name).alias("side"), "content", F.unix_micros("modificationTime").alias("mod_us"))
    pairs = side(cfg, "cfg").unionByName(side(dat, "dat")).groupBy("base_name").transformWithStateInPandas(
        PairProcessor(keep_ms), _PAIR, "Append", "None" if keep_ms is None else "ProcessingTime")
    return pairs.select("base_name", "content_cfg", F.timestamp_micros("cfg_us").alias("cfg_mod_time"),
                        "content_dat", F.timestamp_micros("dat_us").alias("dat_mod_time"))
