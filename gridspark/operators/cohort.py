"""Per-household cohort sample over numbered file blocks.

Households are taken in the order of the block where they first have a row
whose time parses, inside a block by id (file row order is not defined in
Spark), until ``n`` are taken; a taken household keeps its rows of that block,
for ``months`` months from its own first reading there.

Spark form: one aggregate per (household, block) gives each household's first
block and start; the ``n`` smallest join the rows once.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import to_event_time


def block_number(path_col: str = "_metadata.file_path", pattern: str = r"_(\d+)\.csv(?:/|$)"):
    """The numeric block suffix of a landed file's (or folder's) name."""
    return F.regexp_extract(F.col(path_col), pattern, 1).try_cast("int")


def cohort_sample(raw: DataFrame, n: int = 300, months: int = 3, max_blocks: int | None = None,
                  id_col: str = "LCLid", time_col: str = "DateTime", block_col: str = "block") -> DataFrame:
    """The sampled rows.  ``n`` is the sample's size; ``max_blocks`` limits it
    to the first so many block numbers.  Rows without a household, a block or
    a time that parses are in no cohort."""
    timed = raw.withColumn("_t", to_event_time(time_col))
    if max_blocks is not None:
        blocks = raw.select(block_col).filter(F.col(block_col).isNotNull()).distinct().orderBy(block_col).limit(max_blocks)
        timed = timed.join(blocks, on=block_col, how="left_semi")
    timed = timed.filter(F.col("_t").isNotNull() & F.col(block_col).isNotNull() & F.col(id_col).isNotNull())
    first = timed.groupBy(id_col, block_col).agg(F.min("_t").alias("_start"))
    first = first.groupBy(id_col).agg(F.min(F.struct(block_col, "_start")).alias("_f"))
    chosen = (first.select(F.col(id_col).alias("_id"), F.col(f"_f.{block_col}").alias("_block"), F.col("_f._start").alias("_start"))
              .orderBy("_block", "_id").limit(n))
    rows = timed.join(chosen, (timed[id_col] == chosen["_id"]) & (timed[block_col] == chosen["_block"]))
    cutoff = F.col("_start") + F.make_ym_interval(F.lit(0), F.lit(months))
    return rows.filter(F.col("_t") < cutoff).select(*raw.columns)
