"""Medallion layers as stored tables.

Silver readings, the gold fault table, the detector's emissions and feeder
health are written once per process, as Parquet folders under
``spark.checkpoint.dir``, and read back by every query that needs them -- as
the layered pipeline does -- instead of being derived again in each.  Silver
is partitioned by source and gold health by day, so that the detectors' and
the serving questions' filters prune whole folders.  The write
also cuts the lineage.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir

# (folder of the layers, name, input) -> path.  Paths hold a name made in this
# process, so jobs that run beside each other never share a folder.
_WRITTEN: dict[tuple[str, str, str], str] = {}


def materialized(spark: SparkSession, name: str, sf_dir: str, build: Callable[[], DataFrame],
                 partition_by: Sequence[str] = ()) -> DataFrame:
    root = checkpoint_dir(spark).rstrip("/")
    key = (root, name, sf_dir)
    if key not in _WRITTEN:
        path = f"{root}/gridspark-layers/{name}-{uuid.uuid4().hex}"
        w = build().write
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
        _WRITTEN[key] = path
    return spark.read.parquet(_WRITTEN[key])
