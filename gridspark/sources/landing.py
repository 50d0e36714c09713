"""Reading landed files with fixed schemas.

Schemas are always explicit: inference fails on an empty landing folder and
drifts when a column is all NULL in one file.  Streaming readers start
cleanly on an empty folder.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas as S
from ..operators.cohort import block_number
from ..operators.quality import safe_columns


def with_ingest_ts(df: DataFrame, col: str = "_ingested_at") -> DataFrame:
    """S3: stamp the ingest time."""
    return df.withColumn(col, F.current_timestamp())


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    """A schema-only table so readers of an unfed source do not fail."""
    return spark.createDataFrame([], schema)


def read_readings(spark: SparkSession, path: str, stream: bool = False,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed synthetic readings (parquet), batch or incremental."""
    r = spark.readStream if stream else spark.read
    r = r.schema(S.READINGS_RAW)
    if stream and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_ingest_ts(r.parquet(path))


def read_readings_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    return read_readings(spark, path, True, max_files_per_trigger)


def read_meter(spark: SparkSession, path: str, stream: bool = False, with_block: bool = True,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Half-hourly meter CSV with a header, all strings; the energy
    header is renamed to a storage-safe name; ``block`` is the number in
    the file name (``..._<N>.csv``)."""
    r = spark.readStream if stream else spark.read
    r = r.schema(S.METER_RAW).option("header", True)
    if stream and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = safe_columns(r.csv(path))
    if with_block:
        df = df.withColumn("block", block_number())
    return with_ingest_ts(df)


def read_meter_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    return read_meter(spark, path, True, True, max_files_per_trigger)


#: The columns of Spark's binary file source, which a stream must be told.
_BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def pair_files(spark: SparkSession, path: str, left_glob: str = "*.cfg", right_glob: str = "*.dat",
               stream: bool = False, keep_ms: int | None = None) -> DataFrame:
    """Pair the two files of one capture by base name.

    Each side is a binary-file scan filtered by glob; the base name is the
    folder and the file name up to its last dot, so that names with dots of
    their own stay apart.  ``stream=True`` keeps a file as state until its
    partner arrives, however late; ``keep_ms`` bounds that in processing time
    (``streaming/pairs.py``)."""
    def side(glob: str) -> DataFrame:
        r = (spark.readStream if stream else spark.read).schema(_BINARY_FILE)
        df = r.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
        return df.select(F.regexp_replace("path", r"\.[^./]*$", "").alias("base_name"), "content", "modificationTime")
    cfg, dat = side(left_glob), side(right_glob)
    if stream:
        from ..streaming.pairs import pair_stream
        return pair_stream(cfg, dat, keep_ms)
    tagged = [df.select("base_name", F.col("content").alias(f"content_{tag}"), F.col("modificationTime").alias(f"{tag}_mod_time"))
              for df, tag in ((cfg, "cfg"), (dat, "dat"))]
    return tagged[0].join(tagged[1], "base_name")
