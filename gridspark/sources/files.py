"""Whole files written by executors, and a sink of lines with commit.

``write_files`` turns rows (name, content) into files of a shared folder.
``LinesSink`` is a data source for ``df.write.format("gridspark_lines")`` and
its streaming twin: tasks write the rows as JSON lines, the driver only commits
the names of the files that count, so that a task that is repeated leaves no
line twice and nothing passes through the driver.  ``read_lines`` reads them.
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType


def open_folder(uri: str):
    """(pyarrow filesystem, path) of a folder that all executors share."""
    from pyarrow import fs
    found, path = (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)
    found.create_dir(path, recursive=True)
    return found, path


def shared_uri(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that Spark resolves it to."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()


def write_files(df: DataFrame, folder: str) -> DataFrame:
    """Write each row (name string, content binary) as a file of ``folder``;
    returns (name, size) of the files, which are written when it is read.  A
    repeated task writes the same files again."""
    uri = shared_uri(df.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(uri)
        for batch in batches:
            names, sizes = batch.column("name").to_pylist(), []
            for name, content in zip(names, batch.column("content")):
                raw = content.as_buffer()
                with fs.open_output_stream(f"{path}/{name}") as out:
                    out.write(raw if raw is not None else b"")
                sizes.append(0 if raw is None else raw.size)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["name", "size"])
    return df.select(F.col("name").cast("string"), F.col("content").cast("binary")).mapInArrow(run, "name string, size long")


@dataclass
class Written(WriterCommitMessage):
    """The file of a task, and how many lines it has."""
    file: str
    lines: int


class _LinesWriter(DataSourceArrowWriter):
    def __init__(self, uri: str, overwrite: bool = False):
        self.uri, self.overwrite = uri, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, path = open_folder(self.uri)
        name, n = f"lines-{uuid.uuid4().hex}.json", 0
        with fs.open_output_stream(f"{path}/{name}") as out:
            for batch in iterator:
                for row in batch.to_pylist():
                    out.write(json.dumps(row, default=str).encode() + b"\n")
                    n += 1
        return Written(name, n)

    def _commit(self, messages, name: str) -> None:
        fs, path = open_folder(self.uri)
        fs.create_dir(f"{path}/commits", recursive=True)
        with fs.open_output_stream(f"{path}/commits/{name}.json") as out:
            for m in messages:
                if m is not None and m.lines:
                    out.write(json.dumps({"file": m.file, "lines": m.lines}).encode() + b"\n")

    def commit(self, messages) -> None:
        self._commit(messages, uuid.uuid4().hex)

    def abort(self, messages) -> None:
        """Files that no commit names count for nothing."""


class _LinesStreamWriter(_LinesWriter, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId: int) -> None:
        self._commit(messages, f"batch-{batchId:012d}")  # a repeated batch replaces its commit

    def abort(self, messages, batchId: int) -> None:
        """Files that no commit names count for nothing."""


class LinesSink(DataSource):
    """JSON lines written by executors; option ``path`` is a shared folder's URI."""

    @classmethod
    def name(cls) -> str:
        return "gridspark_lines"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _LinesWriter(self.options["path"], overwrite)

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _LinesStreamWriter(self.options["path"], overwrite)


def write_lines(df: DataFrame, folder: str) -> None:
    """Append the rows of ``df`` to the lines of ``folder``."""
    spark = df.sparkSession
    spark.dataSource.register(LinesSink)
    df.write.format(LinesSink.name()).mode("append").option("path", shared_uri(spark, folder)).save()


def stream_lines(df: DataFrame, folder: str, checkpoint: str, trigger: dict | None = None):
    """The streaming twin of ``write_lines``; returns the running query."""
    spark = df.sparkSession
    spark.dataSource.register(LinesSink)
    w = (df.writeStream.format(LinesSink.name()).outputMode("append").option("path", shared_uri(spark, folder))
         .option("checkpointLocation", checkpoint))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def read_lines(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The committed lines of ``folder``; one that does not exist has none."""
    folder = folder.rstrip("/")
    try:
        commits = spark.read.schema("file string, lines long").json(f"{folder}/commits")
        rows = spark.read.schema(schema).option("pathGlobFilter", "lines-*.json").json(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    named = commits.select(F.col("file").alias("_file")).distinct()
    rows = rows.withColumn("_of", F.col("_metadata.file_name"))
    return rows.join(named, rows["_of"] == named["_file"], "left_semi").drop("_of")
