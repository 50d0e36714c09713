"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

import ctypes
import gc
import sys
import types
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.session import checkpoint_dir
from gridspark.sources.files import shared_uri

#: Bytes of UTF-8 that separate words in the ``[^\x20\x09-\x0D]+`` contracts;
#: ``bytes.split()`` without arguments splits on exactly these.
ASCII_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"

#: Largest number of 8-byte ids that a checked broadcast may hold (32 MB raw).
BROADCAST_IDS = 4_000_000


def run_dir(spark: SparkSession, what: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, shared by all executors,
    with the scheme that Spark resolves it to: tasks that open its files
    themselves then reach the same store."""
    return f"{shared_uri(spark, checkpoint_dir(spark)).rstrip('/')}/llm-{what}-{uuid.uuid4().hex}"


def stage(df: DataFrame, what: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the
    lineage ends at files that outlive any executor."""
    path = run_dir(df.sparkSession, what)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_or_shuffled(df: DataFrame, what: str, most_rows: int = BROADCAST_IDS) -> DataFrame:
    """``df``, written to the shared folder and marked for a broadcast if it
    has at most ``most_rows`` rows of a few bytes each; else the joins that
    use it shuffle."""
    staged = stage(df, what)
    return F.broadcast(staged) if staged.count() <= most_rows else staged


def filesystem(uri: str):
    """(pyarrow filesystem, path) of a folder or file in the shared folder.

    Plain paths and ``file:`` URIs are local mounts; other schemes go to the
    matching pyarrow filesystem."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def rows_in(batch: pa.RecordBatch, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``most_bytes`` each, one row at least."""
    n = batch.num_rows
    if not n:
        return
    step = max(1, int(n * most_bytes / max(batch.nbytes, 1)))
    for i in range(0, n, step):
        yield batch.slice(i, step)


def utf8(column: pa.Array) -> Iterator[bytes | None]:
    """The values of a string column as UTF-8 bytes, without decoding."""
    for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()):
        yield x.as_py()


class Recent:
    """A dictionary that holds at most ``most`` entries: when the younger half
    is full the older one goes; what is asked for grows young again."""

    def __init__(self, most: int):
        self.half, self.young, self.old = max(1, most // 2), {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def get_all(self, keys: list) -> list:
        """What is held of each key, None for others."""
        out = list(map(self.young.get, keys))
        if self.old:
            old = self.old
            for i, found in enumerate(out):
                if found is None and (found := old.get(keys[i])) is not None:
                    out[i] = found
                    self.put(keys[i], found)
        return out

    def put(self, key, value) -> None:
        if len(self.young) >= self.half:
            self.old, self.young = self.young, {}
        self.young[key] = value


def worker_cache() -> dict:
    """What tasks that follow each other in one Python worker may share."""
    held = sys.modules.setdefault("_gridspark_worker", types.ModuleType("_gridspark_worker"))
    return held.__dict__.setdefault("cache", {})


def trim() -> None:
    """Give what this Python worker has freed back to the system, for a
    worker that waits for its next task would keep it."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if give_back is not None:
        give_back(0)


def tidied(run):
    """The task ``run`` (batches to batches), followed by ``trim``."""
    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            trim()
    return tidy


def release_worker() -> None:
    """Drop what another operator's tasks have left in this Python worker."""
    worker_cache().clear()
    gc.collect()
    trim()
