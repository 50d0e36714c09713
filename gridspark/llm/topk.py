"""Exact top-k search by inner product.

Queries are packed into blocks of rows in the shared folder; every task walks
its candidates in tiles, multiplies each tile with each query block, selects
the k best of the tile for each query, and the per-query lists are merged in
a tree, ``FAN_IN`` lists a node.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filesystem, run_dir

#: Candidate rows a tile and query rows a block.
TILE, BLOCK = 4096, 1024
#: Lists that meet in one node of the merge tree.
FAN_IN = 32


def scaled(vectors: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(id, v): ``floor(scale * x)`` of every component as long.  Vectors that
    are null, empty or hold a null or non-finite component are left out, rows
    with a null id too."""
    x = F.col(vec_col)
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return (vectors.filter(F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0) & fine)
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v")))


def _matrix(batch: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) of the batch's rows, one pair a vector length."""
    ids = batch.column("id").to_numpy(zero_copy_only=False)
    v = batch.column("v")
    sizes = pc.list_value_length(v).to_numpy(zero_copy_only=False)
    flat = v.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = []
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        out.append((ids[at], flat[starts[at][:, None] + np.arange(d)]))
    return out


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer products: in floating point while every partial sum stays
    an exact double, else in 64-bit integers."""
    most = float(np.abs(q.astype(float)).max()) * float(np.abs(x.astype(float)).max()) * q.shape[1]
    if most < 2**53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    if most < 2**62:
        return q @ x.T
    exact = q.astype(object) @ x.astype(object).T
    if max(abs(int(exact.max())), abs(int(exact.min()))) >= 2**63:
        raise ValueError("an inner product does not fit a 64-bit integer")
    return exact.astype(np.int64)


def _query_blocks(files: list[str]) -> Iterator[pa.RecordBatch]:
    """The queries, ``BLOCK`` rows at a time, from the shared folder."""
    import pyarrow.parquet as pq
    for uri in files:
        fs, path = filesystem(uri)
        with fs.open_input_file(path) as f:
            yield from pq.ParquetFile(f).iter_batches(BLOCK)


def _tiles(batches: Iterator[pa.RecordBatch], tile: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for i in range(0, batch.num_rows, tile):
            yield from _matrix(batch.slice(i, tile))


def _partial(files: list[str], k: int, tile: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _tiles(batches, tile):
            order = np.argsort(ids, kind="stable")  # ties go to the smaller id: the earlier column
            ids, x = ids[order], x[order]
            for block in _query_blocks(files):
                for qids, q in _matrix(block):
                    if q.shape[1] == x.shape[1]:
                        yield _best(qids, ids, _products(q, x), k)
    return run


def _best(qids: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> pa.RecordBatch:
    """The k best columns of each row by (score descending, column), without
    the columns that hold the row's own id."""
    width = len(ids)
    lo = np.searchsorted(ids, qids, "left")
    n_own = np.searchsorted(ids, qids, "right") - lo
    rows = np.repeat(np.arange(len(qids)), n_own)
    cols = np.repeat(lo - np.concatenate([[0], np.cumsum(n_own)[:-1]]), n_own) + np.arange(len(rows))
    own = np.zeros(score.shape, bool)
    own[rows, cols] = True
    m = min(width, k)
    if max(abs(int(score.max())), abs(int(score.min()))) < 2**62 // width:
        key = score * width - np.arange(width)  # no two equal in a row: partial selection settles ties too
        key[own] = np.iinfo(np.int64).min
        c = np.argpartition(key, width - m, axis=1)[:, width - m:] if m < width else np.tile(np.arange(width), (len(qids), 1))
        c = np.take_along_axis(c, np.argsort(-np.take_along_axis(key, c, 1), axis=1), 1)
    else:
        c = np.stack([np.lexsort((np.arange(width), -score[i].astype(object), own[i]))[:m] for i in range(len(qids))])
    r = np.repeat(np.arange(len(qids)), m)
    c = c.ravel()
    fine = ~own[r, c]
    r, c = r[fine], c[fine]
    return pa.RecordBatch.from_arrays([pa.array(qids[r]), pa.array(ids[c]), pa.array(score[r, c])],
                                      ["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, queries: DataFrame, k: int, tile: int = TILE) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row of ``queries`` (id, v)
    the k rows of ``vectors`` (id, v) with the largest inner product, all if
    fewer, ties to the smaller id.

    A candidate with the query's own id is no candidate; repeated query ids
    with the same vector count once, repeated candidate rows each stand for
    themselves; only vectors of the same length meet.  Empty inputs give an
    empty result.  The queries are written to the shared folder and read back
    in blocks by every task: the memory of a task is one tile and one block
    whatever the sizes, and no row of either side is shuffled; what is
    shuffled are the partial lists, merged ``FAN_IN`` at a time."""
    spark = vectors.sparkSession
    root = run_dir(spark, "queries")
    queries.select("id", "v").dropDuplicates().write.option("compression", "zstd").parquet(root)
    files = sorted(spark.read.parquet(root).inputFiles())
    partial = vectors.select("id", "v").mapInArrow(_partial(files, k, tile), "query_id long, vec_id long, score long")
    # the tree's nodes are (query, lane): tasks make the lists of the leaves' lanes
    lists = partial.select("query_id", (F.spark_partition_id() % FAN_IN**2).alias("lane"),
                           F.array(F.struct((-F.col("score")).alias("neg"), F.col("vec_id"))).alias("best"))
    lists = _merge(lists.withColumn("lane", (F.col("lane") / FAN_IN).cast("int")), k)
    lists = _merge(lists.withColumn("lane", F.lit(0)), k)
    return (lists.select("query_id", F.posexplode("best").alias("pos", "b"))
            .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"),
                    (-F.col("b.neg")).alias("score")))


def _merge(lists: DataFrame, k: int) -> DataFrame:
    merged = F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k)
    return lists.groupBy("query_id", "lane").agg(merged.alias("best"))
