"""URL filtering by a sorted digest array.

``build_index`` turns a rule table into sorted arrays of 64-bit xxhash keys
with the rules' full strings beside them, one file a range of keys, in the
shared folder.  ``filter_urls`` memory-maps the key arrays in each task,
probes every (host suffix, path prefix) of a URL by vectorised binary search
and confirms hits against the stored strings, so a collision of digests never
decides.
"""
from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filesystem, run_dir, stage

#: The rules of the registered query: (host, path, action).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

_MANIFEST = "file string, least decimal(20,0), most decimal(20,0), n long, path_chars array<int>"


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): the host stands after the first ``://`` up to ``/``,
    ``?``, ``#`` or the end, A-Z in lower case; the path follows it up to
    ``?``, ``#`` or the end.  Null or no ``://``: both empty."""
    if url is None:
        return "", ""
    rest = url.partition("://")[2]
    cut = min((i for i in (rest.find("?"), rest.find("#")) if i >= 0), default=len(rest))
    rest = rest[:cut]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def _write_shard(root: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        ctx = TaskContext.get()
        name = f"{ctx.partitionId():06d}-{ctx.taskAttemptId()}"
        rules = [(int(k) % 2**64, r, a, n) for k, r, a, n in zip(
            *(table.column(c).to_pylist() for c in ("key", "rule", "action", "path_chars")))]
        rules.sort(key=lambda x: (x[0], x[1]))
        texts = [r.encode() + b"\x00" + a.encode() for _, r, a, _ in rules]
        fs, path = filesystem(root)
        fs.create_dir(path, recursive=True)
        for suffix, array in (("key", np.array([x[0] for x in rules], "<u8")),
                              ("end", np.cumsum([len(t) for t in texts]).astype("<u8"))):
            with fs.open_output_stream(f"{path}/{name}.{suffix}") as out:
                out.write(array.tobytes())
        with fs.open_output_stream(f"{path}/{name}.txt") as out:
            out.write(b"".join(texts))
        from decimal import Decimal
        yield pa.RecordBatch.from_pylist(
            [{"file": name, "least": Decimal(rules[0][0]), "most": Decimal(rules[-1][0]), "n": len(rules),
              "path_chars": sorted({x[3] for x in rules})}],
            schema=pa.schema([("file", pa.string()), ("least", pa.decimal128(20, 0)),
                              ("most", pa.decimal128(20, 0)), ("n", pa.int64()),
                              ("path_chars", pa.list_(pa.int32()))]))
    return write


#: Rules that one task sorts and one file holds.
SHARD_RULES = 1_000_000


def build_index(rules: DataFrame, shard_rules: int = SHARD_RULES) -> dict:
    """Write the index of ``rules`` (host, path, action) and return its
    manifest: folder, shard files and the distinct lengths of rule paths.

    Rows with a null host, path or action are no rules; of equal (host, path)
    the smallest action counts.  A shard is a range of keys, of about
    ``shard_rules`` rules; the manifest holds one entry a shard, and the
    arrays themselves never pass through the driver."""
    spark = rules.sparkSession
    root = run_dir(spark, "urls")
    keyed = (rules.select("host", "path", "action").dropna()
             .groupBy(F.concat("host", "path").alias("rule"), F.char_length("path").alias("path_chars"))
             .agg(F.min("action").alias("action"))
             .withColumn("key", F.xxhash64("rule")))
    keyed = stage(keyed, "rules")
    shards = max(1, -(-keyed.count() // shard_rules))
    ranges = F.floor(F.shiftrightunsigned("key", 40) * shards / (1 << 24))
    parts = (keyed.withColumn("shard", ranges).repartition(shards, "shard").sortWithinPartitions("shard").drop("shard")
             .mapInArrow(_write_shard(root), _MANIFEST))
    found = parts.collect()  # one short row a shard
    return {"root": root, "files": [(r["file"], int(r["least"]), int(r["most"]), r["n"]) for r in found],
            "path_chars": sorted({n for r in found for n in r["path_chars"]})}


class _Shard:
    """One memory-mapped shard."""

    def __init__(self, root: str, name: str):
        fs, path = filesystem(root)
        self.key, self.end, self.text = (self._map(fs, f"{path}/{name}.{s}", t)
                                         for s, t in (("key", "<u8"), ("end", "<u8"), ("txt", "u1")))

    @staticmethod
    def _map(fs, path: str, dtype: str) -> np.ndarray:
        from pyarrow import fs as pafs
        if isinstance(fs, pafs.LocalFileSystem):
            return np.memmap(path, dtype, "r")
        with fs.open_input_file(path) as f, tempfile.NamedTemporaryFile(delete=False) as copy:
            copy.write(f.read())  # a task's own copy, gone from the folder at once
        mapped = np.memmap(copy.name, dtype, "r")
        os.unlink(copy.name)
        return mapped

    def find(self, keys: np.ndarray, rules: list[bytes]) -> list[bytes | None]:
        """The action of each rule string, None where it is not stored."""
        at = np.searchsorted(self.key, keys)
        hit = (at < len(self.key)) & (self.key[np.minimum(at, len(self.key) - 1)] == keys)
        out: list[bytes | None] = [None] * len(rules)
        for i in np.flatnonzero(hit):
            j = int(at[i])
            while j < len(self.key) and self.key[j] == keys[i]:  # equal digests stand side by side
                text = bytes(self.text[int(self.end[j - 1]) if j else 0:int(self.end[j])])
                stored, _, action = text.rpartition(b"\x00")
                if stored == rules[i]:
                    out[i] = action
                j += 1
        return out


def _probe(index: dict, url_col: str, default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        opened: dict[str, _Shard] = {}
        lengths = index["path_chars"]
        for batch in batches:
            parts = [split_url(u) for u in batch.column(url_col).to_pylist()]
            wanted: dict[bytes, None] = {}
            asked: list[list[bytes]] = []
            for host, path in parts:
                own = []
                labels = host.split(".") if host else []
                for i in range(len(labels)):
                    suffix = ".".join(labels[i:])
                    own += [(suffix + path[:n]).encode() for n in lengths if n <= len(path)]
                asked.append(own)
                wanted.update(dict.fromkeys(own))
            rules = list(wanted)
            keys = np.array([xxhash.xxh64_intdigest(r, seed=42) for r in rules], "u8")
            actions: dict[bytes, bytes] = {}
            for file, least, most, _ in index["files"]:
                if len(near := np.flatnonzero((keys >= least) & (keys <= most))):
                    shard = opened[file] = opened.get(file) or _Shard(index["root"], file)
                    some = [rules[i] for i in near]
                    actions |= {r: a for r, a in zip(some, shard.find(keys[near], some)) if a is not None}
            best = [max((r for r in own if r in actions), key=lambda r: (len(r), r), default=None) for own in asked]
            out = pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in parts], pa.string()), pa.array([p[1] for p in parts], pa.string()),
                 pa.array([None if r is None else r.decode() for r in best], pa.string()),
                 pa.array([default if r is None else actions[r].decode() for r in best], pa.string())],
                ["host", "path", "rule", "verdict"])
            yield pa.RecordBatch.from_arrays([batch.column(0), *out.columns], ["id", *out.schema.names])
    return run


def filter_urls(urls: DataFrame, index: dict, id_col: str, url_col: str, default: str = "allow") -> DataFrame:
    """``id_col``, host, path, rule and verdict of every row of ``urls``.

    A rule fits its host and all subdomains where the URL's path starts with
    the rule's path; the longest rule string wins and gives the verdict, and
    without one the verdict is ``default`` with a null rule.  Null URLs and
    URLs without ``://`` have an empty host and path and fit no rule.  Rows
    are judged one by one: null ids, repeated rows and empty tables pass
    through, other columns are not read.  One narrow pass, no shuffle."""
    kind = urls.schema[id_col].dataType.simpleString()
    return (urls.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
            .mapInArrow(_probe(index, "url", default), f"id {kind}, host string, path string, rule string, verdict string")
            .withColumnRenamed("id", id_col))
