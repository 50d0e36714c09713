"""Token-ID output: one concatenated id array, Elias-Fano document boundaries.

Documents are range-partitioned by id, every partition tokenises its texts
and writes one shard: ``<shard>.ids`` holds the ids one after another as
little-endian integers of 2 or 4 bytes, ``<shard>.ef`` the boundaries of the
documents and their sorted doc_ids, both as Elias-Fano sequences with select
samples (about 2 + log2(length / documents) bits a document).  A manifest of
shards, in order, commits the set; offsets across shards are prefix sums of
its counts, so no task ever sees more than a shard.
"""
from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridspark.sources.files import shared_uri

from .common import Recent, filesystem, rows_in, run_dir, stage, tidied, worker_cache
from .words import binary_array, gather, text_buffers, with_each

#: Parts whose ids a Python worker remembers, about 130 MB.
CACHE_PARTS = 700_000
#: Parts that the library encodes in one call.
LIBRARY_PARTS = 4096
#: Longer parts are encoded anew each time.
CACHE_BYTES = 64
#: Bytes of text tokenised at a time.
SLICE_BYTES = 2 << 20
#: One select sample every so many ones.
SAMPLE = 512

_HEAD = "<4sBxxxQQQ"


# ---- Elias-Fano ----------------------------------------------------------

class EliasFano:
    """A non-decreasing sequence of integers from 0: low bits packed, high
    bits in unary, and every ``SAMPLE``-th one's position for select."""

    def __init__(self, n: int, top: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.top, self.low_bits, self.low, self.high, self.samples = n, top, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> "EliasFano":
        v = np.asarray(values, np.uint64)
        n, top = len(v), int(v[-1]) if len(v) else 0
        bits = min(56, max(0, (top // n).bit_length() - 1)) if n else 0  # with 7 bits of shift they fit 64
        low = np.zeros(0, np.uint8)
        if bits:
            low = np.packbits(((v[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8),
                              bitorder="little")
        ones = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        flags[ones] = 1
        # positions fit 32 bits: the unary part has two bits a value at most on top of the shard's rows
        return cls(n, top, bits, low, np.packbits(flags, bitorder="little"), ones[::SAMPLE].astype("<u4"))

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.int64)
        padded = np.concatenate([self.low, np.zeros(8, np.uint8)])
        bit = i.astype(np.int64) * self.low_bits
        out = np.zeros(len(i), np.uint64)
        for k in range(8):  # the 64 bits from the value's first byte
            out |= padded[(bit >> 3) + k].astype(np.uint64) << np.uint64(8 * k)
        return ((out >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def select(self, i: int) -> int:
        """The i-th value: from the nearest sample, count ones by bytes."""
        pos = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        if left:
            byte = pos >> 3
            seen = int(np.bitwise_count(self.high[byte] >> np.uint8(pos & 7)))
            if seen <= left:  # the one asked for stands in a later byte
                step = 256
                byte += 1
                while True:
                    counts = np.cumsum(np.bitwise_count(self.high[byte:byte + step]), dtype=np.int64)
                    if seen + int(counts[-1]) > left:
                        k = int(np.searchsorted(counts, left - seen, "right"))
                        seen += int(counts[k - 1]) if k else 0
                        byte += k
                        break
                    seen += int(counts[-1])
                    byte += step
                ones = np.flatnonzero(np.unpackbits(self.high[byte:byte + 1], bitorder="little"))
                pos = 8 * byte + int(ones[left - seen])
            else:
                ones = np.flatnonzero(np.unpackbits(self.high[byte:byte + 1], bitorder="little"))
                pos = 8 * byte + int(ones[ones >= (pos & 7)][left])
        return ((pos - i) << self.low_bits) + int(self._lows(np.array([i]))[0])

    def decode(self) -> np.ndarray:
        """All values."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        i = np.arange(self.n)
        return ((ones - i) << self.low_bits) + self._lows(i)

    def dump(self) -> bytes:
        parts = (self.low.tobytes(), self.high.tobytes(), self.samples.tobytes())
        return struct.pack("<QQBQQQ", self.n, self.top, self.low_bits, *map(len, parts)) + b"".join(parts)

    @classmethod
    def load(cls, raw: memoryview, at: int) -> tuple["EliasFano", int]:
        n, top, bits, *sizes = struct.unpack_from("<QQBQQQ", raw, at)
        at += struct.calcsize("<QQBQQQ")
        arrays = []
        for size, kind in zip(sizes, ("u1", "u1", "<u4")):
            arrays.append(np.frombuffer(raw[at:at + size], kind))
            at += size
        return cls(n, top, bits, *arrays), at


# ---- tokenising ------------------------------------------------------------

class Encoder:
    """Texts to ids through a ``tokenizers`` file, by parts where that is exact.

    With a byte-level pre-tokenizer and its usual pattern the ids of a text are
    those of parts between which no pre-token can reach (``_cuts``).  All texts
    of a column are cut at once and the library encodes each distinct part once;
    ids are gathered by the parts' dictionary codes.  Texts that hold white
    space beyond ASCII or a string of an added token are encoded whole, and with
    any other tokenizer all texts are."""

    def __init__(self, path: str, width: int):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to Spark's tasks
        from tokenizers import Tokenizer

        self.tk = Tokenizer.from_file(path)
        said = json.loads(self.tk.to_str())
        pre, model = said["pre_tokenizer"] or {}, said["model"]
        self.by_part = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
                        and said["normalizer"] is None and not model.get("dropout") and said["truncation"] is None
                        and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or not t["content"]
                                    for t in said["added_tokens"]))
        self.whole = re.compile(b"|".join([*_WIDE_SPACE, *(re.escape(t["content"].encode()) for t in said["added_tokens"])]))
        self.kind, self.code = {2: ("<u2", "H"), 4: ("<u4", "I")}[width]
        self.parts = Recent(CACHE_PARTS)

    def _library(self, parts: list[bytes]) -> list[bytes]:
        coded = self.tk.encode_batch_fast([p.decode() for p in parts], add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in coded]

    def _begins(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the parts of the texts begin."""
        cut = _cuts(raw, offsets)
        whole = np.full(len(offsets) - 1, not self.by_part)
        if self.by_part:
            found = [m.start() for m in self.whole.finditer(raw)]
            whole[np.searchsorted(offsets, found, "right") - 1] = True
        if whole.any():  # such a text is one part
            keep = np.repeat(~whole, np.diff(offsets))
            keep[offsets[:-1][whole & (np.diff(offsets) > 0)]] = True
            cut &= keep
        return np.flatnonzero(cut)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends) of the texts of a column, nulls empty; the texts' ids stand one after another."""
        offsets, raw = text_buffers(column)
        at = self._begins(raw, offsets)
        coded = binary_array(np.append(at, len(raw)), raw).dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False)
        parts = coded.dictionary.to_pylist()
        own = self.parts.get_all(parts)
        new = [k for k, ids in enumerate(own) if ids is None]
        for i in range(0, len(new), LIBRARY_PARTS):
            some = new[i:i + LIBRARY_PARTS]
            for k, ids in zip(some, self._library([parts[k] for k in some])):
                own[k] = ids
                if len(parts[k]) <= CACHE_BYTES:
                    self.parts.put(parts[k], ids)
        flat = np.frombuffer(b"".join(own), self.kind)
        own_ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, own), np.int64, len(own)))]) // flat.itemsize
        ids, count = gather(flat, own_ends, code)
        return ids, np.concatenate([[0], np.cumsum(count)])[np.searchsorted(at, offsets)]


# white space beyond ASCII, in UTF-8 (fixed values)
_WIDE_SPACE = [b"\xc2[\x85\xa0]", b"\xe1\x9a\x80", b"\xe2\x80[\x80-\x8a\xa8\xa9\xaf]", b"\xe2\x81\x9f", b"\xe3\x80\x80"]

# what a byte may be a part of
_SPACE, _LETTER, _DIGIT, _SIGN, _QUOTE, _OTHER = range(6)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[33:127] = _SIGN
_KIND[[*range(48, 58)]] = _DIGIT
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[39] = _QUOTE
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE

# between which neighbours that are no white space a new pre-token starts for certain
_APART = np.zeros((6, 6), bool)
_APART[_LETTER, [_DIGIT, _SIGN, _QUOTE]] = True
_APART[_DIGIT, [_LETTER, _SIGN, _QUOTE]] = True
_APART[_SIGN, [_LETTER, _DIGIT]] = True


def _cuts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which bytes begin a part: pre-tokens of the byte-level pattern never reach across.

    Runs of ASCII letters, digits and other signs part from one another,
    except that an apostrophe stays with what follows (it may be a
    contraction).  White space parts from what stands before it.  Of white
    space with a word behind it the last character is a part of its own, or,
    being a space, begins the word's.  Bytes beyond ASCII and control
    characters, whose kind depends on more than a byte, part from white space
    only; texts with other white space than ASCII's must not be cut at all."""
    begins = np.zeros(len(raw), bool)
    if not len(raw):
        return begins
    own = np.zeros(len(raw) + 1, bool)
    own[offsets] = True  # a text's first byte
    kind = _KIND[raw]
    space = kind == _SPACE
    begins[1:] = _APART.reshape(-1)[kind[:-1] * np.uint8(6) + kind[1:]] | (space[1:] & ~space[:-1])
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~own[1:-1])  # white space before a word of its text
    begins[last] = True
    begins[last + 1] = raw[last] != 32
    return begins | own[:-1]


def _encoder(path: str, width: int) -> Encoder:
    """The Python worker's encoder: tasks that follow each other share its parts."""
    encoders = worker_cache().setdefault("encoders", {})
    if (path, width) not in encoders:
        encoders[path, width] = Encoder(path, width)
    return encoders[path, width]


# ---- writing and reading -----------------------------------------------------

_MANIFEST = "part int, file string, n_docs long, n_null long, least long, n_tokens long"


def _write(root: str, path: str, end_id: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ctx, encoder = TaskContext.get(), _encoder(path, width)
        name = f"{ctx.partitionId():06d}-{ctx.taskAttemptId()}"  # another attempt writes other files
        fs, folder = filesystem(root)
        fs.create_dir(folder, recursive=True)
        lengths, ids, nulls = [], [], 0
        with fs.open_output_stream(f"{folder}/{name}.ids") as out:
            for batch in batches:
                for part in rows_in(batch, SLICE_BYTES):
                    tokens, ends = encoder.encode(part.column("text"))
                    tokens, ends = with_each(tokens, np.diff(ends), np.ones(part.num_rows, bool), end_id, first=False)
                    out.write(tokens.tobytes())
                    lengths.append(np.diff(ends))
                    own = part.column("id").drop_null()
                    nulls += part.num_rows - len(own)
                    ids.append(own.to_numpy().copy())  # a view would hold the batch and its texts
                    del part, own
                del batch  # before the next one is read
        n = np.concatenate(lengths) if lengths else np.zeros(0, np.int64)
        if not len(n):
            return
        own = np.concatenate(ids)
        least = int(own[0]) if len(own) else 0
        ef = EliasFano.encode(np.cumsum(n)).dump() + EliasFano.encode(
            own.astype(np.uint64) - np.uint64(least % 2**64)).dump()
        with fs.open_output_stream(f"{folder}/{name}.ef") as out:
            out.write(struct.pack(_HEAD, b"TIDS", width, len(n), nulls, int(n.sum())) + ef)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in ((ctx.partitionId(), pa.int32()), (name, pa.string()), (len(n), pa.int64()),
                                           (nulls, pa.int64()), (least, pa.int64()), (int(n.sum()), pa.int64()))],
            ["part", "file", "n_docs", "n_null", "least", "n_tokens"])
    return run


def write_tokens(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int, vocabulary: int,
                 root: str | None = None) -> tuple[str, DataFrame]:
    """Write the token files of ``docs`` and return (folder, manifest).

    Documents stand in ascending id order over all shards: null ids first,
    rows of the same id by a hash of their text.  A null text counts as empty
    and, as every document, ends with ``end_id``.  Other columns are not read;
    an empty table gives an empty manifest.  A failed or repeated task leaves
    files that no manifest names.  ``tokenizer`` is the path of a
    ``tokenizers`` file that executors can open; ids take 2 bytes while
    ``vocabulary`` and ``end_id`` allow it, else 4."""
    spark = docs.sparkSession
    root = shared_uri(spark, root) if root else run_dir(spark, "tokens")
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("h"))
    manifest = (rows.repartitionByRange("id", "h").sortWithinPartitions("id", "h")
                .mapInArrow(tidied(_write(root, tokenizer, end_id, width)), _MANIFEST))
    return root, stage(manifest, "manifest")


class Shard:
    """One shard: ``offsets(i)`` by select, ``documents()`` in order."""

    def __init__(self, root: str, name: str):
        fs, folder = filesystem(root)
        with fs.open_input_file(f"{folder}/{name}.ef") as f:
            raw = memoryview(f.read())
        magic, self.width, self.n, self.nulls, self.n_tokens = struct.unpack_from(_HEAD, raw)
        if magic != b"TIDS":
            raise ValueError(f"{name}.ef is no boundary file")
        self.ends, at = EliasFano.load(raw, struct.calcsize(_HEAD))
        self.keys, _ = EliasFano.load(raw, at)
        self.kind = {2: "<u2", 4: "<u4"}[self.width]
        self.open = lambda: fs.open_input_file(f"{folder}/{name}.ids")

    def offsets(self, i: int) -> tuple[int, int]:
        """Where document i of the shard starts and ends."""
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def tokens(self, i: int) -> np.ndarray:
        """The ids of document i of the shard."""
        a, b = self.offsets(i)
        with self.open() as f:
            return np.frombuffer(f.read_at((b - a) * self.width, a * self.width), self.kind)

    def documents(self, least: int, rows: int = 4096) -> Iterator[tuple[np.ndarray, list[int | None], list[np.ndarray]]]:
        """(ends, ids, token arrays) of ``rows`` documents at a time."""
        ends, keys = self.ends.decode(), self.keys.decode()
        own_ids = (keys.view(np.uint64) + np.uint64(least % 2**64)).view(np.int64)  # differences may exceed 63 bits
        ids = [None] * self.nulls + own_ids.tolist()
        with self.open() as f:
            for i in range(0, self.n, rows):
                own = ends[i:i + rows]
                first = int(ends[i - 1]) if i else 0
                flat = np.frombuffer(f.read((int(own[-1]) - first) * self.width), self.kind)
                yield own, ids[i:i + rows], np.split(flat, own[:-1] - first)


def _read(root: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, least, base in zip(*(batch.column(c).to_pylist() for c in ("file", "least", "base"))):
                for ends, ids, tokens in Shard(root, file).documents(least):
                    n = np.array([len(t) for t in tokens], np.int64)
                    crc = np.array([zlib.crc32(t.astype("<u4").tobytes()) for t in tokens], np.int64)
                    arrays = [pa.array(ids, pa.int64()), pa.array(ends - n + base), pa.array(n), pa.array(crc)]
                    names = ["id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        arrays.append(pa.array([t.astype(np.int32) for t in tokens], pa.list_(pa.int32())))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(arrays, names)
    return run


def read_tokens(spark: SparkSession, root: str, manifest: DataFrame, id_col: str, with_ids: bool = False) -> DataFrame:
    """(id_col, start, n_tokens, ids_crc32[, ids]) of every document, read from the files.

    ``start`` counts the ids of all documents before, over all shards: the
    shards' own counts are summed over the manifest (one row a shard)."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))
    shards = shards.repartition(max(1, 2 * manifest.count()), "part")
    extra = ", ids array<int>" if with_ids else ""
    return (shards.mapInArrow(tidied(_read(root, with_ids)), f"id long, start long, n_tokens long, ids_crc32 long{extra}")
            .withColumnRenamed("id", id_col))
