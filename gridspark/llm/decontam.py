"""Benchmark decontamination by size-partitioned MinHash containment search.

Texts become sets of word shingles.  Documents fall into classes by the size
of their set (powers of two); a class has its own number of one-permutation
MinHash bins, tuned to the class's largest set so that a shingle of a document
is the minimum of its bin with high probability however long the document is.

The signatures find: a document probes the items with the minima of its bins,
and an item with a probed minimum among its shingles is a candidate.  The few
shingles that are nowhere a minimum (about 1 of 1000), the document's
remainder, are probed after them, so that an item whose only shared shingles
are among them is not lost.  An item that too few probes met cannot be
contained; the others are verified by exact shingle containment.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filesystem, rows_in, run_dir, tidied

SHINGLE, CONTAINMENT = 5, 0.8
#: Bins a shingle of the class's largest set: a shingle shares its bin with a
#: smaller one in at most 1 of ~16 cases, in all permutations in 1 of ~250.
BINS, PERMUTATIONS = 16, 2
#: Items a block of the index; text bytes hashed at a time.
BLOCK_ITEMS, SLICE_BYTES = 4096, 8 << 20
#: Blocks that a task keeps; those beyond are read again for every slice of text.
HELD_BLOCKS = 16

_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_FOLD = bytes(c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """The words of a text: lower case, ASCII letters, digits and all other characters."""
    return (text or "").lower().encode().translate(_FOLD).split()


def _mix(h: np.ndarray, r: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(_ODD[r])
    return (h ^ (h >> np.uint64(29))) * np.uint64(_ODD[1 - r])


def shingle_hashes(w: list[bytes], size: int) -> np.ndarray:
    """A 64-bit hash of every ``size`` words that follow each other; of the whole text if it is shorter."""
    import xxhash

    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, w), np.uint64, len(w))
    size = min(size, len(w))
    out = np.zeros(len(w) - size + 1, np.uint64)
    for k in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + h[k:k + len(out)]
    return _mix(out + np.uint64(size), 0)


def shingle_texts(w: list[bytes], size: int, at: np.ndarray | None = None) -> list[bytes]:
    size = min(size, len(w))
    return [b" ".join(w[i:i + size]) for i in (range(len(w) - size + 1) if at is None else at)] if w else []


def size_class(n: int) -> int:
    """The class of a set of n shingles: sets of up to 2^class."""
    return max(0, n - 1).bit_length()


def bin_minima(h: np.ndarray, cls: int, r: int) -> np.ndarray:
    """The one-permutation MinHash signature of a set in a class: which of its hashes are the smallest of their bin."""
    mixed = _mix(h, r)
    order = np.argsort(mixed, kind="stable")
    bits = min(63, cls + (BINS - 1).bit_length())
    bins = mixed[order] >> np.uint64(64 - bits)
    first = np.concatenate([[True], bins[1:] != bins[:-1]]) if len(bins) else np.zeros(0, bool)
    out = np.zeros(len(h), bool)
    out[order[first]] = True
    return out


# ---- the index of items ------------------------------------------------------------

_ITEM = "item_id {}, hashes array<long>, shingles array<binary>"


def _index_items(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, texts = [], []
            for text in batch.column("text").to_pylist():
                w = words(text)
                own = dict(zip(shingle_hashes(w, size).tolist(), shingle_texts(w, size)))
                by_text = {t: h for h, t in own.items()}
                hashes.append([h - 2**64 if h >= 2**63 else h for h in by_text.values()])
                texts.append(list(by_text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(hashes, pa.list_(pa.int64())), pa.array(texts, pa.list_(pa.binary()))],
                ["item_id", "hashes", "shingles"])
    return run


def build_index(items: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> dict:
    """Write the items' distinct shingles to the shared folder; the files,
    which every task reads in blocks.  Null and wordless items match nothing
    and are left out."""
    root = run_dir(items.sparkSession, "items")
    kind = items.schema[id_col].dataType.simpleString()
    (items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
     .mapInArrow(_index_items(shingle), _ITEM.format(kind)).filter(F.size("hashes") > 0)
     .write.option("compression", "zstd").parquet(root))
    return {"files": sorted(items.sparkSession.read.parquet(root).inputFiles()), "shingle": shingle, "kind": kind}


def signatures(hashes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, minimum): the distinct hashes of every set, and whether each
    is the smallest of its bin in a permutation of its set's class."""
    size = np.array([len(h) for h in hashes], np.int64)
    row, flat = np.repeat(np.arange(len(hashes)), size), np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    minimum = None
    for r in range(PERMUTATIONS):
        mixed = _mix(flat, r)
        order = np.lexsort((mixed, row))
        row, flat, mixed = row[order], flat[order], mixed[order]
        if minimum is None:
            own = np.concatenate([[True], (row[1:] != row[:-1]) | (mixed[1:] != mixed[:-1])]) if len(row) else np.zeros(0, bool)
            row, flat, mixed = row[own], flat[own], mixed[own]
            minimum = np.zeros(len(row), bool)
            per_class = (BINS - 1).bit_length()
            bits = np.array([min(63, size_class(int(n)) + per_class) for n in np.bincount(row, minlength=len(hashes))], np.uint64)
        else:
            minimum = minimum[order]
        bins = mixed >> (np.uint64(64) - bits[row])
        if len(row):
            minimum |= np.concatenate([[True], (row[1:] != row[:-1]) | (bins[1:] != bins[:-1])])
    return row, flat, minimum


class Block:
    """Some items: their hashes, flat and sorted, with the item of each."""

    def __init__(self, batch: pa.RecordBatch):
        self.ids = batch.column("item_id").to_pylist()
        self.shingles = batch.column("shingles")
        hashes = batch.column("hashes")
        self.size = np.diff(hashes.offsets.to_numpy())
        flat = hashes.flatten().to_numpy().view(np.uint64)
        item = np.repeat(np.arange(len(self.size)), self.size)
        order = np.argsort(flat, kind="stable")
        self.hash, self.item = flat[order], item[order]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(flat >> np.uint64(44)).astype(np.int64)] = True

    def probe(self, row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, item, hash) of every item that has one of the hashes."""
        at = np.flatnonzero(self.seen[(h >> np.uint64(44)).astype(np.int64)])  # a few of these have an item's top bits only
        low, high = (np.searchsorted(self.hash, h[at], side) for side in ("left", "right"))
        n = high - low
        place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        return np.repeat(row[at], n), self.item[place], np.repeat(h[at], n)

    def contained(self, row, h, minimum, least: float, text_of) -> Iterator[tuple[int, int, int]]:
        """(row, item, shared shingles) of the items that rows contain;
        ``text_of(row, hashes)`` gives a row's shingles that have one of the hashes."""
        met = [self.probe(row[some], h[some]) for some in (minimum, ~minimum)]
        rows, items, shared = (np.concatenate(x) for x in zip(*met))
        pair = rows * len(self.size) + items
        order = np.argsort(pair, kind="stable")
        pair, shared = pair[order], shared[order]
        first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
        count = np.diff(np.append(first, len(pair)))
        enough = count >= least * self.size[pair[first] % max(len(self.size), 1)]  # even if every hash stood for its shingle
        for a, n in zip(first[enough].tolist(), count[enough].tolist()):
            r, i = divmod(int(pair[a]), len(self.size))
            k = len(set(self.shingles[i].as_py()) & text_of(r, shared[a:a + n]))
            if k >= least * self.size[i]:
                yield r, i, k


class Matcher:
    """The blocks of an index; the first ``HELD_BLOCKS`` stay loaded."""

    def __init__(self, index: dict, least: float):
        self.index, self.least, self.held, self.whole, self.id_type = index, least, [], False, None

    def _blocks(self) -> Iterator[Block]:
        yield from self.held
        if not self.whole:
            done = len(self.held)
            for k, block in enumerate(self._load()):
                if k < done:
                    continue
                if k == len(self.held) < HELD_BLOCKS:
                    self.held.append(block)
                yield block
            self.whole = len(self.held) < HELD_BLOCKS

    def _load(self) -> Iterator[Block]:
        import pyarrow.parquet as pq
        waiting: list[pa.RecordBatch] = []
        for uri in self.index["files"]:
            fs, path = filesystem(uri)
            with fs.open_input_file(path) as f:
                for batch in pq.ParquetFile(f).iter_batches(BLOCK_ITEMS):
                    self.id_type = batch.schema.field("item_id").type
                    waiting.append(batch)
                    if sum(b.num_rows for b in waiting) >= BLOCK_ITEMS:
                        yield Block(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])
                        waiting = []
        if waiting and sum(b.num_rows for b in waiting):
            yield Block(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])

    def find(self, texts: list[str | None]) -> list[tuple[int, object, int, int]]:
        """(row, item id, shared, shingles of the item) of every match."""
        size = self.index["shingle"]
        hashes = [shingle_hashes(words(t), size) for t in texts]
        row, h, minimum = signatures(hashes)

        def text_of(i: int, some: np.ndarray) -> set[bytes]:
            w = words(texts[i])
            return set(shingle_texts(w, size, np.flatnonzero(np.isin(hashes[i], some)).tolist()))

        return [(i, block.ids[k], n, int(block.size[k])) for block in self._blocks()
                for i, k, n in block.contained(row, h, minimum, self.least, text_of)]


def _pairs(index: dict, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(index, least)
        for batch in batches:
            for part in rows_in(batch, SLICE_BYTES):
                found = matcher.find(part.column("text").to_pylist())
                if found:
                    rows, items, shared, total = (list(c) for c in zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(rows)), pa.array(items, matcher.id_type), pa.array(shared, pa.int64()),
                         pa.array(total, pa.int64()), pa.array([a / b for a, b in zip(shared, total)], pa.float64())],
                        ["id", "item_id", "n_shared", "n_shingles", "containment"])
    return run


def find_contaminated(docs: DataFrame, index: dict, id_col: str, text_col: str,
                      least: float = CONTAINMENT) -> DataFrame:
    """(id_col, item_id, n_shared, n_shingles, containment) of every document
    and item of which at least ``least`` of the distinct shingles stand in the
    document's text.

    Words are those of ``words``; a text shorter than a shingle has its whole
    sequence as one.  Null and wordless texts match nothing; repeated rows and
    items each match for themselves, null ids are returned as they are; empty
    tables give an empty result; other columns are not read.  One narrow pass
    over whole texts: the items lie in the shared folder and every task reads
    them in blocks, so neither side is shuffled or held whole."""
    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(tidied(_pairs(index, least)), f"id {kind}, item_id {index['kind']}, n_shared long, n_shingles long, containment double")
            .withColumnRenamed("id", id_col))


def _clean(index: dict, least: float, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(index, least)
        for batch in batches:
            for part in rows_in(batch, SLICE_BYTES):
                keep = np.ones(part.num_rows, bool)
                keep[[f[0] for f in matcher.find(part.column(at).to_pylist())]] = False
                yield part.filter(pa.array(keep))
    return run


def drop_contaminated(docs: DataFrame, index: dict, text_col: str, least: float = CONTAINMENT) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item; the
    rule is that of ``find_contaminated``, whatever the ids."""
    return docs.mapInArrow(tidied(_clean(index, least, docs.columns.index(text_col))), docs.schema)
