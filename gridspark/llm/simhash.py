"""SimHash near-duplicates by the generalised pigeonhole principle.

Distinct fingerprints are searched for pairs within ``max_bits`` bits.  The 64
bits are grouped into partitions of correlated bits.  With m partitions, two
fingerprints within tau bits agree to t_i bits in some partition i whenever
the thresholds t_i (from -1: skip the partition) sum to tau - m + 1; every
fingerprint gets the thresholds of least cost by dynamic programming over
candidate counts taken from the partitions' histograms.  It probes the
signatures within t_i bits of its own in each partition and candidates are
verified over all 64 bits.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_or_shuffled, stage, tidied, utf8
from .components import connected_components

BITS = 64
#: Partitions of the bits; their width bounds the histograms the driver holds (2^16 counts each).
PARTS = 4
#: Largest threshold that the allocation considers in one partition.
MOST = 2
#: Cost of a probe beside that of a candidate.
PROBE_COST = 4
#: Rows of one signature that meet in one group: indexed, probing.
TILE, PROBES = 4096, 65536
#: Candidate pairs verified at a time.
PAIRS = 1 << 21


# ---- fingerprints --------------------------------------------------------------

def fingerprint(raw: bytes | None, shingle: int) -> int:
    """The SimHash of a text's word shingles, repeats included."""
    import xxhash

    w = (raw or b"").lower().split()  # bytes: only A-Z change, and only ASCII white space separates
    if not w:
        return 0
    text = b" ".join(w)
    stop = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    start = np.concatenate([[0], stop[:-1] + 1])
    k = min(shingle, len(w))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(text[a:b], 42) for a, b in zip(start[:len(w) - k + 1].tolist(), stop[k - 1:].tolist())),
                    np.uint64, len(w) - k + 1)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(raw, shingle) for raw in utf8(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["id", "fp"])
    return run


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, fp) of every row: the whole text's fingerprint as a signed 64-bit
    integer; null and empty texts have 0."""
    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(tidied(_fingerprints(shingle)), "id long, fp long"))


# ---- partitions of correlated bits -----------------------------------------------

def _bit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((BITS + 1, BITS), np.int64)
    for batch in batches:
        x = batch.column("fp").to_numpy().view(np.uint8).reshape(-1, 8)
        x = np.unpackbits(x, axis=1, bitorder="little").astype(np.float64)
        total[:BITS] += (x.T @ x).astype(np.int64)
        total[BITS, 0] += len(x)
    r, c = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(r.astype(np.int32)), pa.array(c.astype(np.int32)), pa.array(total[r, c])],
                                     ["r", "c", "n"])


def correlated_parts(unique: DataFrame, parts: int = PARTS) -> list[list[int]]:
    """The bits in ``parts`` groups of equal width, correlated ones together,
    from the co-occurrence counts of all fingerprints (64 x 64 numbers)."""
    total = np.zeros((BITS + 1, BITS))
    for x in unique.select("fp").mapInArrow(_bit_counts, "r int, c int, n long").groupBy("r", "c").agg(
            F.sum("n").alias("n")).collect():
        total[x["r"], x["c"]] = x["n"]
    n = max(total[BITS, 0], 1)
    p = np.diag(total[:BITS]) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    near = np.abs(total[:BITS] / n - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(near, 0)
    left, out = list(range(BITS)), []
    for i in range(parts):
        width = -(-len(left) // (parts - i))
        first = max(left, key=lambda b: (near[b, left].max(), -b))
        group = [first]
        while len(group) < width:
            rest = [b for b in left if b not in group]
            group.append(max(rest, key=lambda b: (near[b, group].mean(), -b)))
        out.append(sorted(group))
        left = [b for b in left if b not in group]
    return out


def _values(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(fp), np.int64)
    for k, b in enumerate(bits):
        out |= ((fp >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << k
    return out


def _masks(width: int, most: int) -> list[np.ndarray]:
    """The masks of exactly 0, 1, ... bits."""
    from itertools import combinations
    return [np.array([sum(1 << b for b in c) for c in combinations(range(width), t)], np.int64) for t in range(most + 1)]


# ---- allocation, probes and verification -------------------------------------------

class Plan:
    """What a task needs to allocate and probe: the partitions, and for each
    the indexed rows within 0, 1, ... bits of every signature (``near``, from
    ``counts`` on the driver; tasks are sent the arrays)."""

    def __init__(self, parts: list[list[int]], max_bits: int, near: list[np.ndarray] | None = None,
                 counts: list[np.ndarray] | None = None):
        self.parts, self.max_bits = parts, max_bits
        self.goal = max_bits - len(parts) + 1
        # a threshold beyond MOST is considered only where the sum could not be reached otherwise
        self.most = max(MOST, -(-self.goal // len(parts)))
        self.masks = [_masks(len(p), min(self.most, len(p))) for p in parts]
        self.near = near or []
        for count, masks in zip(counts or [], self.masks):
            ring = [sum(count[np.arange(len(count)) ^ m] for m in ms) for ms in masks]
            self.near.append(np.cumsum(ring, axis=0).astype(np.int64))

    def thresholds(self, values: list[np.ndarray]) -> np.ndarray:
        """(rows, parts): each row's thresholds of least cost that sum to the goal."""
        n, m = len(values[0]), len(self.parts)
        span = self.goal + m  # states: sums from -m to goal, shifted by m
        best = np.full((n, span + 1), np.inf)
        best[:, 0] = 0  # no partition yet: sum -0, kept as the count of steps above all-skipped
        chosen = np.zeros((m, n, span + 1), np.int8)
        for i in range(m):
            cost = [np.zeros(n)]  # skipped
            probes = 0
            for t, masks in enumerate(self.masks[i]):
                probes += len(masks)
                cost.append(self.near[i][t][values[i]] + PROBE_COST * probes)
            new = np.full_like(best, np.inf)
            for step, c in enumerate(cost):  # step = threshold + 1
                if step > span:
                    break
                cand = best[:, :span + 1 - step] + c[:, None]
                better = cand < new[:, step:]
                new[:, step:][better] = cand[better]
                chosen[i][:, step:][better] = step
            best = new
        at = np.full(n, span)
        out = np.zeros((n, m), np.int64)
        for i in range(m - 1, -1, -1):
            step = chosen[i][np.arange(n), at]
            out[:, i] = step.astype(np.int64) - 1
            at = at - step
        return out

    def rows(self, fp: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(key, tile, probing, fp) arrays: where each fingerprint is indexed and where it probes.

        A signature with many rows is dealt over tiles: indexed rows by one
        hash, probes by another, and each side is copied to all tiles of the
        other, so every pair still meets exactly once."""
        values = [_values(fp, p) for p in self.parts]
        t = self.thresholds(values)
        spread = (fp * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        for i, v in enumerate(values):
            index_tiles = -(-self.near[i][0] // TILE)
            probe_tiles = np.maximum(1, -(-self.near[i][-1] // PROBES))
            yield self._dealt(i, v, fp, spread, index_tiles, probe_tiles, False)
            for most in range(self.most + 1):
                asking = np.flatnonzero(t[:, i] >= most)
                if most < len(self.masks[i]) and len(asking):
                    for mask in self.masks[i][most]:
                        sig = v[asking] ^ mask
                        some = asking[index_tiles[sig] > 0]  # signatures that no fingerprint has hold no candidates
                        yield self._dealt(i, v[some] ^ mask, fp[some], spread[some], index_tiles, probe_tiles, True)

    @staticmethod
    def _dealt(i, sig, fp, spread, index_tiles, probe_tiles, probing):
        a, b = np.maximum(1, index_tiles[sig]), probe_tiles[sig]
        copies = a if probing else b
        row = np.repeat(np.arange(len(sig)), copies)
        other = np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)
        own = (spread[row].astype(np.int64)) % (b if probing else a)[row]
        tile = other * (1 << 24) + own if probing else own * (1 << 24) + other
        return (sig[row] * BITS + i, tile, np.full(len(row), probing), fp[row].view(np.int64))


def _signatures(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for i in range(0, len(fp), 1 << 14):
                for part in plan.rows(fp[i:i + (1 << 14)]):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in part], ["key", "tile", "probing", "fp"])
    return run


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node of each node's component after the links a-b; label holds those before."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return label
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while not (label[label] == label).all():
            label = label[label]


def _verified(key: np.ndarray, probing: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (fp, smallest linked fp) among rows of whole groups, sorted by (key, probing)."""
    nodes, node = np.unique(fp, return_inverse=True)
    label = np.arange(len(nodes))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    last = np.concatenate([first[1:], [len(key)]])
    n_probe = np.add.reduceat(probing.astype(np.int64), first)
    n_index = last - first - n_probe
    # one entry a probing row: its candidates are the group's indexed rows
    group = np.repeat(np.arange(len(first)), n_probe)
    probe = np.flatnonzero(probing)
    many, begin = n_index[group], first[group]
    at = 0
    total = np.concatenate([[0], np.cumsum(many)])
    while at < len(probe):
        to = max(at + 1, int(np.searchsorted(total, total[at] + PAIRS, "right")) - 1)
        size = many[at:to]
        q = np.repeat(probe[at:to], size)
        x = np.arange(len(q)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin[at:to], size)
        close = np.bitwise_count(fp[q] ^ fp[x]) <= max_bits
        label = _merge(label, node[q[close]], node[x[close]])
        at = to
    linked = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[linked], nodes[label[linked]]


def _verify(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key, probing, fp):
            u, v = _verified(key, probing, fp.view(np.uint64), max_bits)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            key, tile = (batch.column(c).to_numpy() for c in ("key", "tile"))
            rows = (key, tile, batch.column("probing").to_numpy(zero_copy_only=False), batch.column("fp").to_numpy())
            if not len(key):
                continue
            held.append(rows)
            # all but the last group are whole
            cut = int(np.flatnonzero((key == key[-1]) & (tile == tile[-1]))[0])
            same = len(held) > 1 and cut == 0 and held[-2][0][-1] == key[-1] and held[-2][1][-1] == tile[-1]
            if same or (cut == 0 and len(held) == 1):
                continue
            whole = [np.concatenate([*(h[i] for h in held[:-1]), rows[i][:cut]]) for i in range(4)]
            held = [tuple(r[cut:] for r in rows)]
            if len(whole[0]):
                yield out(_group_ids(whole[0], whole[1]), whole[2], whole[3])
        if held:
            whole = [np.concatenate([h[i] for h in held]) for i in range(4)]
            yield out(_group_ids(whole[0], whole[1]), whole[2], whole[3])
    return run


def _group_ids(key: np.ndarray, tile: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate([[0], (key[1:] != key[:-1]) | (tile[1:] != tile[:-1])]))


def fingerprint_links(unique: DataFrame, max_bits: int, parts: int = PARTS) -> DataFrame:
    """Links (u, v) that connect all of ``unique`` (fp, distinct) within
    ``max_bits`` bits: every such pair is joined by a path of links.

    Verified pairs are reduced to spanning links inside each task, so a group
    of n mutually close fingerprints yields about n rows a partition, not n^2."""
    spark = unique.sparkSession
    groups = correlated_parts(unique, parts)
    counts = [np.zeros(1 << len(g), np.int64) for g in groups]
    sums = unique.select("fp").mapInArrow(_histogram(groups), "part int, v int, n long").groupBy("part", "v").agg(F.sum("n").alias("n"))
    table = sums.toArrow()  # at most 2^16 counts a partition, whatever the input
    for part, v, n in zip(*(table.column(c).to_numpy() for c in ("part", "v", "n"))):
        counts[part][v] = n
    # a broadcast is pickled by reference: arrays alone, as executors need not have this package
    near = spark.sparkContext.broadcast(Plan(groups, max_bits, counts=counts).near)

    def probes(batches):
        yield from _signatures(Plan(groups, max_bits, near.value))(batches)

    rows = unique.select("fp").mapInArrow(tidied(probes), "key long, tile long, probing boolean, fp long")
    return (rows.repartition("key", "tile").sortWithinPartitions("key", "tile", "probing")
            .mapInArrow(tidied(_verify(max_bits)), "u long, v long"))


def _histogram(groups: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(1 << len(g), np.int64) for g in groups]
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for t, g in zip(total, groups):
                t += np.bincount(_values(fp, g), minlength=len(t))
        for i, t in enumerate(total):
            v = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), i, np.int32)), pa.array(v.astype(np.int32)), pa.array(t[v])],
                                             ["part", "v", "n"])
    return run


def near_duplicates(docs: DataFrame, id_col: str, text_col: str, shingle: int = 4, max_bits: int = 4,
                    parts: int = PARTS) -> DataFrame:
    """(id_col, fingerprint, component_id, root) of every row: the component is
    the smallest id reachable through fingerprints at ``max_bits`` bits or
    fewer.  ``root`` is one of the component's fingerprints and names it also
    where ids repeat and components share one.

    Texts are lower-cased (A-Z) and cut at ASCII white space; a text of fewer
    words than a shingle has its whole sequence as one, one without words (or
    null) the fingerprint zero, which links like any other.  Rows with a null
    id link too but name no component unless their whole component has none;
    repeated rows share their component; empty tables give an empty result;
    other columns are not read.  Texts are read once and never shuffled: the
    search runs on distinct fingerprints, and copies never meet in pairs."""
    rows = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    unique = stage(rows.groupBy("fp").agg(F.min("id").alias("least")), "unique")
    links = fingerprint_links(unique, max_bits, parts)
    roots = connected_components(links)
    named = unique.join(roots, unique["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    components = named.join(least, "root").select("fp", "component_id", "root")
    return rows.join(components, "fp").select(
        F.col("id").alias(id_col), _printed("fp").alias("fingerprint"), "component_id", _printed("root").alias("root"))


def _printed(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _with_fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(raw, shingle) for raw in utf8(batch.column("_text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fp.view(np.int64))], [*batch.schema.names[:-1], "_fp"])
    return run


def keep_one(docs: DataFrame, found: DataFrame, id_col: str, text_col: str, shingle: int = 4) -> DataFrame:
    """The rows of ``docs``, with their columns, that stand for their component
    in ``found`` (of the same ``shingle``): one document of each group, that of
    its smallest id.  Rows with a null id stay, as nothing names them; where an
    id repeats, a row is named by id and fingerprint, and of a component's rows
    of one id that of the smallest fingerprint, then the first by a hash of the
    text, stays."""
    found = stage(found.filter(F.col(id_col).isNotNull()), "components")  # read several times below
    again = stage(found.groupBy(F.col(id_col).alias("_again")).count().filter("count > 1").select("_again"), "repeated")
    # within a component, every row of a larger id goes
    gone = found.filter(F.col(id_col) != F.col("component_id"))
    if again.isEmpty():  # ids are unique, as they should be
        gone = small_or_shuffled(gone.select(F.col(id_col).alias("_gone")), "gone", 1_000_000)
        return docs.join(gone, docs[id_col].cast("long") == gone["_gone"], "left_anti")
    single = gone.join(again, F.col(id_col) == F.col("_again"), "left_anti").select(F.col(id_col).alias("_gone"))
    single = small_or_shuffled(single, "gone", 1_000_000)
    kept = docs.join(single, docs[id_col].cast("long") == single["_gone"], "left_anti")
    stays = (found.join(again, F.col(id_col) == F.col("_again"), "left_semi").filter(F.col(id_col) == F.col("component_id"))
             .groupBy(F.col(id_col).alias("_stays"), "root").agg(F.min("fingerprint").alias("_print")).drop("root"))
    columns = kept.columns
    rows = kept.select(F.struct(*[kept[c] for c in columns]).alias("_row"), kept[id_col].cast("long").alias("_id"),
                       F.xxhash64(kept[text_col]).alias("_h"), kept[text_col].alias("_text"))
    twice = F.col("_id") == F.col("_again")
    repeated = rows.join(again, twice, "left_semi")
    kinds = T.StructType([*repeated.schema.fields[:-1], T.StructField("_fp", T.LongType())])
    repeated = repeated.mapInArrow(tidied(_with_fingerprints(shingle)), kinds)
    repeated = repeated.join(stays, (F.col("_id") == F.col("_stays")) & (_printed("_fp") == F.col("_print")), "left_semi")
    nth = Window.partitionBy("_id", "_fp").orderBy("_h")
    first = repeated.withColumn("_nth", F.row_number().over(nth)).filter("_nth = 1").select("_row")
    return rows.join(again, twice, "left_anti").select("_row").union(first).select("_row.*")
