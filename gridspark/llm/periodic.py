"""Periodic runs of words, by a sparse diagonal dynamic programme.

A run of period q shows on the diagonal of lag q: the words there equal the
words q before.  Words, read from left to right, lengthen the match of every
lag at which they occurred before, and a diagonal that ends with a long enough
match gives a run at once.  Diagonals are kept sparse without losing any:

* lags under 8 are followed word by word, as there are seven of them;
* a run of period q from 2B to 4B (B = 4, 8, 16, ...) matches over q words or
  more and so covers a whole aligned block of B words.  Only such blocks open
  or lengthen diagonals, only at earlier occurrences of the same B words 2B to
  4B before.  Occurrences of B words nearer than B/2 to each other force a
  shorter period p, so a block has at most 2B/p of them and all blocks of a
  size at most 2n/p: the work is O(n log n) however repetitive the text is.

A match's ends inside the blocks next to it are found by halving, on the names
that the B-grams of each size were given.  All documents of a slice of a batch
are worked on together; names are a document's own, so nothing crosses texts.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, rows_in
from .words import byte_kinds, joined, split_words

#: Bytes of text worked on at a time (one document at least).
SLICE_BYTES = 4 << 20
#: Lags below this are followed word by word; a power of two.
DENSE = 8

_SCHEMA = "id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of each stretch of true flags."""
    edge = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _needed(q, least: int):
    """The match length at lag q of a run of ``least`` words and two periods."""
    return np.maximum(least - q, q)


def _double(names: np.ndarray, size: int) -> np.ndarray:
    """Names of the grams of ``2 * size`` words from those of ``size``: equal
    grams share a name from 0 up, a gram that occurs once has one below 0."""
    out = -1 - np.arange(len(names))
    left = np.flatnonzero(names[:len(names) - size] >= 0) if len(names) > size else np.zeros(0, np.int64)
    left = left[names[left + size] >= 0]
    if len(left):
        _, group, n = np.unique(names[left] * (names.max() + 1) + names[left + size], return_inverse=True, return_counts=True)
        again = n[group] > 1
        out[left[again]] = group[again]
    return out


def _block_hits(names: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of every aligned block of ``size`` words and each earlier
    occurrence of it at a lag of 2 to under 4 sizes, by (lag, place)."""
    n = len(names)
    at = np.flatnonzero(names >= 0)
    keys = np.sort(names[at] * n + at)
    block = at[at % size == 0]
    base = names[block] * n
    low = np.searchsorted(keys, base + np.maximum(block - 4 * size + 1, 0))
    high = np.searchsorted(keys, base + block - 2 * size, "right")  # below the name's own keys where there is none
    count = np.maximum(high - low, 0)
    place = np.repeat(block, count)
    nth = np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count)
    lag = place - keys[np.repeat(low, count) + nth] % n if len(place) else place
    order = np.lexsort((place, lag))
    return place[order], lag[order]


def find_runs(names: np.ndarray, least: int) -> np.ndarray:
    """Rows (start, end, period) of all runs in a sequence of word names (from 0), by start, then period.

    A run is a stretch with smallest period q of at least ``least`` words and
    two periods that no neighbouring word extends; ends are exclusive."""
    found = []
    for q in range(1, min(DENSE, len(names))):
        a, b = _stretches(names[q:] == names[:-q])
        keep = b - a >= _needed(q, least)
        found.append(np.stack([a[keep], b[keep] + q, np.full(keep.sum(), q)], 1))
    levels, size = [np.asarray(names, np.int64)], 1
    while 4 * size <= len(names):
        if size * 2 >= DENSE:
            place, lag = _block_hits(levels[-1], size)
            if len(place):
                opens = np.ones(len(place), bool)  # the block before did not match at this lag
                opens[1:] = (lag[1:] != lag[:-1]) | (place[1:] != place[:-1] + size)
                first = np.flatnonzero(opens)
                last = np.append(first[1:], len(place)) - 1
                s, e, q = place[first], place[last] + size, lag[first]
                keep = e - s + 2 * (size - 1) >= _needed(q, least)
                s, e, q = s[keep], e[keep], q[keep]
                for k in range(len(levels) - 2, -1, -1):  # fewer than ``size`` more words at each end
                    own, b = levels[k], 1 << k
                    i = np.maximum(s - b, 0)
                    s = np.where((s - b - q >= 0) & (own[i] >= 0) & (own[i] == own[np.maximum(i - q, 0)]), s - b, s)
                    j = np.minimum(e, len(own) - 1)
                    e = np.where((e < len(own)) & (own[j] >= 0) & (own[j] == own[j - q]), e + b, e)
                keep = e - s >= _needed(q, least)
                found.append(np.stack([s - q, e, q], 1)[keep])
        levels.append(_double(levels[-1], size))
        size *= 2
        if levels[-1].max() < 0:
            break
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    if len(runs):  # a stretch of period q has the periods 2q, 3q, ... too
        again = (runs[1:, :2] == runs[:-1, :2]).all(1)
        runs = runs[np.concatenate([[True], ~again])]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _scan(least: int, rewrite: Callable | None):
    kinds = byte_kinds(ASCII_SPACE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in rows_in(batch, SLICE_BYTES):
                w = split_words(part.column("text"), kinds)
                n = np.diff(w.first)
                code = w.code
                if rewrite is not None:
                    code = code[rewrite(part.column("id").to_pylist(), w.first)]
                text = w.text_of()
                _, names = np.unique(text * len(w.dictionary) + code, return_inverse=True)
                runs = find_runs(names, least)
                of = text[runs[:, 0]]
                dropped = np.zeros(len(code) + 1, np.int64)
                np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
                np.add.at(dropped, runs[:, 1], -1)
                keep = np.cumsum(dropped)[:-1] == 0
                kept = np.bincount(text[keep], minlength=len(n))
                fields = [pa.array(x) for x in (runs[:, 0] - w.first[of], runs[:, 1] - runs[:, 0], runs[:, 2])]
                ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(n)))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), pa.array(n.astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(fields, ["start", "length", "period"])),
                    joined(w.dictionary.take(pa.array(code[keep])), kept).cast(pa.large_string()).cast(pa.string()),
                ], ["id", "n_words", "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, id_col: str, text_col: str, least: int = 12,
                  rewrite: Callable | None = None) -> DataFrame:
    """(id, n_words, runs, collapsed) of every document.

    Words are stretches without ASCII white space.  ``runs`` holds (start,
    length, period) of every stretch of words with smallest period q (words q
    apart are identical) and at least max(``least``, 2q) words that no
    neighbouring word extends, by start, then period; ``collapsed`` the words,
    joined by one space, without those that stand in a run after its first q
    words.  One row per input row: null ids stay, a null or blank text has no
    words, no runs (an empty array) and an empty ``collapsed``; repeated rows
    are judged one by one; other columns are not read; an empty table gives an
    empty result.  ``rewrite(ids, first)`` may return, for each word of the
    documents whose words begin at ``first``, the word to read in its place.
    One pass without a shuffle; a task holds a slice of ``SLICE_BYTES`` or one
    text, whatever its repetition."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scan(least, rewrite), _SCHEMA)
