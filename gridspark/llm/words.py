"""Words of whole Arrow batches: positions, dictionary codes and pieces, without a loop over words."""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: What a byte is to a splitter.
WORD, BLANK, BREAK = 0, 1, 2


def byte_kinds(blank: bytes, breaks: bytes = b"") -> np.ndarray:
    """A table of 256 kinds: ``blank`` bytes part words, ``breaks`` part pieces, all others are words'."""
    kinds = np.full(256, WORD, np.uint8)
    kinds[np.frombuffer(blank, np.uint8)] = BLANK
    if breaks:
        kinds[np.frombuffer(breaks, np.uint8)] = BREAK
    return kinds


#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column in UTF-8; nulls are empty, offsets begin at 0."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0]:offsets[-1]]


def binary_array(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    """A binary column over offsets and bytes."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


@dataclass
class Words:
    """The words of a column's texts, one after another.

    ``code[i]`` is the place of word i in ``dictionary``; the words of text t
    are ``first[t]:first[t + 1]``; ``piece`` grows where a break byte, and
    nowhere else, stands between two words."""
    code: np.ndarray
    dictionary: pa.Array
    first: np.ndarray
    piece: np.ndarray

    def text_of(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def split_words(column: pa.Array, kinds: np.ndarray, lower: bool = False) -> Words:
    """The words of every text of ``column``: maximal stretches of word bytes."""
    offsets, raw = text_buffers(column)
    kind = kinds[raw]
    inside = kind == WORD
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    starts = offsets[:-1][offsets[:-1] < len(raw)]
    begins[starts] = inside[starts]
    at = np.flatnonzero(begins)
    kept = raw[inside]
    ends = np.append(np.cumsum(inside)[at] - 1, len(kept))
    coded = binary_array(ends, LOWER[kept] if lower else kept).dictionary_encode()
    piece = np.cumsum(kind == BREAK)[at] if (kinds == BREAK).any() else np.zeros(len(at), np.int64)
    return Words(coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, np.searchsorted(at, offsets), piece)


def joined(words: pa.Array, lengths: np.ndarray) -> pa.Array:
    """The words, ``lengths`` of them a row, joined by one space each."""
    ends = np.concatenate([[0], np.cumsum(lengths)])
    rows = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), words) if len(words) > 1 << 30 else \
        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), words)
    return pc.binary_join(rows, pa.scalar(b" ", words.type))


def gather(values: np.ndarray, ends: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the listed entries one after another, and how many each has.

    Entry e has ``values[ends[e]:ends[e + 1]]``."""
    count = np.diff(ends)[code]
    shift = ends[:-1][code] - (np.cumsum(count) - count)
    return values[np.arange(int(count.sum())) + np.repeat(shift, count)], count


def with_each(values: np.ndarray, count: np.ndarray, own: np.ndarray, extra: int, first: bool) -> tuple[np.ndarray, np.ndarray]:
    """(values, ends): ``extra`` before (or after) the values of each row in
    ``own`` (a mask); the rows have ``count`` values each."""
    more = count + own
    ends = np.concatenate([[0], np.cumsum(more)])
    out = np.empty(int(ends[-1]), values.dtype)
    rest = np.ones(len(out), bool)
    rest[(ends[:-1] if first else ends[1:] - 1)[own]] = False
    out[~rest] = extra
    out[rest] = values
    return out, ends
