"""SentencePiece encoding and decoding of merge-type vocabularies.

The model file is read here.  A text's symbols are its characters; an agenda
holds the adjacent pairs whose union is a piece, by score, then from the left;
the best pair is merged and its new neighbours join the agenda until it is
empty.  Symbols that are no piece become their bytes' pieces.

Two adjacent characters that stand so in no piece can never come to lie in one
symbol, so a text may be cut between them and its parts merged on their own:
the agenda runs once for each distinct part, and a batch's ids are gathered by
the parts' dictionary codes.
"""
from __future__ import annotations

import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Recent, rows_in, worker_cache
from .words import binary_array, gather, text_buffers, with_each

#: Bytes of text worked on at a time (one text at least).
SLICE_BYTES = 4 << 20
#: Parts whose pieces a Python worker remembers, about 120 MB.
CACHE_PARTS = 400_000

# Fixed values of the model file's format: types of pieces, the merge-type model, the mark of a space.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MERGE_TYPE = 2
SPACE = "▁"

_SCHEMA = "id long, n_tokens long, ids array<int>, decoded string"


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a serialised message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}[kind] if kind != 2 else varint()
            yield tag >> 3, raw[at:at + size]
            at += size


class PieceModel:
    """Pieces, scores and switches of a model file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            message = list(_fields(f.read()))
        # fields of the model: 1 pieces (1 text, 2 score, 3 type), 2 trainer (3 type, 35 bytes of unknown symbols),
        # 3 normalizer (2 character map, 3 space before a text, 4 fewer spaces, 5 spaces marked)
        trainer = dict(x for number, value in message if number == 2 for x in _fields(value))
        normalizer = dict(x for number, value in message if number == 3 for x in _fields(value))
        if trainer.get(3, 1) != MERGE_TYPE:
            raise ValueError("the vocabulary is not of the merge type")
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1) or not trainer.get(35, 0):
            raise ValueError("only vocabularies that leave the text as it is and have pieces of bytes are read")
        self.prefix = bool(normalizer.get(3, 1))
        self.ids: dict[str, int] = {}
        self.rank: dict[str, float] = {}
        self.byte_ids: dict[int, int] = {}
        self.text: list[bytes] = []
        for number, value in message:
            if number != 1:
                continue
            piece = dict(_fields(value))
            text, kind, i = piece[1].decode(), piece.get(3, NORMAL), len(self.text)
            if kind in (USER_DEFINED, UNUSED):
                raise ValueError("user-defined and unused pieces are not read")
            if kind == NORMAL:
                self.ids[text] = i
                self.rank[text] = -struct.unpack("<f", piece[2])[0]
                self.text.append(text.replace(SPACE, " ").encode())
            elif kind == BYTE:
                self.byte_ids[int(text[1:-1], 16)] = i
                self.text.append(bytes([int(text[1:-1], 16)]))
            else:
                self.text.append(b"")  # controls leave no text
        self.cuts = self._cuts()

    def _cuts(self) -> np.ndarray:
        """Of two adjacent bytes of a text (256 x 256, flat): may it be cut between them?

        So where they belong to different characters and no piece has two such
        bytes at the border of two characters."""
        first, second = np.meshgrid(np.arange(256), np.arange(256), indexing="ij")
        cuts = (first < 0xC0) & ((second < 0x80) | (second >= 0xC0))
        for piece in self.ids:
            chars = [c.replace(SPACE, " ").encode() for c in piece]
            for a, b in zip(chars, chars[1:]):
                cuts[a[-1], b[0]] = False
        return cuts.reshape(-1)

    def encode(self, text: str) -> list[int]:
        """The ids of a text whose spaces are marked."""
        symbols: list[str | None] = list(text)
        n, rank = len(symbols), self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(rank[p], i, p) for i, p in enumerate(map("".join, zip(symbols, symbols[1:]))) if p in rank]
        heapq.heapify(agenda)
        while agenda:
            _, i, pair = heapq.heappop(agenda)
            left = symbols[i]
            if left is None or (j := after[i]) == n or len(left) + len(symbols[j]) != len(pair) or left + symbols[j] != pair:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = pair, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (p := pair + symbols[k]) in rank:
                    heapq.heappush(agenda, (rank[p], i, p))
            if (h := before[i]) >= 0 and (p := symbols[h] + pair) in rank:
                heapq.heappush(agenda, (rank[p], h, p))
        out: list[int] = []
        for s in symbols:
            if s is not None:
                if (i := self.ids.get(s)) is not None:
                    out.append(i)
                else:
                    out += [self.byte_ids[b] for b in s.encode()]
        return out


class Encoder:
    """Batches of texts to ids, parts remembered, checked against the library."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = PieceModel(path)
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        # parts stand inside a text: the library reads them behind a character that no piece joins to another
        self.border = next(c for c in "\n\t\x00" if not any(c in p for p in self.model.ids))
        self.skip = len(self.library.encode(self.border))
        self.parts = Recent(CACHE_PARTS)

    def _ids(self, parts: list[bytes]) -> list[np.ndarray]:
        """The ids of distinct parts; new ones are compared with the library's."""
        out = self.parts.get_all(parts)
        new = [k for k, ids in enumerate(out) if ids is None]
        texts = [parts[k].decode() for k in new]
        made = [self.model.encode(t.replace(" ", SPACE)) for t in texts]
        for text, own, theirs in zip(texts, made, self.library.encode([self.border + t for t in texts], num_threads=1)):
            if own != theirs[self.skip:]:
                raise ValueError(f"the library encodes {text!r} as {theirs[self.skip:]}, the agenda as {own}")
        for k, ids in zip(new, made):
            out[k] = np.array(ids, np.int32)
            self.parts.put(parts[k], out[k])
        return out

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends) of the texts of a column, nulls empty; the texts' ids stand one after another."""
        mark = SPACE.encode()
        column = pc.fill_null(column.cast(pa.large_binary()), b"")
        column = pc.replace_substring(column, mark, b" ")  # the mark in a text is a space like any other
        offsets, raw = text_buffers(column)
        size = np.diff(offsets)
        raw, ends = with_each(raw, size, (size > 0) & self.model.prefix, 32, first=True)
        cut = np.zeros(len(raw) + 1, bool)
        cut[1:-1] = self.model.cuts[raw[:-1].astype(np.uint16) * np.uint16(256) + raw[1:]]
        cut[ends] = True
        at = np.flatnonzero(cut)
        coded = binary_array(at, raw).dictionary_encode()
        own = self._ids(coded.dictionary.to_pylist())
        flat = np.concatenate(own) if own else np.zeros(0, np.int32)
        own_ends = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int64)
        ids, count = gather(flat, own_ends, coded.indices.to_numpy(zero_copy_only=False))
        seen = np.concatenate([[0], np.cumsum(count)])
        return ids, seen[np.searchsorted(at, ends)]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The texts of rows of ids: the pieces' texts, the space before a text taken off, bytes that are no UTF-8 replaced."""
        pieces = self.model.text
        size = np.array([len(p) for p in pieces])
        raw, count = gather(np.frombuffer(b"".join(pieces), np.uint8), np.concatenate([[0], np.cumsum(size)]), ids)
        at = np.concatenate([[0], np.cumsum(count)])[ends]
        gone = at[:-1][(np.diff(at) > 0) & self.model.prefix]
        gone = gone[raw[gone] == 32]
        rest = np.ones(len(raw), bool)
        rest[gone] = False
        texts = binary_array(np.concatenate([[0], np.cumsum(rest)])[at], raw[rest])
        try:
            return texts.cast(pa.large_string()).cast(pa.string())
        except pa.ArrowInvalid:  # ids that no text gives
            return pa.array([self.library.decode(ids[a:b].tolist()) for a, b in zip(ends, ends[1:])], pa.string())

    def check(self, texts: list[str], ids: np.ndarray, ends: np.ndarray, decoded: list[str]) -> None:
        """Compare whole texts with the library, both ways."""
        theirs = self.library.encode(texts, num_threads=1)
        for k, (text, own) in enumerate(zip(texts, theirs)):
            if own != ids[ends[k]:ends[k + 1]].tolist() or self.library.decode(own) != decoded[k]:
                raise ValueError(f"the library gives other ids or another text for {text[:200]!r}")


def _encoder(path: str) -> Encoder:
    """The Python worker's encoder: tasks that follow each other share its parts."""
    held = worker_cache().setdefault("pieces", {})
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def _run(path: str, end_id: int, whole: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            for part in rows_in(batch, SLICE_BYTES):
                column = part.column("text")
                ids, ends = encoder.encode(column)
                decoded = encoder.decode(ids, ends)
                k = min(whole, part.num_rows)
                encoder.check([t or "" for t in column[:k].to_pylist()], ids, ends, decoded[:k].to_pylist())
                rows = len(ends) - 1
                ids, ends = with_each(ids, np.diff(ends), np.ones(rows, bool), end_id, first=False)
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), pa.array(np.diff(ends)),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)), decoded,
                ], ["id", "n_tokens", "ids", "decoded"])
    return run


def encode_pieces(docs: DataFrame, id_col: str, text_col: str, model: str, end_id: int, whole: int = 4) -> DataFrame:
    """(id, n_tokens, ids, decoded) of every document.

    ``ids`` are those of the model file's vocabulary for the whole text, then
    ``end_id``; ``decoded`` is the text of these ids (the end has none).  One
    row per input row: null ids stay; a null text counts as empty and has the
    end alone; repeated rows are encoded each; other columns are not read; an
    empty table gives an empty result.  ``model`` is the path of a merge-type
    model file that executors can open; others raise ``ValueError``.

    In every Arrow batch the ids of each part that the agenda merges anew are
    compared with the sentencepiece library's, and ``whole`` texts of each
    slice of ``SLICE_BYTES`` are, both ways; a difference fails the task.  One
    pass without a shuffle."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_run(model, end_id, whole), _SCHEMA)
