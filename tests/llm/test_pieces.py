"""Merge-type encoding and decoding against the sentencepiece library."""
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from edges import SF01, edge_docs, no_docs  # noqa: F401
from gridspark.llm import pieces as X
from gridspark.llm import queries as Q
from gridspark.llm.common import Recent

PATH = P.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
ENCODER = X.Encoder(PATH)


def both_ways(texts):
    ids, ends = ENCODER.encode(pa.array(texts, pa.string()))
    decoded = ENCODER.decode(ids, ends).to_pylist()
    return [ids[a:b].tolist() for a, b in zip(ends, ends[1:])], decoded


def check(texts):
    ids, decoded = both_ways(texts)
    want = LIBRARY.encode([t or "" for t in texts])
    assert ids == want and decoded == [LIBRARY.decode(w) for w in want]


def test_spaces_bytes_and_marks():
    check(["", " ", "  ", "   a", "a  b ", "▁", "▁▁x ▁", "a\tb\nc\r\n", "\x00", "é é café ,", "ﬁ ２", "日本語 12345 Ⅷ", "😀😀 x😀",
           "<s></s><unk><0x41>", "a\xa0b　c", "​﻿x", None, "ȦȦ" * 50, " " * 100, "the " * 300, "x" * 3000])


@given(st.lists(st.text(max_size=40), max_size=8))
@settings(max_examples=150, deadline=None)
def test_any_text(texts):
    check([t.encode("utf-8", "ignore").decode() for t in texts])


def test_symbols_that_compete():
    rng = random.Random(7)
    made = ["a", "b", "e", " ", "  ", "\n", "t", "h", "in", "g", "1", ".", ",", "'", "the", "▁", "é", "日", "ing", "ss", "er", "—"]
    check(["".join(rng.choice(made) for _ in range(rng.randint(0, 60))) for _ in range(4000)])


def test_parts_are_merged_alike_whatever_was_remembered():
    own = X.Encoder(PATH)
    own.parts = Recent(4)  # nearly everything is forgotten
    texts = ["the thing in the ring", "ring the thing", "the the the"] * 3
    assert own.encode(pa.array(texts))[0].tolist() == ENCODER.encode(pa.array(texts))[0].tolist()
    assert len(own.parts.young) <= 2 and len(own.parts.old) <= 2


def test_ids_that_no_text_gives_decode_as_in_the_library():
    rng = np.random.default_rng(3)
    rows = [rng.integers(0, 32_000, rng.integers(0, 12)).tolist() + [3 + int(rng.integers(128, 256))] for _ in range(200)]
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    assert ENCODER.decode(np.concatenate(rows).astype(np.int32), ends).to_pylist() == [LIBRARY.decode(r) for r in rows]


def test_a_difference_from_the_library_fails(monkeypatch):
    own = X.Encoder(PATH)
    monkeypatch.setattr(own.model, "encode", lambda text: [5])
    with pytest.raises(ValueError, match="the library"):
        own.encode(pa.array(["some words"]))


def test_other_vocabularies_are_refused(tmp_path):
    with open(PATH, "rb") as f:
        raw = f.read()
    # the trainer's field 3 (the kind of model): 1 is the unigram model
    changed = raw.replace(b"\x12\x06tok_v0\x18\x02", b"\x12\x06tok_v0\x18\x01")
    assert changed != raw
    (tmp_path / "other.model").write_bytes(changed)
    with pytest.raises(ValueError, match="merge type"):
        X.PieceModel(str(tmp_path / "other.model"))


def test_query_equals_the_library(spark):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()
    want = set()
    for r in rows:
        ids = LIBRARY.encode(r.text or "", add_eos=True)
        want.add((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids))))
    got = Q.op12_sentencepiece_bpe(spark, SF01).collect()
    assert len(got) == len(rows) and {tuple(r) for r in got} == want


def test_edges(spark, edge_docs, no_docs):
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted(((r.id, r.ids, r.n_tokens, r.decoded) for r in X.encode_pieces(edge_docs, "doc_id", "text", PATH, 2).collect()), key=key)
    rows = [(r.doc_id, LIBRARY.encode(r.text or "", add_eos=True)) for r in edge_docs.collect()]
    assert got == sorted(((i, ids, len(ids), LIBRARY.decode(ids)) for i, ids in rows), key=key)
    assert X.encode_pieces(no_docs, "doc_id", "text", PATH, 2).count() == 0
