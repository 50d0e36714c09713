"""Token files: exact round trips against the tokenizers library."""
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from edges import edge_docs, no_docs  # noqa: F401
from gridspark.llm import token_bin as B
from gridspark.llm.common import run_dir

PATH = P.path("byte_bpe_50k.json")
ENCODER = B.Encoder(PATH, 2)


@given(st.lists(st.integers(0, 10**12), min_size=1, max_size=1500), st.sampled_from([1, 7, 10**6]))
@settings(max_examples=60, deadline=None)
def test_elias_fano(values, scale):
    v = np.sort(np.array(values) // scale)
    raw = memoryview(b"xy" + B.EliasFano.encode(v).dump() + b"z")
    ef, at = B.EliasFano.load(raw, 2)
    assert bytes(raw[at:]) == b"z" and ef.decode().tolist() == v.tolist()
    assert [ef.select(i) for i in range(len(v))] == v.tolist()


def test_elias_fano_empty_and_size():
    assert len(B.EliasFano.load(memoryview(B.EliasFano.encode(np.zeros(0)).dump()), 0)[0].decode()) == 0
    v = np.cumsum(np.random.default_rng(1).integers(1, 800, 20_000))
    assert len(B.EliasFano.encode(v).dump()) * 8 / len(v) < 2 + np.log2(v[-1] / len(v)) + 1


def encoded(encoder, texts):
    """The ids of each text, as bytes."""
    ids, ends = encoder.encode(pa.array(texts, pa.string()))
    assert ids.dtype == np.dtype("<u2")
    return [ids[a:b].tobytes() for a, b in zip(ends, ends[1:])]


def test_parts_encode_as_the_whole_text():
    e = B.Encoder(PATH, 2)
    assert e.by_part
    rng = random.Random(3)
    texts = ["", " ", "a  b", "a\nb", "\n a\n\nb \n", "it's don't", "x.\n Y", "<|endoftext|>a <|endoftext|>", "é é. x", "a b　c", "²³ a² ⅷ.", "a\x1cb c\x1c d",
             "it'sure'll 'tis !'s ''s 1's é's s'é", "\n\ny", "\n\n y", "\t\t", "x\r\n\r\ny", "1a1 a1a", "\x00 \x00a", "a" * 500 + "1" * 500, None]
    texts += ["".join(rng.choice("ab .\n,'é1 \t! sA\r²—日\x1f\x7f") for _ in range(rng.randint(1, 40))) for _ in range(6000)]
    texts += ["".join(rng.choice(["a", "'", "'s", "'ll", "'D", " ", "1", "!", "\n", "  ", "ü"]) for _ in range(rng.randint(1, 20))) for _ in range(6000)]
    want = [np.array(x.ids, "<u2").tobytes() for x in e.tk.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert encoded(e, texts) == want
    assert encoded(e, texts) == want  # from the remembered parts


@given(st.lists(st.text(max_size=30), max_size=6))
@settings(max_examples=200, deadline=None)
def test_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert encoded(ENCODER, texts) == [np.array(ENCODER.tk.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]


def test_forgotten_parts_are_encoded_anew():
    e = B.Encoder(PATH, 2)
    e.parts = B.Recent(4)
    texts = ["some words of a text, and others", "others and some words"] * 3
    assert encoded(e, texts) == encoded(ENCODER, texts)
    assert len(e.parts.young) <= 2 and len(e.parts.old) <= 2


def test_other_tokenizers_encode_whole_texts():
    e = B.Encoder(P.path("word_bpe_49k.json"), 2)
    assert not e.by_part
    assert np.frombuffer(encoded(e, ["Some  text"])[0], "<u2").tolist() == e.tk.encode("Some  text", add_special_tokens=False).ids


@pytest.mark.parametrize("vocabulary", [50_257, 100_000])
def test_round_trip(spark, edge_docs, vocabulary):
    root, manifest = B.write_tokens(edge_docs, "doc_id", "text", PATH, 2, vocabulary)
    rows = sorted(B.read_tokens(spark, root, manifest, "doc_id", with_ids=True).collect(), key=lambda r: r.start)
    tk = B.Encoder(PATH, 2).tk
    given_ = sorted((r.doc_id is not None, r.doc_id or 0, tk.encode(r.text or "", add_special_tokens=False).ids + [2])
                    for r in edge_docs.select("doc_id", "text").collect())
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids) for r in rows) == given_
    at, last = 0, (False, 0)
    for r in rows:
        assert r.start == at and (r.doc_id is not None, r.doc_id or 0) >= last
        assert r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at, last = at + len(r.ids), (r.doc_id is not None, r.doc_id or 0)
    shard = B.Shard(root, manifest.first().file)
    assert shard.width == (2 if vocabulary < 1 << 16 else 4)
    i = shard.n - 1
    assert shard.tokens(i).tolist() in [r.ids for r in rows] and shard.offsets(i)[1] == shard.n_tokens


def test_empty_table_and_negative_ids(spark, no_docs):
    root, manifest = B.write_tokens(no_docs, "doc_id", "text", PATH, 2, 50_257)
    assert B.read_tokens(spark, root, manifest, "doc_id").count() == 0
    docs = spark.createDataFrame([(-2**63, "a"), (5, "b c"), (2**63 - 1, None)], "doc_id long, text string")
    root, manifest = B.write_tokens(docs, "doc_id", "text", PATH, 2, 50_257)
    got = [(r.doc_id, r.start, r.n_tokens) for r in B.read_tokens(spark, root, manifest, "doc_id").orderBy("start").collect()]
    assert got == [(-2**63, 0, 2), (5, 2, 3), (2**63 - 1, 5, 1)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_added_tokens_encode_as_in_a_fresh_tokenizer(name):
    from tokenizers import Tokenizer
    fresh, e = Tokenizer.from_file(P.path(name)), B.Encoder(P.path(name), 2)
    rng = random.Random(5)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "x<|endoftext|>\n y", "<|endoftext|> <|endoftext|>  ", "<|endoftext", "it<|endoftext|>'s"]
    texts += ["".join(rng.choice(["a", "b", " ", "  ", "\n", ".", "'s", "é", "1", "<|endoftext|>", "<|", "endoftext", "|>"]) for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    want = [np.array(fresh.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    assert encoded(e, texts) == want and encoded(e, texts) == want
    if name.startswith("byte"):
        assert np.frombuffer(encoded(e, ["a <|endoftext|> b"])[0], "<u2").tolist().count(50256) == 1


def test_folders_have_the_scheme_that_spark_resolves(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    plain, manifest = B.write_tokens(docs, "doc_id", "text", PATH, 2, 50_257, root=str(tmp_path / "ids"))
    assert plain == f"file:{tmp_path}/ids"
    assert sorted(r.doc_id for r in B.read_tokens(spark, plain, manifest, "doc_id").collect()) == [1, 2]
    assert run_dir(spark, "x").split(":")[0] == "file"


def test_a_task_lets_go_of_the_batches_it_has_written(monkeypatch, tmp_path):
    import io
    import tracemalloc
    from types import SimpleNamespace

    import pyspark
    monkeypatch.setattr(pyspark, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0, taskAttemptId=lambda: 0)))
    texts = ["some words " * 200] * 400  # 0.9 MB a batch, in one buffer with its ids as Spark sends it
    schema = pa.schema([("id", pa.int64()), ("text", pa.string())])
    made, held = io.BytesIO(), []
    with pa.ipc.new_stream(made, schema) as w:
        for k in range(12):
            ids = [None if k == 0 and i < 3 else 400 * k + i for i in range(400)]
            w.write_batch(pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts)], schema=schema))
    made.seek(0)

    def batches():
        for batch in pa.ipc.open_stream(made):
            yield batch
            held.append(tracemalloc.get_traced_memory()[0])  # a batch's bytes are Python's

    tracemalloc.start()
    try:
        out = list(B._write(str(tmp_path), PATH, 2, 2)(batches()))
    finally:
        tracemalloc.stop()
    assert len(held) == 12 and max(held) - held[0] < 2_000_000
    row = out[0].to_pylist()[0]
    assert (row["n_docs"], row["n_null"], row["least"]) == (4800, 3, 3)
    shard = B.Shard(str(tmp_path), row["file"])
    assert [i for _, ids, _ in shard.documents(row["least"]) for i in ids] == [None] * 3 + list(range(3, 4800))


def test_the_library_gets_a_bounded_number_of_parts(monkeypatch):
    monkeypatch.setattr(B, "LIBRARY_PARTS", 5)
    e, asked = B.Encoder(PATH, 2), []
    library = e._library
    e._library = lambda parts: asked.append(len(parts)) or library(parts)
    texts = [f"text {i} of many, number{i} x{i}y" for i in range(50)] + ["", None]
    assert encoded(e, texts) == encoded(ENCODER, texts)
    assert max(asked) == 5 and sum(asked) > 50
