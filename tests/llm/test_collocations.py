"""Collocations against brute force, whatever the sample proposes."""
import random
import re
from collections import Counter
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from edges import edge_docs, no_docs  # noqa: F401
from gridspark.llm import collocations as C


def brute(rows, least, longest, absorbed, top):
    """The contract on (lang, text) rows."""
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    counts[lang, tuple(w[i:i + k])] += 1
    often = {x: a for x, a in counts.items() if a >= least}
    out = []
    for lang in sorted(total):
        own = {p: a for (g, p), a in often.items() if g == lang}
        mine = {p: a for p, a in own.items() if len(p) > 1}
        scored = []
        for p, a in mine.items():
            if any(100 * b >= absorbed * a and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in mine.items()):
                continue
            s, k = min((1000 * a * total[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-s, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, total[lang], -s))
    return out


def corpus(seed, n=160):
    """Texts of few words with passages that several share."""
    rng = random.Random(seed)
    words = ["the", "Of", "and", "red", "sun", "über", "ß", "a\x00b", "x\xa0y", "\x1c", "to", "by"]
    passages = [[rng.choice(words) for _ in range(rng.randint(3, 9))] for _ in range(6)]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts += rng.choice(passages) if rng.random() < .4 else [rng.choice(words) for _ in range(rng.randint(1, 6))]
            if rng.random() < .5:
                parts[-1] += rng.choice([".", ",", "\n", " ? ", "\t\t", "\r\n", "..."])
        rows.append((rng.choice(["en", "de", None, ""]), " ".join(parts) if rng.random() < .95 else None))
    return rows


def mined(spark, rows, *args, **how):
    docs = spark.createDataFrame([(i, g, t) for i, (g, t) in enumerate(rows)], "doc_id long, lang string, text string").repartition(3)
    got = C.collocations(docs, "doc_id", "lang", "text", *args, **how)
    assert [t for _, t in got.dtypes] == ["string", "bigint", "string", *["bigint"] * 5]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("share, bits", [(1 / 8, 27), (1.0, 27), (1e-9, 20), (0.3, 15)])
def test_whatever_the_sample_proposes(spark, share, bits):
    rows = corpus(5)
    for least, longest, absorbed, top in [(8, 5, 100, 2000), (3, 4, 60, 5)]:
        assert mined(spark, rows, least, longest, absorbed, top, share=share, bits=bits) == sorted(brute(rows, least, longest, absorbed, top))


def test_failures_of_the_border_are_followed(spark, monkeypatch):
    staged = []
    real = C.stage
    monkeypatch.setattr(C, "stage", lambda df, what: staged.append(what) or real(df, what))
    rows = corpus(2)
    docs = spark.createDataFrame([(i, g, t) for i, (g, t) in enumerate(rows)], "doc_id long, lang string, text string")
    some = C.frequent_phrases(docs, "doc_id", "lang", "text", 5, share=1e-9)
    assert staged == ["phrases", "phrases-more"]  # nothing was proposed: words alone were counted at first
    whole = C.frequent_phrases(docs, "doc_id", "lang", "text", 5, share=1.0, lowered=1.0)
    assert staged[2:] == ["phrases"]  # the whole as sample fails nowhere
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, whole.collect()))


def test_filter_holds_what_was_put_in(spark):
    rng = np.random.default_rng(1)
    own = rng.integers(-2**63, 2**63, 3000)
    flags = C.build_filter(spark.createDataFrame([(int(x),) for x in own], "h long"), 20)
    assert len(flags) == 1 << 17 and C._member(flags, own.view(np.uint64)).all()
    assert C._member(flags, rng.integers(-2**63, 2**63, 20_000).view(np.uint64)).mean() < .01
    none = C.build_filter(spark.createDataFrame([], "h long"), 12)
    assert len(none) == 512 and not none.any()


def test_phrases_hash_alike_in_texts_and_rows():
    own = C.Slice("en", pa.array(["a B ß. c", None, "x"]))
    word = own.hashes()
    two = C._longer(word[:-1], word[1:])
    batch = pa.RecordBatch.from_pylist([{"lang": "en", "phrase": p} for p in ("a", "b", "ß", "a b", "b ß", "x")])
    got = next(C._hash_phrases(iter([batch]))).column("h").to_numpy().view(np.uint64).tolist()
    assert got == [*word[:3].tolist(), *two[:2].tolist(), word[4]]
    assert own.fits(2).tolist() == [True, True, False, False] and own.fits(3).tolist() == [True, False, False]


def test_scores_beyond_64_bits(spark):
    rows = [(10**12, 10**15 + 7, 10**12 + 1, 10**12 + 3), (1, 1, 1, 1), (3 * 10**9, 10**14, 10**13, 7 * 10**12), (100, 10**16, 100, 100)]
    df = spark.createDataFrame(rows, "a long, n long, l long, r long")
    assert [r[0] for r in df.select(C.cut_score("a", "n", "l", "r")).collect()] == [1000 * a * n // (x * y) for a, n, x, y in rows]
    assert isinstance(df.select(F.col("a").cast("decimal(20,0)")).first()[0], Decimal)


def test_edges(spark, edge_docs, no_docs):
    rows = [(r.lang, r.text) for r in edge_docs.collect()]
    got = C.collocations(edge_docs, "doc_id", "lang", "text", 2, share=.5)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, 2, 5, 100, 2000))
    assert C.collocations(no_docs, "doc_id", "lang", "text").count() == 0
