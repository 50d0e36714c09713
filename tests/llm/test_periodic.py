"""Periodic runs against a brute-force search."""
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from edges import SF001, edge_docs, no_docs  # noqa: F401
from gridspark.llm import periodic as R
from gridspark.llm import queries as Q


def brute(words, least):
    """Rows (start, end, period): every diagonal word by word, the least period of a stretch."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                found.setdefault((i - q, j), q)
            i = max(j, i + 1)
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def names(words):
    return np.unique(np.array(words), return_inverse=True)[1] if len(words) else np.zeros(0, np.int64)


def found(words, least):
    return [tuple(map(int, r)) for r in R.find_runs(names(words), least)]


@given(st.lists(st.integers(0, 2), max_size=120), st.sampled_from([2, 5, 12]))
@settings(max_examples=150, deadline=None)
def test_runs_of_few_words(words, least):
    assert found(words, least) == brute(words, least)


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_repetitive_sequences(seed):
    rng = random.Random(seed)
    for _ in range(60):
        words = [rng.randrange(rng.choice([1, 2, 4, 40])) for _ in range(rng.randint(1, 240))]
        for _ in range(rng.randint(0, 3)):  # periodic stretches inside one another
            a, b, p = rng.randrange(len(words)), rng.randint(1, len(words)), rng.randint(1, 60)
            words[a:b] = [words[a + (i - a) % p] if a + (i - a) % p < len(words) else 0 for i in range(a, b)]
        assert found(words, 12) == brute(words, 12)


def test_long_repetitive_texts_take_little_work():
    one = R.find_runs(np.zeros(200_000, np.int64), 12)
    assert one.tolist() == [[0, 200_000, 1]]
    twice = R.find_runs(np.array(([0] * 50_000 + [1]) * 2), 12)
    assert twice.tolist() == [[0, 50_000, 1], [0, 100_002, 50_001], [50_001, 100_001, 1]]


def expected(doc_id, text):
    """The contract's row, from words and a brute-force search."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and n and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words, 12)
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    best = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    top = (None,) * 4 if best is None else (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2])
    return (doc_id, len(runs), *top, sha("".join(f"{s},{e - s},{q}\n" for s, e, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in Q.op13_periodic_runs(spark, SF001).collect()]
    want = [expected(*r) for r in rows if len(r.text or "") < 12_000]
    assert len(got) == len(rows) and not set(want) - set(got)
    assert sum(w[1] > 0 for w in want) > 10 and max(w[1] for w in want) > 1


def test_edges(spark, edge_docs, no_docs):
    got = R.periodic_runs(edge_docs, "doc_id", "text")
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    assert sorted(((r.id, r.n_words) for r in got.collect()), key=key) == sorted(((i, len(w)) for i, w in words), key=key)
    small = {(i, " ".join(w)): [(s, e - s, q) for s, e, q in brute(w, 12)] for i, w in words if len(w) < 2000}
    for r in got.filter("n_words < 2000").collect():
        assert [tuple(x) for x in r.runs] == small[r.id, r.collapsed]
    assert R.periodic_runs(no_docs, "doc_id", "text").count() == 0


def test_runs_do_not_cross_texts(spark):
    docs = spark.createDataFrame([(1, "a b " * 5), (2, "a b " * 5), (3, "a b " * 6), (4, "x " * 11), (5, "x " * 12)], "doc_id long, text string")
    got = {r.id: ([tuple(x) for x in r.runs], r.collapsed) for r in R.periodic_runs(docs.coalesce(1), "doc_id", "text").collect()}
    assert got[1] == got[2] == ([], "a b a b a b a b a b") and got[4] == ([], " ".join("x" * 11))
    assert got[3] == ([(0, 12, 2)], "a b") and got[5] == ([(0, 12, 1)], "x")
