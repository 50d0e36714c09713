"""Benchmark decontamination against exact containment by brute force."""
import random

import numpy as np
import pytest

from edges import edge_docs, no_docs  # noqa: F401
from gridspark.llm import decontam as D


def shingles(text, k=5):
    w = D.words(text)
    return {b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(docs, items, least=0.8):
    out = []
    for d, t in docs:
        s = shingles(t)
        for i, x in items:
            q = shingles(x)
            n = len(q & s)
            if q and n >= least * len(q):
                out.append((d, i, n, len(q), n / len(q)))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 4, 5, 6, 9, 20, 40, 120]))) for i in range(60)] + [(100, None), (101, ""), (102, "!!"), (103, "W1, w2? W3 w4 w5!")]
    items += [(104, items[5][1]), (105, items[5][1].upper())]
    docs = []
    for d in range(200):
        t = text(rng.choice([0, 2, 30, 300, 3000])).split()
        for _ in range(rng.randint(0, 2)):
            q = (rng.choice(items)[1] or "").split()
            if q and rng.random() < 0.5:
                q[rng.randrange(len(q))] = "changed"
            at = rng.randint(0, len(t))
            t[at:at] = q
        docs.append((d, " ".join(t).replace(" w3 ", " W3, ")))
    docs += [(500, items[1][1]), (500, items[1][1]), (501, None), (None, items[8][1]), (502, text(100_000) + " " + items[7][1])]
    return docs, items


@pytest.mark.parametrize("block", [4096, 7])
def test_every_contained_item_is_found(spark, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_ITEMS", block)
    monkeypatch.setattr(D, "SLICE_BYTES", 5000)
    docs, items = corpus()
    index = D.build_index(spark.createDataFrame(items, "item_id int, text string").coalesce(1), "item_id", "text")
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, id string, hashes int").repartition(3)
    got = D.find_contaminated(df, index, "doc_id", "text").collect()
    want = brute(docs, items)
    assert len(want) > 80
    assert sorted(map(tuple, got), key=str) == want
    clean = D.drop_contaminated(df, index, "text")
    assert clean.columns == df.columns
    hit = {str(d) for d, *_ in want}
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(d) for d, _ in docs if str(d) not in hit)


def test_recall_of_the_search_alone():
    """Candidates before verification: an item of any size inside documents of any class."""
    rng = np.random.default_rng(7)
    found = total = 0
    for n in (50, 1000, 40_000):
        doc = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for q in (1, 2, 5, 30):
            for _ in range(20):
                item = rng.choice(doc, q, replace=False)
                cls = D.size_class(len(doc))
                hit = any(set(doc[D.bin_minima(doc, cls, r)].tolist()) & set(item[D.bin_minima(item, cls, r)].tolist()) for r in range(D.PERMUTATIONS))
                found, total = found + hit, total + 1
    assert found >= 0.99 * total


def test_signatures_are_the_minima_of_each_set():
    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (0, 1, 2, 700, 20_000)] + [np.full(9, 5, np.uint64)]
    row, h, minimum = D.signatures(sets)
    for i, own in enumerate(map(np.unique, sets)):
        assert sorted(h[row == i].tolist()) == own.tolist()
        best = np.zeros(len(own), bool)
        for r in range(D.PERMUTATIONS):
            best |= D.bin_minima(own, D.size_class(len(own)), r)
        assert sorted(h[(row == i) & minimum].tolist()) == own[best].tolist()
    assert 0 < (~minimum).sum() < 0.005 * len(h)


def test_no_item_of_one_shingle_is_lost(spark):
    """Every shingle of a long text as an item of its own, those behind all minima included."""
    text = " ".join(f"w{i * i % 9973}" for i in range(12_000))
    own = sorted(shingles(text))
    _, h, minimum = D.signatures([np.unique(D.shingle_hashes(D.words(text), 5))])
    assert (~minimum).any()  # some are the smallest of no bin
    items = spark.createDataFrame([(i, x.decode()) for i, x in enumerate(own)], "item_id int, text string")
    docs = spark.createDataFrame([(1, text), (2, "nothing of it")], "doc_id long, text string")
    got = D.find_contaminated(docs, D.build_index(items, "item_id", "text"), "doc_id", "text").collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, i) for i in range(len(own))]


@pytest.mark.parametrize("held", [0, 1, 3])
def test_blocks_that_are_not_kept_are_read_again(spark, monkeypatch, held):
    monkeypatch.setattr(D, "BLOCK_ITEMS", 5)
    monkeypatch.setattr(D, "HELD_BLOCKS", held)
    docs, items = corpus()
    index = D.build_index(spark.createDataFrame(items, "item_id int, text string").coalesce(1), "item_id", "text")
    matcher = D.Matcher(index, 0.8)
    small = [d for d in docs if len(d[1] or "") < 3000]
    for part in (small[:40], small[40:]):
        got = sorted(((part[r][0], *x) for r, *x in matcher.find([t for _, t in part])), key=str)
        assert got == [(d, i, n, k) for d, i, n, k, _ in brute(part, items)]
    assert len(matcher.held) == held


def test_edges(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "more of them follow after that"), (2, None)], "item_id long, text string")
    index = D.build_index(items, "item_id", "text")
    got = D.find_contaminated(edge_docs, index, "doc_id", "text").collect()
    assert sorted(r.doc_id for r in got) == [1, 6, 7, 7]
    assert D.drop_contaminated(edge_docs, index, "text").count() == edge_docs.count() - 4
    assert D.find_contaminated(no_docs, index, "doc_id", "text").count() == 0
    nothing = D.build_index(spark.createDataFrame([], "item_id long, text string"), "item_id", "text")
    assert D.find_contaminated(edge_docs, nothing, "doc_id", "text").count() == 0
    assert D.drop_contaminated(edge_docs, nothing, "text").count() == edge_docs.count()
