"""SimHash near-duplicates: fingerprints, links and components against brute force."""
import random
import re

import numpy as np
import pytest
import xxhash

from edges import SF001, edge_docs, no_docs  # noqa: F401
from gridspark.llm import simhash as S
from gridspark.llm.components import connected_components


def slow_fingerprint(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(fps, bits):
    """fp -> smallest fp reachable."""
    fps = np.unique(np.array(fps, np.uint64))
    root = {int(f): int(f) for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, f in enumerate(fps):
        for g in fps[i + 1:][np.bitwise_count(fps[i + 1:] ^ f) <= bits]:
            a, b = sorted((find(int(f)), find(int(g))))
            root[b] = a
    return {x: find(x) for x in root}


def clustered(n, rng):
    """Fingerprints around a few centres, so that chains, hot partitions and distant pairs all occur."""
    centres = [rng.getrandbits(64) for _ in range(4)] + [0]
    out = []
    for _ in range(n):
        f = rng.choice(centres) if rng.random() < 0.8 else rng.getrandbits(64)
        for b in rng.sample(range(64), rng.randint(0, 7)):
            f ^= 1 << b
        out.append(f)
    return sorted(set(out))


def signed(x):
    return x - 2**64 if x >= 2**63 else x


@pytest.mark.parametrize("bits, parts, tile, probes", [(4, 4, 4096, 65536), (4, 4, 16, 64), (3, 4, 64, 1000), (6, 4, 4096, 65536), (4, 5, 32, 128), (1, 4, 50, 50)])
def test_no_link_is_lost(spark, monkeypatch, bits, parts, tile, probes):
    monkeypatch.setattr(S, "TILE", tile)
    monkeypatch.setattr(S, "PROBES", probes)
    monkeypatch.setattr(S, "PAIRS", 1000)
    fps = clustered(700, random.Random(bits))
    unique = spark.createDataFrame([(signed(f),) for f in fps], "fp long").repartition(3)
    links = S.fingerprint_links(unique, bits, parts)
    for u, v in links.collect():
        assert u != v
    roots = {r.node: r.root for r in connected_components(links).collect()}
    want = slow_components(fps, bits)
    groups, got = {}, {}
    for f in fps:
        groups.setdefault(want[f], set()).add(f)
        got.setdefault(roots.get(signed(f), signed(f)), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))
    assert links.count() <= 3 * parts * (1 + sum(map(len, S._masks(64 // parts, 0)))) * len(fps)  # spanning links, not all pairs


def test_thresholds_sum_to_the_goal_at_least_cost():
    rng = np.random.default_rng(1)
    parts = [list(range(i, 64, 16)) for i in range(16)][:4]
    counts = [rng.integers(0, 50, 16) for _ in parts]
    plan = S.Plan(parts, 4, counts=counts)
    fp = rng.integers(0, 2**63, 40).astype(np.uint64)
    values = [S._values(fp, p) for p in parts]
    got = plan.thresholds(values)
    assert (got.sum(1) == 4 - 4 + 1).all()
    import itertools

    def cost(row, t):
        return sum(0 if x < 0 else plan.near[i][x][values[i][row]] + S.PROBE_COST * sum(map(len, plan.masks[i][:x + 1])) for i, x in enumerate(t))
    for row in range(len(fp)):
        best = min(cost(row, t) for t in itertools.product(range(-1, plan.most + 1), repeat=4) if sum(t) == 1)
        assert cost(row, got[row]) == best


def test_fingerprints(spark):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").limit(60)
    text = dict(rows.collect())
    text |= {-1: None, -2: "", -3: " \t\n", -4: "One", -5: "one TWO", -6: "a b c d", -7: "É é É x \x0b y", -8: "a " * 70_000}
    df = spark.createDataFrame(list(text.items()), "doc_id long, text string")
    for r in S.fingerprints(df, "doc_id", "text", 4).collect():
        assert r.fp % 2**64 == slow_fingerprint(text[r.id], 4)


def test_components_of_chains_stars_and_repeats(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 2000 + i) for i in range(500)]
    links = chain + star + star[:50] + [(v, u) for u, v in chain[:20]] + [(5000, 5000), (None, 1), (7000, None)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 1000: 1000, **{2000 + i: 1000 for i in range(500)}}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_edges(spark, edge_docs, no_docs):
    found = S.near_duplicates(edge_docs, "doc_id", "text")
    rows = found.collect()
    assert len(rows) == edge_docs.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    zero = "0" * 16
    assert by_id[2] == by_id[3] == by_id[4] == {(zero, 2)}  # null, empty and blank texts link like any other
    assert {c for _, c in by_id[1] | by_id[6]} == {1} and 1 in {c for _, c in by_id[7]}
    assert all(re.fullmatch("[0-9a-f]{16}", f) for s in by_id.values() for f, _ in s)
    kept = S.keep_one(edge_docs, found, "doc_id", "text")
    assert kept.columns == edge_docs.columns
    ids = sorted((r.doc_id for r in kept.collect() if r.doc_id is not None))
    assert ids == [1, 2, 5, 7, 8, 9, 10]  # of the rows of 7 two are in the component of 1, the third stands alone
    assert kept.filter("doc_id is null").count() == 2
    assert S.near_duplicates(no_docs, "doc_id", "text").count() == 0
    assert S.keep_one(no_docs, S.near_duplicates(no_docs, "doc_id", "text"), "doc_id", "text").count() == 0


def test_of_rows_that_repeat_an_id_one_stays(spark):
    rows = [(1, "aa bb cc dd ee"), (1, "aa bb cc dd ee"), (2, "quite other words stand in here"), (2, "nothing like the first at all no"),
            (2, "nothing like the first at all no")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = S.keep_one(docs, S.near_duplicates(docs, "doc_id", "text"), "doc_id", "text")
    assert sorted(map(tuple, kept.collect())) == sorted({*rows})  # copies of a row count once, other texts stay


def test_repeated_ids_lose_no_group(spark):
    a, b = "the quick brown fox jumps over the lazy dog again and again", "entirely other words stand in this second text of ours today"
    rows = [(5, a), (5, b), (3, b), (9, a), (7, "yet another text that nothing else here resembles at all"), (7, b), (7, b), (8, None), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = S.near_duplicates(docs, "doc_id", "text")
    kept = sorted((r.doc_id, r.text or "") for r in S.keep_one(docs, found, "doc_id", "text").collect())
    assert kept == sorted([(5, a), (3, b), (7, rows[4][1]), (8, "")])
