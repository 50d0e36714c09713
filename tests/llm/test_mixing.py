"""Source mixing: targets against repeated resharing, exact quotas, words near the targets."""
from collections import Counter

import pytest
from edges import SF01, edge_docs, no_docs  # noqa: F401
from pyspark.sql import functions as F

from gridspark.llm import mixing as M


def brute_targets(sizes, most=3):
    order = sorted(sizes, key=lambda s: (s is None, "" if s is None else s.encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, capped = float(sum(sizes.values())), {}
    while True:
        free = [s for s in order if s not in capped]
        left, w = total - sum(capped.values()), sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / w > most * sizes[s] + 1e-9]
        if not over:
            return capped | {s: left * weight[s] / w for s in free}
        capped |= {s: float(most * sizes[s]) for s in over}


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1, "c": 1000, "d": 10, None: 5}, {"a": 7}, {"x": 0, "y": 10, "z": 3},
    {f"s{i}": (i * 7919) % 997 for i in range(40)}, {"é": 5, "z": 5, "Z": 900, "": 50, None: 1}, {"a": 0, None: 0}])
def test_targets(spark, sizes):
    rows = [(s, n // 2) for s, n in sizes.items()] + [(s, n - n // 2) for s, n in sizes.items()]
    got = {r.source: r.target for r in M.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    want = brute_targets(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0.0)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


@pytest.mark.parametrize("quotas, shards", [([10, 0, 7, 900], 8), ([3], 5), ([0, 0], 4), ([5, 5, 5], 1), ([1, 2], 16), ([], 3)])
def test_tree_splits_exact_quotas(spark, quotas, shards):
    df = spark.createDataFrame([(quotas,)], "quotas array<long>")
    rows = {r.shard: r.quotas for r in M.shard_quotas(df, shards).collect()}
    assert sorted(rows) == list(range(shards))
    assert [sum(q[i] for q in rows.values()) for i in range(len(quotas))] == quotas
    totals = [sum(q) for q in rows.values()]
    assert min(min(q, default=0) for q in rows.values()) >= 0 and max(totals) - min(totals) <= 1
    assert rows == {r.shard: r.quotas for r in M.shard_quotas(df, shards).collect()}


def test_draws_are_hypergeometric(spark):
    """Over many seeds the left share of a source has the hypergeometric mean and variance."""
    df = spark.createDataFrame([([30, 70],)], "quotas array<long>")
    seeds = spark.range(400).crossJoin(df)
    left = seeds.select(M._split(F.col("quotas"), F.col("id") + 2, F.lit(40).cast("long"), 9).alias("q")).collect()
    x = [r.q[0] for r in left]
    assert all(sum(r.q) == 40 for r in left)
    mean = sum(x) / len(x)
    var = sum((v - mean) ** 2 for v in x) / len(x)
    assert abs(mean - 12) < 0.6 and abs(var - 40 * .3 * .7 * 60 / 99) < 1.5


def taken(spark, docs, **kw):
    return M.taken_words(M.plan_mix(docs, "doc_id", "text", "source", **kw), "doc_id")


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    for block in (256, 8):
        rows = taken(spark, docs, block_docs=block).collect()
        assert len(rows) == docs.count()
        source = {r.doc_id: (r.source, len((r.text or "").encode().split())) for r in docs.collect()}
        sizes, got, target, largest = Counter(), Counter(), {}, Counter()
        for r in rows:
            s, n = source[r.doc_id]
            assert r.size == n and r.taken == n * len(r.shards) and len(r.shards) <= 3
            sizes[s] += n
            got[s] += r.taken
            target[s] = r.target
            largest[s] = max(largest[s], n)
            assert 0 <= min(r.shards, default=0) and max(r.shards, default=0) < M.SHARDS
        want = brute_targets(sizes)
        for s in want:
            assert abs(target[s] - want[s]) < 1e-6
            assert abs(got[s] - want[s]) <= (10 if block == 256 else largest[s])
        again = taken(spark, docs.repartition(7), block_docs=block).collect()
        assert sorted(map(str, again)) == sorted(map(str, rows))


def test_native_plan(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    df = taken(spark, docs)
    assert not any(x in df._jdf.queryExecution().toString() for x in ("Python", "Pandas", "InArrow"))


def test_mixed_rows_are_the_copies(spark, edge_docs, no_docs):
    mix = M.plan_mix(edge_docs, "doc_id", "text", "source", block_docs=2, shards=3)
    plan = M.taken_words(mix, "doc_id").collect()
    rows = M.mixed_rows(edge_docs, mix, "doc_id", "text", "source")
    assert rows.columns == edge_docs.columns
    assert len(plan) == edge_docs.count()
    assert Counter(r.doc_id for r in rows.collect()) == +Counter({i: sum(len(r.shards) for r in plan if r.doc_id == i) for i in {r.doc_id for r in plan}})
    assert all(r.taken <= 3 * r.size for r in plan)
    empty = M.plan_mix(no_docs, "doc_id", "text", "source")
    assert M.taken_words(empty, "doc_id").count() == 0 and M.mixed_rows(no_docs, empty, "doc_id", "text", "source").count() == 0


def test_word_count(spark):
    texts = [None, "", " ", "a", " a\tb\x0bc\n\nd ", "é f g\x1ch", "x" * 10_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", M.word_count(F.col("text")).alias("n")).collect()
    assert {r.i: r.n for r in rows} == {i: len((t or "").encode().split()) for i, t in enumerate(texts)}


def test_many_sources_and_large_quotas(spark):
    """The tree's work grows with the square root of the draws; a million draws are split exactly."""
    import time
    quotas = [(i * 7919) % 5000 for i in range(1000)] + [1_000_000]
    t0 = time.perf_counter()
    rows = M.shard_quotas(spark.createDataFrame([(quotas,)], "quotas array<long>"), 16).collect()
    assert [sum(r.quotas[i] for r in rows) for i in range(len(quotas))] == quotas
    assert time.perf_counter() - t0 < 60  # one draw after the other took over a second a million draws and level
    share = [r.quotas[-1] / sum(r.quotas) for r in rows]
    assert max(share) - min(share) < 0.01


def test_partial_blocks_come_near_their_targets(spark):
    """A greedy fill and the best exchange, against every exchange."""
    import random
    rng = random.Random(4)
    docs, want = [], {}
    for k in range(12):
        sizes = [(rng.getrandbits(60), rng.choice([0, 1, 7, rng.randint(1, 900)])) for _ in range(rng.randint(1, 40))]
        want[k] = rng.randint(0, sum(n for _, n in sizes))
        docs += [(k, 3, want[k], u, n) for u, n in sizes]
    df = spark.createDataFrame(docs, "k int, block long, want long, unit long, size long")
    got = {r.k: r.picked for r in M._fill(df).collect()}
    assert sorted(got) == list(range(12))
    for k in got:
        own = sorted((u, n) for q, _, _, u, n in docs if q == k)
        inside, total = [], 0
        for u, n in own:
            if total + n <= want[k]:
                inside.append((u, n))
                total += n
        outside = [x for x in own if x not in inside]
        best = min(abs(want[k] - total + x - y) for x in [0, *(n for _, n in inside)] for y in [0, *(n for _, n in outside)])
        size = dict(own)
        assert len(set(got[k])) == len(got[k]) and abs(want[k] - sum(size[u] for u in got[k])) == best
