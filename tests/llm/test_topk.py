"""Exact top-k against brute force."""
import math

import numpy as np
import pytest

from gridspark.llm import topk as T

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k):
    rows = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, _ in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    seen = set()
    for q, a in rows:
        if q % 50 or (q, tuple(a)) in seen:
            continue
        seen.add((q, tuple(a)))
        best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in rows if i != q and len(a) == len(b))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def run(spark, rows, k=5, schema=SCHEMA, parts=3, tile=T.TILE):
    v = T.scaled(spark.createDataFrame(rows, schema).repartition(parts), "vec_id", "embedding", 256.0)
    return sorted(tuple(r) for r in T.top_k(v, v.filter("id % 50 = 0"), k, tile=tile).collect())


def test_brute_force_with_ties(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8)], 0) for i in range(160)]
    rows += [(i, rows[3][1], 0) for i in range(160, 220)]  # a third of copies
    assert run(spark, rows, tile=16) == brute(rows, 5)


def test_edges(spark):
    rows = [(0, [1.0, 2.0], 1), (50, None, 1), (100, [1.0, float("nan")], 1), (150, [1.0, None], 1), (200, [], 1), (None, [1.0, 1.0], 1),
            (1, [float("inf"), 0.0], 1), (2, [0.5, 0.25], None), (2, [0.5, 0.25], None), (250, [1.0], 1), (3, [-1.0, 1.0], 1), (0, [1.0, 2.0], 1)]
    assert run(spark, rows) == brute(rows, 5)
    assert run(spark, [], parts=1) == []
    assert run(spark, [(0, [1.0], 1)]) == []


@pytest.mark.parametrize("size", [1e4, 1e5])
def test_large_components(spark, size):
    rows = [(i, [size * (i + 1), -size * i, size / 3], 0) for i in range(60)]
    v = T.scaled(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), "vec_id", "embedding", 256.0)
    got = sorted(tuple(r) for r in T.top_k(v, v.filter("id % 50 = 0"), 5).collect())
    ints = [(i, [math.floor(256 * x) for x in e]) for i, e, _ in rows]
    want = []
    for q, a in ints:
        if q % 50 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ints if i != q)[:5]
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert got == sorted(want)
