"""Top five against all pairs."""

import math
import random

import numpy as np
import pytest

from tunewright.llm import topk


def plain(rows, k=5):
    use = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in use:
        if i % 50 == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, v in asked.items():
        best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in use if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def rows(seed, n, dim=8):
    rng = random.Random(seed)
    f = lambda: float(np.float32(rng.gauss(0, 0.3)))
    out = [(k, [f() for _ in range(dim)]) for k in range(n)]
    hot = out[3][1]
    out += [(1000 + k, hot) for k in range(n // 2)]  # one vector on a third of the rows: ties everywhere
    out += [(5000, None), (5050, [None] * dim), (5100, [float("nan")] * dim), (5150, [float("inf")] * dim), (5200, []), (5250, [0.0] * dim),
            (5300, [0.5, -0.5]), (None, hot), (50, out[7][1]), out[9]]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("groups,batches", [(1, 1), (5, 3), (None, None)])
def test_against_all_pairs(spark, groups, batches):
    data = rows(4, 300)
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>").selectExpr("*", "1 AS x", "2 AS g", "3 AS rank").repartition(4)
    vectors = topk.quantised(frame)
    got = topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), groups=groups, batches=batches)
    assert sorted(tuple(r) for r in got.collect()) == plain(data)


def test_fewer_rows_than_k_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0]), (3, [2.0])], "vec_id long, embedding array<double>")
    vectors = topk.quantised(frame)
    assert [tuple(r) for r in topk.top_k(vectors, vectors.where("vec_id = 0")).collect()] == [(0, 1, 3, 256 * 512)]
    assert topk.top_k(vectors.where("false"), vectors.where("false")).count() == 0


def test_bounds_stop_early():
    """Clustered vectors: most blocks are never scored, and the result is that of scoring all."""
    rng = np.random.default_rng(0)
    centres = rng.normal(0, 100, (16, 32))
    x = np.floor(centres[rng.integers(0, 16, 4000)] + rng.normal(0, 8, (4000, 32))).astype(np.int64)
    blocks = topk.Blocks(np.arange(4000), x)
    score, found, scored = blocks.top(np.arange(50), x[:50], 5)
    full = x[:50] @ x.T
    full[np.arange(50), np.arange(50)] = np.iinfo(np.int64).min
    want = np.lexsort((np.broadcast_to(np.arange(4000), full.shape), -np.maximum(full, -(1 << 62))), axis=-1)[:, :5]
    assert (found == want).all() and scored < 0.5 * 50 * len(blocks.at)
