"""Targets against repeated resharing, rates against the optimum, copies against the targets."""

import math
import random
import re

import pytest

from tunewright.llm import mixing


def resharing(sizes, weights):
    """Targets by sharing the excess again until none is above its limit."""
    target, full, left = [0.0] * len(sizes), set(), float(sum(sizes))
    while True:
        open_ = [k for k in range(len(sizes)) if k not in full]
        total = sum(weights[k] for k in open_)
        over = [k for k in open_ if left * weights[k] / total > 3 * sizes[k]] if open_ else []
        if not over:
            for k in open_:
                target[k] = left * weights[k] / total
            return target
        for k in over:
            target[k] = 3.0 * sizes[k]
            full.add(k)
            left -= target[k]


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1000, 1, 1, 1, 5, 300], [0, 7, 0], [5], [1, 1, 1000000], [0, 0]])
def test_targets(spark, sizes):
    names = [f"{chr(97 + k)}" for k in range(len(sizes) - 1)] + [None]
    rows = [(n, f"{'s' + n if n else 'n'}", n is None, s, 1) for n, s in zip(names, sizes)]
    frame = spark.createDataFrame(rows, "x string, src string, last boolean, size long, n long")
    got = {r.src: r.target for r in mixing.targets(frame).collect()}
    want = resharing(sizes, [float(1 + k % 3) for k in range(len(sizes))]) if any(sizes) else [0.0] * len(sizes)
    assert [got[r[1]] for r in rows] == pytest.approx(want)


def test_edge_rows(spark, clashing, no_docs, rows_of_docs):
    found = mixing.mixed(spark, clashing).collect()
    words = sorted((r[0], len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))) for r in rows_of_docs)
    assert sorted((r.doc_id, r["size"]) for r in found) == words
    assert all(r.taken == r.copies * r["size"] and 0 <= r.copies <= 3 for r in found)
    assert found and sorted(map(tuple, found)) == sorted(map(tuple, mixing.mixed(spark, clashing.repartition(7)).collect()))
    assert mixing.mixed(spark, no_docs).count() == 0


def cells(spark, seed, hot):
    rng = random.Random(seed)
    rows = [(f"d{s}", int(rng.paretovariate(1.1) * 20) % 20000, 1) for s in range(6) for _ in range(300 * (8 if s == 0 and hot else 1))]
    docs = spark.createDataFrame([(k, "w " * n, s) for k, (s, n, _) in enumerate(rows)], "doc_id long, text string, source string")
    return docs, rows


@pytest.mark.parametrize("hot", [False, True])
def test_targets_are_met_by_tilted_rates(spark, hot):
    docs, rows = cells(spark, 5, hot)
    found = mixing.mixed(spark, docs).collect()
    by = {}
    for r in found:
        by.setdefault(r.src, []).append(r)
    total = sum(r[1] for r in rows)
    assert sum(v[0].target for v in by.values()) == pytest.approx(total)
    for mine in by.values():
        target = mine[0].target
        assert abs(sum(r.taken for r in mine) - target) <= max(0.003 * target, 30)
        assert sum(r.rate * r["size"] for r in mine) == pytest.approx(target, rel=1e-6)
        # one exponent per source: log rate over size is the same wherever the limit does not bind
        slope = [math.log(r.rate) / r["size"] for r in mine if 0 < r.rate < 2.99 and r["size"] > 50]
        if target < 2.9 * mine[0].source_size and slope:
            assert max(slope) - min(slope) <= 1e-9 + 1e-6 * abs(slope[0])


def test_one_very_long_document_per_source(spark):
    """What rounding leaves of the long document is made up by hundreds of small ones."""
    rng = random.Random(3)
    rows = [(f"d{s}", rng.randrange(20, 400)) for s in range(4) for _ in range(500)] + [(f"d{s}", 40_000 + 9_000 * s) for s in range(4)]
    docs = spark.createDataFrame([(k, "w " * n, s) for k, (s, n) in enumerate(rows)], "doc_id long, text string, source string")
    gaps = {}
    for r in mixing.mixed(spark, docs).collect():
        assert 0 <= r.copies <= 3
        gaps[r.src] = gaps.get(r.src, r.target) - r.taken
    assert all(abs(g) <= 20 for g in gaps.values()), gaps


def test_hot_cell_is_dealt_exactly(spark):
    """Two thousand copies of one size: their copies add up to the rounded target, and differ by one at most."""
    docs = spark.createDataFrame([(k, "w " * 50, "a") for k in range(2000)] + [(5000 + k, "w " * 10, "b") for k in range(100)], "doc_id long, text string, source string")
    found = [r for r in mixing.mixed(spark, docs).collect() if r.src == "sa"]
    assert abs(sum(r.taken for r in found) - found[0].target) <= 50 and max(r.copies for r in found) - min(r.copies for r in found) <= 1


def test_stage(spark, clashing, no_docs):
    out = mixing.mixture(spark, clashing)
    assert out.columns == clashing.columns
    took = {}
    for r in mixing.mixed(spark, clashing).collect():
        took[r.doc_id] = took.get(r.doc_id, 0) + r.copies
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == {k: n for k, n in took.items() if n}
    assert mixing.mixture(spark, no_docs).count() == 0
