import zlib

import numpy as np

from tunewright.llm import sharding
from tunewright.llm.common import shared_dir


def test_every_row_has_its_place(spark, clashing, no_docs, rows_of_docs):
    found = sharding.placed(spark, clashing).collect()
    want = sorted((r[0] if r[0] is not None else -1, len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows_of_docs)
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in found) == want
    places = {}
    for r in found:
        places.setdefault(r.shard, []).append(r.slot)
    assert all(0 <= s < 16 and sorted(p) == list(range(len(p))) for s, p in places.items())
    assert {(r.law, r.grown_shard, r.map_version) for r in found} == {("bytes", None, 1)}
    assert sharding.placed(spark, no_docs).count() == 0


def test_sizes_are_near_equal(spark):
    rng = np.random.default_rng(2)
    docs = spark.createDataFrame([(int(k), "x" * int(n)) for k, n in enumerate(rng.pareto(1.2, 3000) * 40 % 5000)], "doc_id long, text string")
    sizes = [r[1] for r in sharding.placed(spark, docs).groupBy("shard").sum("size").collect()]
    assert len(sizes) == 16 and max(sizes) - min(sizes) <= 64


def test_null_id_and_repeated_rows(spark):
    docs = spark.createDataFrame([(None, "a"), (None, "b"), (None, None), (1, "x"), (1, "x"), (1, "y")], "doc_id long, text string")
    found = sharding.placed(spark, docs).collect()
    assert len(found) == 6 and len({(r.shard, r.slot) for r in found}) == 6


def test_versions_and_few_moves(spark):
    path = shared_dir(spark, "test-map")
    sharding.save_map(spark, path, 0, sharding.even_map(64, 4))
    load = np.array([100] * 16 + [90] * 16 + [80] * 16 + [110] * 16)
    version, first = sharding.load_map(spark, path)
    second = sharding.rebalanced(load, first, 4)
    sharding.save_map(spark, path, version + 1, second)
    assert sharding.load_map(spark, path)[0] == 1 and (sharding.load_map(spark, path, 0)[1] == first).all()
    held = np.bincount(second, weights=load)
    assert held.max() - held.min() <= 20 and (first != second).sum() <= 12


def test_rebalance_ends(spark):
    for load in (np.zeros(16, int), np.array([1000] + [0] * 15), np.arange(16)):
        out = sharding.rebalanced(load, sharding.even_map(16, 4), 4)
        assert out.min() >= 0 and out.max() < 4
