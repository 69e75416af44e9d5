"""Nearest labelled examples against brute force, and scores against labels held out."""

import random
import zlib

import numpy as np
import pytest

from tunewright.llm import toxicity

BAD = ("grib", "snark", "vlop", "murd", "zash", "plonk")


def corpus(seed=3, n=900):
    """(doc_id, text) and (doc_id, toxic): toxic texts hold a few of the bad words among common ones."""
    rng = random.Random(seed)
    common = [f"w{a}{b}".translate(str.maketrans("0123456789", "abcdefghij")) for a in range(12) for b in range(10)]
    docs, labels = [], []
    for k in range(n):
        toxic = k % 6 == 0
        words = [rng.choice(common) for _ in range(rng.randrange(20, 120))]
        for _ in range(rng.randrange(2, 6) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(BAD).title() + rng.choice(("", ",", "!!")))
        docs.append((k, " ".join(words)))
        if k % 4:
            labels.append((k, int(toxic)))
    return docs, labels


def edges(docs):
    return docs + [(5000, None), (5001, ""), (5002, " \t"), (None, "grib snark"), (5003, "### 12 34"), docs[1], docs[1], (6, "vlop " * 40_000),
                   (5004, "wab " * 50_000 + "grib"), (5005, "Ünï 漢字 🙂")]


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame(edges(docs), "doc_id long, text string").selectExpr("*", "'x' AS terms", "1 AS score", "2 AS toxic", "'y' AS id").repartition(4)
    marks = spark.createDataFrame(labels + [(7, None), (None, 1), (99_999, 1)], "doc_id long, toxic int").selectExpr("*", "1 AS id", "0 AS quality")
    return docs, dict(labels), toxicity.scores(spark, frame, marks).collect()


def test_labels_held_out(scored):
    docs, labels, got = scored
    assert len(got) == len(edges(docs))
    out = [r for r in got if r["held_out"]]
    assert all((r["held_out"] is (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)) for r in got)
    judged = [r for r in out if r["doc_id"] in labels and r["doc_id"] != 6]
    assert len(judged) > 150 and sum(r["predicted"] == labels[r["doc_id"]] for r in judged) >= 0.99 * len(judged)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)


def test_edges(scored):
    _, _, got = scored
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert len({by[k][0]["score"] for k in (5000, 5001, 5002, 5003, 5005)}) == 1 and by[5000][0]["predicted"] == 0 and by[5000][0]["evidence"] == ""
    assert len(by[1]) == 3 and len({r["score"] for r in by[1]}) == 1
    assert by[None][0]["predicted"] == 1 and by[None][0]["held_out"] is False and by[None][0]["evidence"]
    assert max(r["score"] for r in by[6]) > 0.7


def test_labels_of_held_out_rows_change_nothing(spark, scored):
    docs, labels, got = scored
    turned = [(k, 1 - v if zlib.crc32(str(k).encode()) % 3 == 1 else v) for k, v in labels.items()]
    again = toxicity.scores(spark, spark.createDataFrame(edges(docs), "doc_id long, text string").repartition(2),
                            spark.createDataFrame(turned, "doc_id long, toxic int")).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_no_labels_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [(r["score"], r["predicted"]) for r in toxicity.scores(spark, docs, none).collect()] == [(0.5, 0), (0.5, 0)]
    one = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert {r["score"] < 0.5 for r in toxicity.scores(spark, docs, one).collect()} == {True}
    assert toxicity.scores(spark, docs.where("false"), one).count() == 0


def test_search_is_exact_and_prunes():
    rng = np.random.default_rng(2)
    terms = [np.sort(rng.choice(60, rng.integers(1, 6), replace=False)).tolist() for _ in range(3000)]
    counts = [rng.integers(1, 4, len(t)) for t in terms]
    idf = rng.uniform(0.5, 6, 60)
    index = toxicity.BlockMax(terms, counts, np.ones(3000, int), np.arange(3000) % 2, np.arange(3000), idf)
    asked = toxicity.unit_vectors(terms[:200], counts[:200], idf)
    score, place, scored = index.nearest(asked, 7)
    every = np.zeros((3000, 60))
    for at, own, rows in index.blocks:
        every[at:at + len(rows), own] = rows
    full = asked @ every.T
    want = np.lexsort((np.broadcast_to(np.arange(3000), full.shape), -full), axis=-1)[:, :7]
    have = np.take_along_axis(full, want, 1)
    assert (score == have).all() and (np.where(have > 0, want, 3000) == place).all()
    assert scored < 0.6 * 200 * len(index.blocks)


def test_isotonic():
    centres, values, weights = toxicity.isotonic([0.1, 0.2, 0.3, 0.4], [0.0, 1.0, 0.0, 1.0], [2, 1, 1, 3])
    assert centres.tolist() == pytest.approx([0.1, 0.25, 0.4]) and values.tolist() == [0.0, 0.5, 1.0] and weights.tolist() == [2, 2, 3]
