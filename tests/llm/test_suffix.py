"""Removed bytes against a table of all windows."""

import hashlib
import random

from tunewright.llm import suffix


def plain(rows, depth=50):
    """{row number: (bytes, removed, spans, digest, left)} by looking at every window."""
    first = {}
    data = [(r[1] or "").encode() for r in rows]
    for r, t in zip(rows, data):
        for p in range(len(t) - depth + 1):
            w = t[p:p + depth]
            first[w] = min(first.get(w, r[0]), r[0])
    out = []
    for r, t in zip(rows, data):
        gone = bytearray(len(t))
        for p in range(len(t) - depth + 1):
            if first[t[p:p + depth]] < r[0]:
                gone[p:p + depth] = b"\1" * depth
        left = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((r[0], len(t), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out)


def test_edge_rows(spark, clashing, rows_of_docs):
    assert sorted(tuple(r) for r in suffix.digests(spark, clashing).collect()) == plain(rows_of_docs)


def test_periodic_and_low_entropy(spark):
    """Texts of few letters have many equal anchors, overlapping windows and ties."""
    rng = random.Random(3)
    rows = [(k, "".join(rng.choice("ab") for _ in range(rng.randrange(400))), None, None) for k in range(30)]
    rows += [(100 + k, "ab" * rng.randrange(10, 90), None, None) for k in range(20)]
    rows += [(200 + k, "é" * rng.randrange(20, 60) + rows[k][1], None, None) for k in range(10)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    assert sorted(tuple(r) for r in suffix.digests(spark, frame).collect()) == plain(rows)


def test_row_without_id_is_left_alone(spark):
    long = "word " * 30
    rows = [(None, long), (None, long), (5, long), (3, long)]
    got = sorted((str(r.doc_id), r.n_removed) for r in suffix.digests(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [("3", 0), ("5", 150), ("None", 0), ("None", 0)]


def test_stage_keeps_whole_characters(spark, clashing, no_docs):
    a = "x" * 49 + "é" + "tail of the first"
    b = "x" * 49 + "è" + "another end"  # the window ends inside a character: é and è share their first byte
    frame = spark.createDataFrame([(1, a, 7), (2, b, 9), (3, None, 0)], "doc_id long, text string, n_chars int")
    got = {r.doc_id: r for r in suffix.without_repeats(spark, frame).collect()}
    assert got[1].text == a and got[2].text == "èanother end" and got[2].n_chars == 12 and got[3].text is None
    out = suffix.without_repeats(spark, clashing)
    assert out.columns == clashing.columns and out.count() == clashing.count()
    assert out.where("doc_id = 101").first().text == "" and out.where("doc_id = 100").first()["chunk"] == "other"
    assert suffix.digests(spark, no_docs).count() == 0 and suffix.without_repeats(spark, no_docs).count() == 0


def test_small_slices_change_nothing(spark, docs, rows_of_docs, monkeypatch):
    monkeypatch.setattr(suffix, "SLICE", 40)
    assert sorted(tuple(r) for r in suffix.digests(spark, docs).collect()) == plain(rows_of_docs)
