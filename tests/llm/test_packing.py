"""Pieces against tokens of whole texts, the curve against its definition."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tunewright.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def check(pieces, texts, tokenizer, length):
    """texts: (doc_id, text) rows; equal rows are matched by their number."""
    whole = defaultdict(list)
    for i, t in texts:
        whole[i].append(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4"))
    by, sequences = defaultdict(list), defaultdict(list)
    for r in pieces:
        by[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(by) == set(whole)
    for i, ids in whole.items():
        assert sum(r.length for r in by[i]) == sum(map(len, ids))
        for r in by[i]:
            assert any(len(x) == r.doc_tokens and zlib.crc32(x[r.start:r.start + r.length].tobytes()) == r.ids_crc32 for x in ids)
        if len(ids) == 1:
            at = 0
            for r in sorted(by[i], key=lambda r: r.start):
                assert r.start == at and r.length > 0
                at += r.length
    for mine in sequences.values():
        at = 0
        for r in sorted(mine, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == length or at & (at - 1) == 0 and at < length


@pytest.mark.parametrize("length,partitions", [(4096, None), (64, 3), (1, 1)])
def test_pieces(spark, clashing, rows_of_docs, tokenizer, length, partitions):
    use = clashing if length > 1 else clashing.where("doc_id < 404")
    texts = [(r[0], r[1]) for r in rows_of_docs if length > 1 or r[0] < 404]
    check(packing.packed(spark, use, length=length, partitions=partitions).collect(), texts, tokenizer, length)


def test_odd_texts(spark, tokenizer):
    """Apostrophes, digits, marks, other white space and control strings: words alone give the ids of the whole text."""
    texts = ["don't we'll I'm 'tis 123 4.5% <|endoftext|> a<|endoftext|>b x y z q é ́ \x1c\x1d 漢字かな 🙂🙂 ÀÉÎ İstanbul ΣΑΣ", "'s 't\n'll", "́ a", "A" * 3000]
    rows = list(enumerate(texts)) + [(None, "no id"), (None, "no id")]
    got = packing.packed(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check(got, rows, tokenizer, 4096)


def test_long_text_in_pieces(tokenizer):
    text = ("window stone, light's 12 " * 300 + "x" * 400 + " ") * 4
    words = packing.WordIds(packing.TOKENIZER, remembered=5)
    assert words.long_text(text.encode(), piece=1000).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_empty(spark, no_docs):
    assert packing.packed(spark, no_docs).count() == 0


def test_hilbert_visits_neighbours():
    points = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = packing.hilbert(points, bits=3)
    walk = points[np.argsort(keys)]
    assert sorted(keys.tolist()) == list(range(512)) and (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_alike_texts_share_sequences(spark):
    """Two kinds of text: nearly every sequence of the curve holds one kind."""
    import random

    rng = random.Random(0)
    kinds = ("river stone light carry window paper".split(), "zebra quartz vexing jumpy boxes wizard".split())
    rows = [(2 * k + g, " ".join(rng.choice(kinds[g]) for _ in range(60))) for k in range(200) for g in (0, 1)]
    pieces = packing.packed(spark, spark.createDataFrame(rows, "doc_id long, text string"), length=512, partitions=2).collect()
    held = defaultdict(set)
    for r in pieces:
        held[r.sequence_id].add(r.doc_id % 2)
    assert sum(len(v) == 1 for v in held.values()) >= 0.9 * len(held)


def test_texts_are_taken_as_they_come():
    """Texts come from an iterator, one run at a time, and keys of many texts are those of each alone."""
    words, at = packing.WordIds(packing.TOKENIZER), []
    texts = [b"some words of text " * 20_000] * 30
    runs = []
    for first, last, flat, tokens in words.batches((at.append(k), t)[1] for k, t in enumerate(texts)):
        runs.append((first, last, len(tokens)))
        assert len(at) == last
    assert len(runs) > 3 and runs[0][0] == 0 and runs[-1][1] == 30 and all(n == b - a for a, b, n in runs)
    many = [f"text {k} of many {k * k}" for k in range(3000)]
    keys = packing.curve_keys(pa.array(many))
    assert [int(k) for k in keys[::500]] == [int(packing.curve_keys(pa.array([t]))[0]) for t in many[::500]]


def test_runs_are_tokenised_once(tokenizer):
    """Case and marks make no new entries, and a run that occurs again in a piece is looked up once."""
    words = packing.WordIds(packing.TOKENIZER)
    texts = ["Stone, stone. (STONE) stone! 12 21", "\u00c9T\u00c9 \u00e9t\u00e9: stone", "it's \u0153uvre, <|endoftext|>"]
    flat, lengths = words.documents([t.encode() for t in texts])
    assert flat.tolist() == [i for t in texts for i in tokenizer.encode(t, add_special_tokens=False).ids]
    assert lengths.tolist() == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    assert set(words.place) == {x.encode() for x in ["stone", ",", ".", "(", ")", "!", "1", "2", "\u00e9t\u00e9", ":", "it's", "\u0153uvre,", "<|endoftext|>"]}


@pytest.mark.parametrize("remembered", [packing.REMEMBERED, 3])
@pytest.mark.parametrize("known", [True, False])
def test_any_characters(tokenizer, monkeypatch, remembered, known):
    """Texts of odd characters have the ids of the whole text, also if the tokenizer's borders are not known."""
    import random

    if not known:
        monkeypatch.setattr(packing, "_simple", lambda tokenizer: None)
    words, rng = packing.WordIds(packing.TOKENIZER, remembered=remembered), random.Random(5)
    parts = list("aZ09 \t\n\r'.,-<|>&_\u00c0\u00df\u00ff\u00d7\u00f7\u00aa\u00b5\u00a0\u0130\u0153\u0301\u2019\u2014\u6f22\x00\x1f\x7f\x85\ufb01\u212b") + [
        "word", "Word", "'s", "'Ll", "\u00c9t", "e\u0301", "<|endoftext|>", "<|STARTOFTEXT|>", "\U0001f642", "  ", " "]
    for _ in range(60):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(20)]
        flat, lengths = words.documents([t.encode() for t in texts])
        ids = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert lengths.tolist() == [len(i) for i in ids], [t for t, n, i in zip(texts, lengths, ids) if n != len(i)][:3]
        assert flat.tolist() == [x for i in ids for x in i]
