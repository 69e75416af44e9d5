"""Scores against a model in dictionaries; probabilities add up to one."""

import collections
import math
import re
import zlib

import numpy as np
import pytest

from tunewright.llm import blobs, ngram


def tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered) + ["\n"]


class Plain:
    def __init__(self, texts):
        docs = [tokens(t) for t in texts]
        self.uni = collections.Counter(w for d in docs for w in d)
        self.pairs = collections.Counter(p for d in docs for p in zip(["\t", *d], d))
        self.pred = collections.Counter(w for _, w in self.pairs)
        self.total, self.kinds = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0])
        for (a, _), c in self.pairs.items():
            self.total[a] += c
            self.kinds[a][min(c, 3) - 1] += 1
        cc = lambda counter: [sum(1 for x in counter.values() if x == k) for k in range(1, 5)]
        self.d2, self.d1 = ngram.discounts(cc(self.pairs)), ngram.discounts(cc(self.pred))
        kinds = [sum(1 for x in self.pred.values() if min(x, 3) == k) for k in (1, 2, 3)]
        self.free = sum(d * k for d, k in zip(self.d1, kinds)) / max(len(self.pairs), 1)
        self.n, self.v = sum(self.uni.values()), len(self.uni)

    def lower(self, w):
        if not self.pairs:
            return 1 / (self.v + 1)
        c = self.pred[w]
        return max(c - (self.d1[min(c, 3) - 1] if c else 0), 0) / len(self.pairs) + self.free / (self.v + 1)

    def p(self, a, w):
        if not self.total[a]:
            return self.lower(w)
        c = self.pairs[a, w]
        free = sum(d * k for d, k in zip(self.d2, self.kinds[a])) / self.total[a]
        return max(c - (self.d2[min(c, 3) - 1] if c else 0), 0) / self.total[a] + free * self.lower(w)

    def scores(self, text):
        t = tokens(text)
        base = sum(math.log10((self.uni[w] + 0.5) / (self.n + 0.5 * (self.v + 1))) for w in t)
        return len(t), sum(self.uni[w] > 0 for w in t), self.n, base, sum(math.log10(self.p(a, w)) for a, w in zip(["\t", *t], t))


def test_probabilities_add_up():
    model = Plain(["a b a b c", "b c d a b", "a b", "e f g h", "d d d d"])
    for a in ("\t", "a", "d", "never"):
        assert sum(model.p(a, w) for w in model.uni) + model.p(a, "unknown") == pytest.approx(1)


def test_edge_rows(spark, clashing, no_docs, rows_of_docs):
    model = ngram.train(spark, clashing.where(~ngram.fold()))
    got = ngram.scored(model, clashing, ngram.fold()).collect()
    held = lambda r: zlib.crc32(str(r[0]).encode()) % 5 == 1
    plain = Plain([r[1] for r in rows_of_docs if not held(r)])
    want = sorted((r[0], held(r), *plain.scores(r[1])) for r in rows_of_docs)
    got = sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)
    assert ngram.scored(model, no_docs, ngram.fold()).count() == 0


def test_model_beats_the_base_on_held_out_text(spark, docs):
    got = ngram.scored(ngram.train(spark, docs.where(~ngram.fold())), docs, ngram.fold()).where("held_out").groupBy().sum("score", "base_score").first()
    assert got[0] > got[1]


def test_no_training_documents(spark, docs):
    got = ngram.scored(ngram.train(spark, docs.where("false")), docs.where("doc_id = 403"), ngram.fold()).first()
    assert (got.n_tokens, got.n_known, got.train_tokens, got.score) == (3, 0, 0, 0.0)


def test_cells():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**64, 5000, dtype=np.uint64))
    values = rng.integers(0, 1000, len(keys)).astype(np.uint64)
    assert all((a == b).all() for a, b in zip(blobs.from_cell(blobs.to_cell(keys, values)), (keys, values)))
    k, v = blobs.merged([blobs.to_cell(keys[:3000], values[:3000]), blobs.to_cell(keys[2000:], values[2000:])])
    assert (k == keys).all() and v.sum() == values.sum() + values[2000:3000].sum()
    before, token = rng.integers(0, 2**31, (2, 500))
    assert all((a == b).all() for a, b in zip(ngram._unmixed(ngram.pair_key(before, token)), (before, token)))
    at = blobs.range_of(keys, 7)
    assert at[0] == 0 and at[-1] == len(keys) and all(abs(int(d) - len(keys) / 7) < 150 for d in np.diff(at))
