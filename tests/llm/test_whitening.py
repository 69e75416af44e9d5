"""Whitening against a dense solver in whole numbers."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from tunewright.llm import whitening


def plain(rows, k=32):
    use = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows
           if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width, n = max(len(v) for _, v in use), len(use)
    x = [v + [1_000_000] * (width - len(v)) for _, v in use]
    sums = [sum(c) for c in zip(*x)]
    d = [[n * a - s for a, s in zip(v, sums)] for v in x]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in d), n ** 3)) for j in range(width)] for i in range(width)])
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    w = np.array([[float(Fraction(a, n)) for a in r] for r in d]) @ u / np.sqrt(e)
    return use, [sum(a * a for a in r) for r in d], w, e / np.trace(cov)


def data(seed, n, dim):
    rng = random.Random(seed)
    f = lambda s: float(np.float32(rng.gauss(0, s)))
    out = [(k, [f(0.05 + 0.5 / (1 + j)) for j in range(dim)]) for k in range(n)]
    hot = out[1][1]
    out += [(10_000 + k, hot) for k in range(n // 2)]
    out += [(1, None), (2, [None] * dim), (3, [0.1] * (dim - 1) + [float("nan")]), (4, [float("-inf")] * dim), (None, hot), out[5], (7, [0.25, -0.5])]
    rng.shuffle(out)
    return out


def test_against_dense_solver(spark):
    rows = data(3, 240, 40)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS x", "2 AS n", "3 AS component").repartition(5)
    got = whitening.whitened(spark, whitening.integers(frame)).collect()
    use, deviation, w, share = plain(rows)
    assert len(got) == len(use) * 32 and {r["n"] for r in got} == {len(use)}
    assert {r["identity_error"] for r in got}.pop() < 1e-9
    assert sorted({(r["component"], r["explained"]) for r in got}) == [(k + 1, pytest.approx(share[k], rel=1e-10)) for k in range(32)]
    turn = {}
    for c in range(32):  # either sign, the same for all rows
        mine = sorted(((r["vec_id"] is not None, r["vec_id"] or 0, r["deviation"], r["whitened"]) for r in got if r["component"] == c + 1), key=lambda r: r[:3])
        want = sorted(((i is not None, i or 0, dev, w[k, c]) for k, ((i, _), dev) in enumerate(zip(use, deviation))), key=lambda r: r[:3])
        a, b = np.array([r[3] for r in mine]), np.array([r[3] for r in want])
        turn[c] = np.sign(a @ b)
        assert [r[:3] for r in mine] == [r[:3] for r in want] and np.abs(a * turn[c] - b).max() < 1e-8


def test_inertia_and_slices():
    rng = np.random.default_rng(1)
    for spectrum in (np.arange(1.0, 25.0), np.r_[np.full(10, 3.0), np.full(5, 2.0), np.linspace(0, 1, 9)], np.r_[np.zeros(6), 1e-8, 1e6]):
        q, _ = np.linalg.qr(rng.normal(size=(len(spectrum), len(spectrum))))
        v = q * spectrum @ q.T
        v = (v + v.T) / 2
        for s in (spectrum.min() - 1, np.median(spectrum) + 0.013, spectrum.max() + 1):
            assert whitening.inertia(v - s * np.eye(len(v))) == (spectrum < s).sum()
        for wanted in (3, 8, 32):
            cuts = whitening.slices(v, wanted, least=-0.5)
            least = min(wanted, len(v))
            low = min(c[0] for c in cuts)
            assert least <= sum(c[2] for c in cuts) == (spectrum > low).sum()
            found = np.concatenate([whitening.contour(v, *c)[0] for c in cuts])
            assert np.allclose(np.sort(found)[::-1][:least], np.sort(spectrum)[::-1][:least], atol=1e-9 * max(1, spectrum.max()))


def test_zero_matrix_of_pivots_of_two():
    assert whitening.inertia(np.array([[0.0, 2.0], [2.0, 0.0]])) == 1
    assert whitening.inertia(np.zeros((3, 3))) == 0


def test_few_rows_and_none(spark):
    make = lambda rows: whitening.whitened(spark, whitening.integers(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    assert make([]).count() == 0 and make([(1, None)]).count() == 0 and make([(1, [])]).count() == 0
    assert make([(1, [0.5, 0.25])]).count() == 0  # one row has no spread
    got = make([(1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [2.0, 1.0])]).orderBy("vec_id").collect()  # one direction only
    assert [(r["vec_id"], r["component"], r["n"], r["deviation"]) for r in got] == [(1, 1, 3, 192 ** 2), (2, 1, 3, 0), (3, 1, 3, 192 ** 2)]
    assert abs(abs(got[0]["whitened"]) - 1.5 ** 0.5) < 1e-12 and got[0]["explained"] == pytest.approx(1.0)


def test_large_entries_stay_exact(spark):
    rows = [(k, [float(k) * 1e9, -float(k % 3) * 1e6]) for k in range(6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = whitening.moments(whitening.integers(frame), 2)
    _, _, _, share = plain(rows)
    values = np.linalg.eigvalsh(found.covariance)[::-1]
    assert np.allclose(values / values.sum(), share, rtol=1e-9)
    with pytest.raises(Exception):  # the deviation does not fit a long
        whitening.whitened(spark, whitening.integers(frame)).collect()


def test_products_exact():
    y = np.random.default_rng(0).integers(-2 ** 25, 2 ** 25, (50, 3))
    assert (whitening._products(y) == y.astype(object).T @ y.astype(object)).all()
