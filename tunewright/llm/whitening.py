"""Whitening of embeddings on the leading eigenvectors of their covariance, found by contour integration (FEAST).

Entries become integers, x = floor(64 c) + 1000000.  One pass sums them, a second
sums the products of y = x - m, m being the whole number next to the mean.  Both
sums are exact, and so is the covariance until it is divided once at the end.

The spectrum is cut into slices from above.  The inertia of V - s I (the signs of
the pivots of its symmetric factorisation) counts the eigenvalues below s without
finding one, so bisection yields slices of a few eigenvalues each.  A slice is one
task: Gauss-Legendre points on a circle over the slice give weighted solves with
z I - V that project random vectors onto the slice's eigenspace, Rayleigh-Ritz
extracts the pairs, and this is repeated until the residuals are down to rounding.
A slice must return as many pairs as the inertia of its two ends promises.

A third pass sums the products of the whitened values, which gives the identity
error, and a fourth writes them.  Every sum is one row per task; the driver holds
matrices of the dimension, never rows.

Defined cases: vectors that are null or hold null or non-finite entries go; shorter
vectors are filled up with zero entries; a null id is kept, as are rows that share
one; components whose eigenvalue is zero within rounding (fewer rows than
dimensions, a constant entry, a single row) cannot be whitened and are left out;
an empty table, or one without any spread, gives no rows; equal eigenvalues get
one orthonormal basis of theirs; other columns, of whatever name, are not read.
A deviation beyond 63 bits raises.
"""

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Eigenvalues in one slice, points of the quadrature, and the most refinements of one slice.
SLICE, POINTS, ROUNDS = 6, 8, 40
_EXACT = 2.0 ** 53


# ---- exact moments

def _matrix(column, width):
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, ends = np.asarray(lists.flatten(), dtype=np.int64), np.asarray(lists.offsets).astype(np.int64)
    out, lengths = np.full((len(lists), width), SHIFT, np.int64), np.diff(ends)
    out[np.repeat(np.arange(len(lists)), lengths), np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], lengths)] = flat
    return out


def _products(y):
    """y^T y as Python integers, exact: in floats where every partial sum is a whole number below 2^53."""
    top = float(np.abs(y).max(initial=0))
    step = max(1, int(min(len(y), _EXACT // max(1.0, top * top))))
    if top * top >= _EXACT:
        whole = y.astype(object)
        return whole.T @ whole
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for at in range(0, len(y), step):
        part = y[at:at + step].astype(np.float64)
        total += np.rint(part.T @ part).astype(np.int64).astype(object)
    return total


def _totals(width, middle=None):
    """Task: rows, sums and (given the middle) products of x - middle, as text, for whole numbers of any size."""
    def run(batches):
        n, sums, products = 0, np.zeros(width, object), np.zeros((width, width), object)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                y = _matrix(batch.column(0).slice(at, 4096), width)
                if middle is None:
                    sums += y.astype(object).sum(axis=0)
                else:
                    products += _products(y - middle)
                n += len(y)
        rest = products if middle is not None else sums
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([" ".join(map(str, rest.ravel()))])], names=["n", "numbers"])
    return run


def _added(rows):
    n, total = 0, 0
    for r in rows:
        n += r["n"]
        total = total + np.array([int(v) for v in r["numbers"].split()], object)
    return n, total


def integers(df: DataFrame, key="vec_id", vector="embedding") -> DataFrame:
    """(vec_id, x) of the rows that take part."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return df.where(F.coalesce(F.col(vector).isNotNull() & finite, F.lit(False))).select(
        F.col(key).cast("long").alias("vec_id"),
        F.transform(vector, lambda v: F.floor(v.cast("double") * SCALE).cast("long") + SHIFT).alias("x"))


class Moments:
    """Rows, exact sums and the covariance of integer vectors."""

    def __init__(self, n, sums, products):
        self.n, self.sums = n, sums
        self.middle = np.array([(2 * int(s) + n) // (2 * n) for s in sums], np.int64)
        if products is not None:
            rest = sums - n * self.middle.astype(object)
            self.covariance = np.array([[int(v) / (n * n) for v in row] for row in n * products - np.outer(rest, rest)])


def moments(x: DataFrame, width) -> Moments | None:
    vectors = x.select("x")
    n, sums = _added(vectors.mapInArrow(_totals(width), "n long, numbers string").toLocalIterator())
    if not n:
        return None
    first = Moments(n, sums, None)
    _, products = _added(vectors.mapInArrow(_totals(width, first.middle), "n long, numbers string").toLocalIterator())
    return Moments(n, sums, products.reshape(width, width))


# ---- eigenvalues by slices

def inertia(a):
    """How many eigenvalues of a symmetric matrix are negative, by its factorisation L D L^T with pivots of one or two rows."""
    a, negative = a.copy(), 0
    share = (1 + 17 ** 0.5) / 8
    while len(a):
        d = np.abs(np.diagonal(a))
        k = int(d.argmax())
        off = np.abs(a - np.diag(np.diagonal(a)))
        high = float(off.max(initial=0.0))
        if high == 0.0:
            return negative + int((np.diagonal(a) < 0).sum())
        if d[k] >= share * high:
            pivot, rest = a[k, k], np.delete(np.arange(len(a)), k)
            negative += int(pivot < 0)
            a = a[np.ix_(rest, rest)] - np.outer(a[rest, k], a[rest, k] / pivot)
        else:  # a block of two, whose determinant is negative: one eigenvalue of either sign
            i, j = divmod(int(off.argmax()), len(a))
            rest = np.delete(np.arange(len(a)), [i, j])
            side = a[np.ix_(rest, [i, j])]
            negative += 1
            a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(a[np.ix_([i, j], [i, j])], side.T)
    return int(negative)


def slices(v, wanted, most=SLICE, least=None):
    """(low, high, count) of disjoint intervals from the top of the spectrum that hold the `wanted` largest eigenvalues above `least`, or all.

    No end of an interval lies next to an eigenvalue, so a contour through it separates
    well.  An interval holds more than `most` only where they are equal within rounding.
    """
    d = len(v)
    eye, high = np.eye(d), float(np.abs(v).sum(axis=1).max(initial=0.0))
    if high == 0.0:
        return []
    high *= 1 + 1e-3
    least = -high if least is None else float(least)
    above = lambda s: d - inertia(v - s * eye)

    def clear_cut(low, high):
        """(a place between the two, how many lie above it): the clearest of those tried from the middle outwards."""
        for share in (1e-2, 1e-3, 1e-5):
            for at in (0.5, 0.44, 0.56, 0.38, 0.62, 0.32, 0.68, 0.27, 0.73):
                cut, gap = low + at * (high - low), share * (high - low)
                if (k := above(cut - gap)) == above(cut + gap):
                    return cut, k
        return cut, above(cut)

    floor, count, top = least, above(least), high
    while count > wanted and top - floor > 1e-9 * high:  # the largest clear cut with the wanted ones above it
        cut, k = clear_cut(floor, top)
        floor, count, top = (cut, k, top) if k >= wanted else (floor, count, cut)
    done, work = [], [(floor, high, count, 0)]
    while work:  # places with the number of eigenvalues above them, the same number for both neighbours
        low, end, above_low, above_end = work.pop()
        if above_low - above_end <= most or end - low <= 1e-9 * high:
            done += [(low, end, above_low - above_end)] if above_low > above_end else []
            continue
        cut, k = clear_cut(low, end)
        work += [(low, cut, above_low, k), (cut, end, k, above_end)]
    return sorted(done, reverse=True)


def contour(v, low, high, count, seed=0):
    """Eigenvalues and vectors of v in (low, high], `count` of them, by contour integration; raises if any is missed."""
    d = len(v)
    middle, radius = (low + high) / 2, (high - low) / 2
    norm = float(np.linalg.norm(v, 2))
    node, weight = np.polynomial.legendre.leggauss(POINTS)
    angle = np.pi / 2 * (node + 1)  # the upper half; the lower one is its conjugate
    points = middle + radius * np.exp(1j * angle)
    eye = np.eye(d)
    size = min(d, max(count + 4, count * 3 // 2))
    y = np.random.default_rng(seed).standard_normal((d, size))
    for _ in range(ROUNDS):
        q = np.zeros((d, size))
        for z, t, w in zip(points, angle, weight):
            q += w / 2 * (radius * np.exp(1j * t) * np.linalg.solve(z * eye - v, y)).real
        basis, _ = np.linalg.qr(q)
        # Rayleigh-Ritz on the projected space
        values, small = np.linalg.eigh(basis.T @ v @ basis)
        vectors = basis @ small
        inside = (values > low) & (values <= high)
        residual = np.linalg.norm(v @ vectors - vectors * values, axis=0)
        if inside.sum() == count and residual[inside].max(initial=0.0) <= 64 * np.finfo(float).eps * norm * d ** 0.5:
            return values[inside], vectors[:, inside]
        y = vectors
    raise RuntimeError(f"{int(inside.sum())} of {count} eigenvalues found in ({low}, {high}], residual {residual[inside].max(initial=0.0)}")


def eigenpairs(spark, v, wanted=COMPONENTS, least=None):
    """The `wanted` largest eigenvalues above `least` of a symmetric matrix, falling, and their unit vectors as columns; one task per slice."""
    cuts = slices(v, wanted, least=least)
    if not cuts:
        return np.zeros(0), np.zeros((len(v), 0))

    def solve(batches):
        for batch in batches:
            for low, high, count in zip(*(batch.column(k).to_pylist() for k in range(3))):
                values, vectors = contour(v, low, high, count)
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(list(vectors.T))], names=["value", "vector"])

    rows = (spark.createDataFrame(cuts, "low double, high double, count long").repartition(len(cuts))
            .mapInArrow(solve, "value double, vector array<double>").collect())
    rows.sort(key=lambda r: -r["value"])
    rows = rows[:wanted]
    values, vectors = np.array([r["value"] for r in rows]), np.array([r["vector"] for r in rows]).T
    # slices are solved apart: clean the last bits of what the vectors of different slices share
    vectors, upper = np.linalg.qr(vectors)
    return values, vectors * np.sign(np.diagonal(upper))


# ---- whitening

OUT = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64())])


class Whitener:
    """Projection of integer vectors on unit components, over the root of their eigenvalues."""

    def __init__(self, found: Moments, values, vectors):
        self.n, self.middle, self.sums = found.n, found.middle, found.sums
        self.rest = np.array([int(s - found.n * int(m)) / found.n for s, m in zip(found.sums, found.middle)])
        self.turn = vectors / np.sqrt(values)

    def whitened(self, x):
        return ((x - self.middle) - self.rest) @ self.turn

    def deviation(self, x):
        """Sum over the dimensions of (n x - S)^2, in whole numbers."""
        y, rest = x - self.middle, self.sums - self.n * self.middle.astype(object)
        if self.n * float(np.abs(y).max(initial=0) + 1) < 2.0 ** 62 / self.n and (self.n * float(np.abs(y).max(initial=0) + 1)) ** 2 * max(1, x.shape[1]) < 2.0 ** 62:
            return ((self.n * y - rest.astype(np.int64)) ** 2).sum(axis=1)
        return ((self.n * y.astype(object) - rest) ** 2).sum(axis=1)

    def spread(self, width):
        """Task: sums and products of the whitened values, one row."""
        def run(batches):
            k = self.turn.shape[1]
            sums, products = np.zeros(k), np.zeros((k, k))
            for batch in batches:
                for at in range(0, batch.num_rows, 4096):
                    w = self.whitened(_matrix(batch.column(1).slice(at, 4096), width))
                    sums += w.sum(axis=0)
                    products += w.T @ w
            yield pa.RecordBatch.from_arrays([pa.array([sums]), pa.array([products.ravel()])], names=["sums", "products"])
        return run

    def rows(self, width):
        def run(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    ids, x = batch.column(0).slice(at, 1024), _matrix(batch.column(1).slice(at, 1024), width)
                    k = self.turn.shape[1]
                    each = np.repeat(np.arange(len(x)), k)
                    yield pa.RecordBatch.from_arrays([
                        ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(each), self.n)), pa.array(list(self.deviation(x)), pa.int64()).take(pa.array(each)),
                        pa.array(self.whitened(x).ravel())], schema=OUT)
        return run


def whitened(spark, x: DataFrame, components=COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of integer vectors (vec_id, x)."""
    schema = "vec_id long, component int, n long, deviation long, whitened double"
    empty = lambda: spark.createDataFrame([], schema + ", explained double, identity_error double")
    width = x.agg(F.max(F.size("x"))).first()[0] or 0
    found = moments(x, width) if width else None
    if found is None:
        return empty()
    trace = float(np.trace(found.covariance))
    values, vectors = eigenpairs(spark, found.covariance, components, least=width * np.finfo(float).eps * trace)
    if not len(values):
        return empty()
    made = Whitener(found, values, vectors)
    sums, products = np.zeros(len(values)), np.zeros(len(values) ** 2)
    for row in x.mapInArrow(made.spread(width), "sums array<double>, products array<double>").toLocalIterator():
        sums, products = sums + np.array(row["sums"]), products + np.array(row["products"])
    mean = sums / found.n
    error = float(np.abs(products.reshape(len(values), -1) / found.n - np.outer(mean, mean) - np.eye(len(values))).max())
    share = F.element_at(F.array(*[F.lit(float(e / trace)) for e in values]), F.col("component"))
    return x.mapInArrow(made.rows(width), schema).select("*", share.alias("explained"), F.lit(error).alias("identity_error"))


def query(spark, sf_dir):
    return whitened(spark, integers(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


#: Eigenvectors are beyond SQL; tests hold the operator against a dense solver.
ORACLE = None
