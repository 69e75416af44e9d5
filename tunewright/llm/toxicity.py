"""Toxicity scores by votes of the nearest labelled examples, found exactly in a block-max inverted index.

Examples are a sample of the labelled training rows, about EXAMPLES of them, picked by
a hash of the id.  Their words that tell the labels apart are the vocabulary: the
likelihood ratio of word and label must exceed 2 ln(words tested), so that hardly a
word gets in by chance, the word must at least double or halve the toxic share, and
the TERMS strongest stay.  Examples whose least hashed run
of three words is the same are copies of each other and share the weight of one, else
any word of a text with many copies would seem to tell.  How many documents hold a word
is counted over all documents; a text becomes the unit vector of (1 + ln tf) * idf over
the vocabulary, in whole numbers of 2^-20, so that every inner product is exact.

Equal example vectors are one posting with the number of its rows and of the toxic
ones.  Postings lie in blocks of neighbours; a block keeps its vectors and, for every
term, its greatest weight.  The sum of a query's weights times those maxima bounds
every cosine of the block; blocks are scored in the order of their bounds until the
next bound is below the k-th cosine.

The neighbours vote with the square of their cosine a row.  The examples score each
other, each without its own row, and an isotonic fit over those votes turns votes into
the share of toxic rows that such votes meant.  Texts without any vocabulary word get
the share among such examples.

Defined cases: a null or empty text is a text without words; rows are scored one by
one, whatever ids they share, and a null id is never held out; an example id that
occurs on several rows is its least text, once, and toxic if any of its labels is; null
labels don't count; without labels of both kinds every score is the smoothed share of
toxic ones (one half where there are none); an empty table gives no rows; other
columns, of whatever name, are not read.
"""

import math
import re
import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from tunewright.llm.common import materialised

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Labelled rows the sample aims at, terms at most, nearest examples that vote, postings in a block.
EXAMPLES, TERMS, NEAREST, BLOCK = 16384, 1024, 15, 64
FOLDS, HELD_OUT, LIMIT = 3, 1, 0.7
UNIT = 1 << 20
LEAST_ROWS, LIFT = 3, 2
_WORD = re.compile(r"[^\W\d_]+")


# ---- vocabulary

def _words(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            label, text = (batch.column(k).slice(at, 512).to_pylist() for k in (0, 1))
            words = [_WORD.findall((t or "").lower()) for t in text]
            least = [min(xxhash.xxh64_intdigest(" ".join(w[k:k + 3])) for k in range(max(1, len(w) - 2))) - (1 << 63) for w in words]
            yield pa.RecordBatch.from_arrays([pa.array(label, pa.int64()), pa.array(least, pa.int64()), pa.array([list(set(w)) for w in words], pa.list_(pa.string()))],
                                             names=["toxic", "least", "words"])


def examples(docs: DataFrame, labels: DataFrame, most=EXAMPLES, key="doc_id", text="text", label="toxic") -> DataFrame:
    """(id, toxic, text) of about `most` labelled rows outside the held-out fold, one per id."""
    known = labels.select(F.col(key).alias("id"), F.col(label).alias("toxic")).where("id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    share = min(1.0, most / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 40)) < int(share * (1 << 40)))
    # about `most` narrow rows: a bound that does not depend on the input
    return (docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(known), "id")
            .groupBy("id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")))


def vocabulary(spark: SparkSession, sample: DataFrame, most=TERMS):
    """The words whose presence and the label depend on each other, strongest first."""
    words = materialised(spark, sample.select("toxic", "text").mapInArrow(_words, "toxic long, least long, words array<string>"), "toxic-words")
    words = words.join(words.groupBy("least").agg((F.lit(1.0) / F.count(F.lit(1))).alias("weight")), "least")
    n, toxic = words.agg(F.sum("weight"), F.sum(F.col("weight") * F.col("toxic"))).first()
    seen = words.select("toxic", "weight", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("weight").alias("rows"), F.sum(F.col("weight") * F.col("toxic")).alias("hits")).where(F.col("rows") >= LEAST_ROWS)
    seen = materialised(spark, seen, "toxic-words")
    part = lambda o, e: F.when(o > 1e-9, 2 * o * F.log(o / e)).otherwise(0.0)
    a, b = F.col("hits"), F.col("rows") - F.col("hits")
    c, d = F.lit(toxic) - a, F.lit(n - toxic) - b
    ratio = (part(a, (a + b) * F.lit(toxic / n)) + part(b, (a + b) * F.lit((n - toxic) / n))
             + part(c, (c + d) * F.lit(toxic / n)) + part(d, (c + d) * F.lit((n - toxic) / n)))
    share = F.col("hits") / F.col("rows") / F.lit(toxic / n)
    # sums of weights may differ in their last bits from run to run
    return [r["word"] for r in seen.withColumn("ratio", F.round(ratio, 6)).where(F.col("ratio") > 2 * math.log(max(2, seen.count())))
            .where((share >= LIFT) | (share <= 1 / LIFT)).orderBy(F.desc("ratio"), "word").limit(most).collect()]


def with_terms(rows: DataFrame, words) -> DataFrame:
    """rows with `terms` and `counts` of the vocabulary in place of their last column, a text."""
    place = {w: k for k, w in enumerate(words)}

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                terms, counts = [], []
                for t in part.column(part.num_columns - 1):
                    seen = {}
                    for w in _WORD.findall((t.as_py() or "").lower()):
                        if (k := place.get(w)) is not None:
                            seen[k] = seen.get(k, 0) + 1
                    own = sorted(seen)
                    terms.append(own)
                    counts.append([seen[k] for k in own])
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
                                                 names=[*part.schema.names[:-1], "terms", "counts"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{kept}, terms array<int>, counts array<int>")


def documents_with(rows: DataFrame, n_terms):
    """How many rows hold each term: one short list a task."""
    def run(batches):
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(np.asarray(batch.column(0).flatten()), minlength=n_terms)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total), pa.int32()), pa.array(total[total > 0])], names=["term", "n"])

    seen = np.zeros(n_terms, np.int64)
    if n_terms:
        for r in rows.select("terms").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
            seen[r["term"]] = r["n"]
    return seen


def unit_vectors(terms, counts, idf):
    """Rows of whole numbers, each of length UNIT within rounding, dense."""
    out = np.zeros((len(terms), len(idf)))
    for k, (t, c) in enumerate(zip(terms, counts)):
        out[k, t] = (1 + np.log(c)) * idf[t]
    length = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return np.rint(out * UNIT / np.where(length > 0, length, 1))


# ---- index

class BlockMax:
    """Distinct example vectors in blocks of neighbours, with the greatest weight of each term in each block."""

    def __init__(self, terms, counts, n, toxic, ids, idf, block=BLOCK):
        vectors = unit_vectors(terms, counts, idf)
        heavy = np.argsort(-vectors, axis=1, kind="stable")[:, :3]
        order = np.lexsort((ids, *heavy.T[::-1]))
        self.n, self.toxic, self.ids = (np.asarray(v)[order] for v in (n, toxic, ids))
        self.idf, self.block, self.blocks = idf, block, []
        self.high = np.zeros((-(-len(order) // block), len(idf)))
        for b, at in enumerate(range(0, len(order), block)):
            rows = vectors[order[at:at + block]]
            own = np.flatnonzero(rows.any(axis=0))
            self.blocks.append((at, own, rows[:, own]))
            self.high[b] = rows.max(axis=0)

    def nearest(self, vectors, k=NEAREST):
        """(cosines in whole numbers, places) of the k nearest postings with a word in common, best first, ties to the smaller place; and blocks scored."""
        bounds = vectors @ self.high.T
        order = np.argsort(-bounds, axis=1, kind="stable")
        score, place = np.zeros((len(vectors), k)), np.full((len(vectors), k), len(self.ids))
        scored, active = 0, np.arange(len(vectors))
        for step in range(len(self.blocks)):
            nxt = order[active, step]
            # a block that can only tie with the k-th counts if its places are smaller
            bound, kth = bounds[active, nxt], score[active, -1]
            live = (bound > 0) & ((bound > kth) | ((bound == kth) & (nxt * self.block < place[active, -1])))
            active, nxt = active[live], nxt[live]
            if not len(active):
                break
            by = np.argsort(nxt, kind="stable")
            for some in np.split(by, np.flatnonzero(np.diff(nxt[by])) + 1):
                who, (at, own, rows) = active[some], self.blocks[nxt[some[0]]]
                new = vectors[np.ix_(who, own)] @ rows.T
                all_score = np.concatenate([score[who], new], axis=1)
                all_place = np.concatenate([place[who], np.broadcast_to(np.arange(at, at + len(rows)), new.shape)], axis=1)
                all_place = np.where(all_score > 0, all_place, len(self.ids))
                best = np.lexsort((all_place, -all_score), axis=-1)[:, :k]
                score[who], place[who] = np.take_along_axis(all_score, best, 1), np.take_along_axis(all_place, best, 1)
                scored += len(who)
        return score, place, scored

    def votes(self, score, place, own=None, label=None):
        """Weighted toxic rows and weighted rows among the nearest; with `own`, without one row of that label in that posting."""
        pad = lambda v: np.append(v, 0)[place].astype(float)
        n, toxic = pad(self.n), pad(self.toxic)
        if own is not None:
            self_here = place == own[:, None]
            n, toxic = n - self_here, toxic - self_here * label[:, None]
        weight = (score / UNIT ** 2) ** 2
        return (weight * toxic).sum(axis=1), (weight * n).sum(axis=1)


def isotonic(x, share, weight):
    """Centres, values and weights of the non-decreasing steps next to the shares, by pooling neighbours that fall."""
    pools = []
    for a, s, w in sorted(zip(x, share, weight)):
        pools.append([a * w, s * w, w])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [u + v for u, v in zip(pools[-1], last)]
    return tuple(np.array(c) for c in zip(*((p[0] / p[2], p[1] / p[2], p[2]) for p in pools)))


class Model:
    """Vocabulary weights, index and calibration; as large as the sample, whatever the corpus."""

    def __init__(self, index, prior, without, centres=None, values=None):
        self.index, self.prior, self.without, self.centres, self.values = index, prior, without, centres, values

    def raw(self, toxic, rows):
        return (toxic + self.prior) / (rows + 1)

    def scored(self, terms, counts):
        """(score, evidence) of texts given by their terms; equal ones are searched once."""
        keys = [(tuple(t), tuple(c)) for t, c in zip(terms, counts)]
        some = {k: None for k in keys if k[0]}
        asked = list(some)
        for at in range(0, len(asked), 1024):
            part = asked[at:at + 1024]
            score, place, _ = self.index.nearest(unit_vectors([list(t) for t, _ in part], [np.array(c) for _, c in part], self.index.idf))
            value = np.interp(self.raw(*self.index.votes(score, place)), self.centres, self.values)
            for k, v, s, p in zip(part, value.tolist(), score, place):
                some[k] = v, " ".join(f"{self.index.ids[j]}:{c / UNIT ** 2:.4f}" for c, j in zip(s[:3], p[:3]) if c > 0)
        return [some.get(k) or (self.without, "") for k in keys]


def _search_examples(model):
    """Task: votes of example postings (place, terms, counts) about themselves, without one of their own rows of either label."""
    schema = pa.schema([("raw", pa.float64()), ("label", pa.int64()), ("rows", pa.int64())])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                place, terms, counts = (batch.column(k).slice(at, 1024).to_pylist() for k in range(3))
                own = np.array(place)
                score, found, _ = model.index.nearest(unit_vectors(terms, [np.array(c) for c in counts], model.index.idf))
                for label, rows in ((1, model.index.toxic[own]), (0, model.index.n[own] - model.index.toxic[own])):
                    raw = model.raw(*model.index.votes(score, found, own, np.full(len(own), label)))
                    have = rows > 0
                    yield pa.RecordBatch.from_arrays([pa.array(raw[have]), pa.array(np.full(have.sum(), label)), pa.array(rows[have])], schema=schema)
    return run


def fitted(spark: SparkSession, sample_terms: DataFrame, idf) -> Model:
    """The model of examples (id, toxic, terms, counts)."""
    rows = sample_terms.groupBy("terms", "counts").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic"), F.min("id").alias("id")).collect()
    n, toxic = sum(r["n"] for r in rows), sum(r["toxic"] for r in rows)
    prior = (toxic + 0.5) / (n + 1)
    bare = [r for r in rows if not r["terms"]]
    without = (sum(r["toxic"] for r in bare) + prior) / (sum(r["n"] for r in bare) + 1)
    rows = [r for r in rows if r["terms"]]
    if not rows:
        return Model(None, prior, without)
    index = BlockMax([r["terms"] for r in rows], [np.array(r["counts"]) for r in rows], [r["n"] for r in rows], [r["toxic"] for r in rows],
                     [r["id"] for r in rows], idf)
    model = Model(index, prior, without)
    at = {i: k for k, i in enumerate(index.ids.tolist())}
    asked = spark.createDataFrame([(at[r["id"]], r["terms"], r["counts"]) for r in rows], "place int, terms array<int>, counts array<int>")
    votes = asked.repartition(16).mapInArrow(_search_examples(model), "raw double, label long, rows long").groupBy("raw", "label").agg(F.sum("rows").alias("rows")).collect()
    model.centres, share, weight = isotonic([v["raw"] for v in votes], [float(v["label"]) for v in votes], [v["rows"] for v in votes])
    model.values = np.maximum.accumulate((share * weight + prior) / (weight + 1))
    return model


def held_out(key):
    """Whether an id's checksum puts it into the fold that labels are never taken from."""
    return F.coalesce(F.crc32(key.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def scores(spark: SparkSession, docs: DataFrame, labels: DataFrame, most=EXAMPLES, key="doc_id", text="text", label="toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence) of every row of docs."""
    sample = materialised(spark, examples(docs, labels, most, key, text, label), "toxic-examples")
    n, toxic = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    words = vocabulary(spark, sample) if 0 < toxic < n else []
    rows = with_terms(docs.select(F.col(key).alias("doc_id"), held_out(F.col(key)).alias("held_out"), F.col(text).alias("text")), words)
    rows = materialised(spark, rows, "toxic-terms")
    idf = np.log((rows.count() + 1) / (documents_with(rows, len(words)) + 0.5))
    model = fitted(spark, with_terms(sample.select("id", "toxic", "text"), words), idf)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                found = model.scored(part.column(2).to_pylist(), part.column(3).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.string())],
                                                 names=["doc_id", "held_out", "score", "evidence"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, evidence string").select(
        "doc_id", "held_out", "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"), "evidence")


def query(spark, sf_dir):
    return scores(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


#: Votes of neighbours are beyond SQL; tests hold search and scores against brute force and the labels held out.
ORACLE = None
