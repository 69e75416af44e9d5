"""Exact top-k inner products by block-at-a-time pruning.

Vectors become integers, floor(256 x).  The rows are dealt into groups by a hash
of their id and the queries are sent to every group, in batches, so that a cell
holds a bounded number of both whatever the table.  Inside a cell the documents
are put in an order in which neighbours are alike (signs along the main axes of
the cell) and cut into blocks of consecutive documents.  A block keeps its forward
index, the matrix of its vectors, and for every term (a component, with either
sign) the largest weight that a document of the block gives it.  For a query the
sum of the term maxima bounds every score of the block; blocks are scored in the
order of their bounds until the next bound is below the k-th score.  A bound that
equals it is still scored, for ties go to the smaller id.

Each cell returns k rows a query, and a second, small ranking merges the cells.

Defined cases: a vector that is null or holds a null or non-finite component takes
no part, as query or candidate; missing components of shorter vectors count as
zero; rows that share the query's id are its own and no candidates; a query id
that occurs on several rows asks once, with its smallest vector; an empty table
gives no rows; other columns, of whatever name, are not read.  Scores must fit 63
bits.
"""

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 64
CELL_VECTORS, CELL_QUERIES, LEAST_GROUPS = 16384, 4096, 256
NONE = np.iinfo(np.int64).min


def _matrix(column, width):
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, ends = np.asarray(lists.flatten(), dtype=np.int64), np.asarray(lists.offsets)
    out, lengths = np.zeros((len(lists), width), np.int64), np.diff(ends)
    step = np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], lengths)
    out[np.repeat(np.arange(len(lists)), lengths), step] = flat
    return out


def _like_order(x):
    """An order of the rows in which neighbours lie on the same side of the main axes."""
    centred = (x - x.mean(axis=0)).astype(np.float64)
    _, axes = np.linalg.eigh(centred.T @ centred)
    side = centred @ axes[:, ::-1][:, :12] > 0
    gray = np.bitwise_xor.accumulate(side.astype(np.uint8), axis=1)
    return np.lexsort(gray.T[::-1])


class Blocks:
    """Document-range blocks: forward index, ids and term maxima."""

    def __init__(self, ids, x, block=BLOCK):
        order = _like_order(x) if len(ids) > block else np.arange(len(ids))
        self.ids, self.x = ids[order], x[order]
        # float products of such integers are exact and use the vector units
        self.type = np.float64 if x.shape[1] * float(np.abs(x).max(initial=0)) ** 2 < 2.0 ** 52 else np.int64
        self.x = self.x.astype(self.type)
        self.at = np.arange(0, len(ids), block)
        self.high, self.low = np.maximum.reduceat(self.x, self.at), np.minimum.reduceat(self.x, self.at)
        self.block = block

    def top(self, query_ids, q, k):
        """scores and ids (queries x k), best first; NONE where there are fewer, and how many blocks were scored."""
        q = q.astype(self.type if float(np.abs(q).max(initial=0)) ** 2 * q.shape[1] < 2.0 ** 52 else np.int64)
        bounds = np.maximum(q, 0) @ self.high.T + np.minimum(q, 0) @ self.low.T
        order = np.argsort(-bounds, axis=1, kind="stable")
        score = np.full((len(q), k), NONE, np.int64)
        found = np.full((len(q), k), np.iinfo(np.int64).max, np.int64)
        scored, active = 0, np.arange(len(q))
        for step in range(len(self.at)):
            nxt = order[active, step]
            live = bounds[active, nxt] >= score[active, -1]
            active, nxt = active[live], nxt[live]
            if not len(active):
                break
            by = np.argsort(nxt, kind="stable")
            for some in np.split(by, np.flatnonzero(np.diff(nxt[by])) + 1):
                who, start = active[some], self.at[nxt[some[0]]]
                ids = self.ids[start:start + self.block]
                new = (q[who] @ self.x[start:start + self.block].T).astype(np.int64)
                own = query_ids[who][:, None] == ids
                new[own] = NONE
                all_score = np.concatenate([score[who], new], axis=1)
                all_id = np.concatenate([found[who], np.where(own, np.iinfo(np.int64).max, ids)], axis=1)
                best = np.lexsort((all_id, -np.maximum(all_score, NONE + 1)), axis=-1)[:, :k]
                score[who], found[who] = np.take_along_axis(all_score, best, 1), np.take_along_axis(all_id, best, 1)
                scored += len(who)
        return score, found, scored


def _cell(k):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(vectors, queries):
        if not vectors.num_rows or not queries.num_rows:
            return schema.empty_table()
        width = max(max((len(v) for v in t["x"]), default=0) for t in (vectors, queries)) or 1
        ids, asked = np.asarray(vectors["vec_id"]), np.asarray(queries["vec_id"])
        score, found, _ = Blocks(ids, _matrix(vectors["x"], width)).top(asked, _matrix(queries["x"], width), k)
        have = score > NONE
        return pa.table([np.repeat(asked, have.sum(axis=1)), found[have], score[have]], schema=schema)

    return run


def quantised(df: DataFrame, key="vec_id", vector="embedding") -> DataFrame:
    """(vec_id, x): integer vectors of the rows that take part."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return df.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).where(F.coalesce(finite, F.lit(False))).select(
        F.col(key).cast("long").alias("vec_id"), F.transform(vector, lambda v: F.floor(v.cast("double") * 256).cast("long")).alias("x"))


def top_k(vectors: DataFrame, queries: DataFrame, k=5, groups=None, batches=None) -> DataFrame:
    """query_id, rank, vec_id, score over quantised vectors and queries (vec_id, x)."""
    if groups is None or batches is None:
        n, m = vectors.count(), queries.count()
        groups, batches = groups or max(LEAST_GROUPS, -(-n // CELL_VECTORS)), batches or max(1, -(-m // CELL_QUERIES))
    queries = queries.groupBy("vec_id").agg(F.min("x").alias("x"))
    dealt = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = vectors.select("vec_id", "x", dealt(groups).alias("g"), every(batches).alias("b"))
    right = queries.select("vec_id", "x", dealt(batches).alias("b"), every(groups).alias("g"))
    found = left.groupBy("g", "b").cogroup(right.groupBy("g", "b")).applyInArrow(_cell(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir):
    vectors = quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
, s AS (SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.x, d.x)::BIGINT AS score FROM v q JOIN v d ON d.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
