"""Helpers that several operators of this folder share."""

import os
import sys
import types

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from tunewright.session import materialised, shared_dir, table  # noqa: F401

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

#: Raw text bytes that one task should hold when an operator deals texts out itself.
TASK_BYTES = 24 << 20


def words_of(text):
    """Column: the words of a text as an array; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP, -1), "")


def text_bytes(df, text):
    """Bytes of all texts, one number; a narrow aggregate."""
    return df.agg(F.sum(F.octet_length(text))).first()[0] or 0


def parts_for(spark, n_bytes, per_task=TASK_BYTES, least=None):
    """Partitions so that each holds about per_task bytes, and the session's shuffle partitions at least."""
    return max(least or int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(n_bytes) // per_task))


def packed_row(df):
    """All columns of df as one struct, so that working columns beside it can have any name."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def unpacked(df, row, columns):
    return df.select(*[F.col(row).getField(c).alias(c) for c in columns])


def batches_of(rows, schema, limit):
    """Arrow batches of at most `limit` rows from a list of column lists."""
    n = len(rows[0])
    for start in range(0, n, limit):
        yield pa.RecordBatch.from_arrays([pa.array(c[start:start + limit], f.type) for c, f in zip(rows, schema)], schema=schema)


def components(spark: SparkSession, edges: DataFrame, purpose: str, most_rounds: int = 60) -> DataFrame:
    """Connected components of edges (a long, b long): rows (node, component), component the smallest node.

    Rounds of large-star and small-star joins on the smallest neighbour; every
    round is written to the shared folder, so a lost executor costs one round
    and the plan stays short.  Both steps keep at most as many edges as there
    were.  A hub's neighbours are reduced to their minimum map-side and the
    rewrite is a row-level join that AQE may split.
    """
    edges = materialised(spark, edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), purpose)
    before = None
    for _ in range(most_rounds):
        # large star: neighbours larger than u are tied to the smallest of u's neighbourhood
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = materialised(spark, large.where("a <> b").distinct(), purpose)
        # small star: u and its smaller neighbours are tied to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        edges = materialised(spark, small.where("a <> b").distinct(), purpose)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"no fixed point after {most_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def per_process(name, make):
    """An object that a Python worker keeps from task to task, made by its first; only for what any task could make anew."""
    state = sys.modules.setdefault("tunewright_worker_state", types.ModuleType("tunewright_worker_state"))
    if not hasattr(state, name):
        setattr(state, name, make())
    return getattr(state, name)


def shared_file(uri):
    """(file system, path) of a place in the shared folder, for code in tasks; any store that Arrow knows."""
    if uri.startswith("file:"):
        uri = "/" + uri[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


class SharedWriter:
    """Appends bytes to a file of its own in the shared folder; it appears under its name when closed without error."""

    def __init__(self, uri):
        self.fs, self.path = shared_file(uri)
        self.fs.create_dir(os.path.dirname(self.path), recursive=True)
        self.stream, self.at = self.fs.open_output_stream(self.path + ".open"), 0

    def write(self, data):
        self.stream.write(data)
        self.at += len(data)

    def close(self):
        self.stream.close()
        self.fs.move(self.path + ".open", self.path)
