"""Shards of near equal bytes over fixed virtual slots.

A record's slot is a hash of its id, out of a few thousand that never change.
Bytes and rows are summed per slot, so whatever the size of the corpus the
slot-to-shard map is a table of that many rows.  The map is versioned: version 0
cuts the slots evenly, and a rebalance writes the next version, in which single
slots have moved from the fullest shard to the emptiest.  Records of unmoved
slots stay where they are.

The law is `bytes`: shard sizes end up within about the smallest slot of each
other.  A record's place in its shard is the rows of the shard's earlier slots
plus its rank in its own slot, so no window spans more than a slot.

Defined cases: a null text has no bytes and the checksum of an empty text; a
null id is replaced by the text in the hash; rows that share an id share a slot
and get places of their own; an empty table gives no rows; other columns, of
whatever name, are not read.
"""

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tunewright.llm.common import shared_dir

SLOTS = 4096
SHARDS = 16


def with_slot(docs: DataFrame, n_slots=SLOTS, key="doc_id", text="text") -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot) of every record."""
    return docs.select(
        F.col(key).alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("text_crc32"),
        F.pmod(F.xxhash64(key, F.when(F.col(key).isNull(), F.col(text))), F.lit(n_slots)).cast("int").alias("virtual_slot"))


def even_map(n_slots=SLOTS, shards=SHARDS):
    """Version 0: neighbouring slots in runs of one length."""
    return np.arange(n_slots) * shards // n_slots


def _edit(load, shard_of, full, empty, gap):
    """The move, or the swap, between two shards that comes closest to halving their difference: (bytes, slot, slot back or None)."""
    mine, theirs = np.flatnonzero((shard_of == full) & (load > 0)), np.flatnonzero(shard_of == empty)
    if not len(mine):
        return 0, None, None
    best = (load[mine][k := np.abs(2 * load[mine] - gap).argmin()], mine[k], None)
    theirs = theirs[np.argsort(load[theirs], kind="stable")]
    for side in (0, 1) if len(theirs) else ():  # the neighbours on either side of the wanted size
        at = np.clip(np.searchsorted(load[theirs], load[mine] - gap // 2) - side, 0, len(theirs) - 1)
        change = load[mine] - load[theirs[at]]
        k = np.abs(2 * change - gap).argmin()
        if abs(2 * change[k] - gap) < abs(2 * best[0] - gap):
            best = (change[k], mine[k], theirs[at[k]])
    return best


def rebalanced(load, shard_of, shards=SHARDS):
    """The map edited by single moves and swaps from fuller to emptier shards, until none makes a difference smaller."""
    shard_of = shard_of.copy()
    held = np.bincount(shard_of, weights=load, minlength=shards).astype(np.int64)
    for _ in range(20 * len(load)):
        order = np.argsort(held, kind="stable")
        for full, empty in ((int(f), int(e)) for f in order[::-1] for e in order if held[f] - held[e] >= 2):
            gap = held[full] - held[empty]
            moved, slot, back = _edit(load, shard_of, full, empty, gap)
            if 0 < moved < gap:
                break
        else:
            break
        shard_of[slot] = empty
        if back is not None:
            shard_of[back] = full
        held[full] -= moved
        held[empty] += moved
    return shard_of


def save_map(spark: SparkSession, path, version, shard_of):
    """Adds a version to the map's table; earlier versions stay readable."""
    rows = [(version, slot, int(shard)) for slot, shard in enumerate(shard_of)]
    spark.createDataFrame(rows, "version int, slot int, shard int").coalesce(1).write.mode("append").parquet(path)


def load_map(spark: SparkSession, path, version=None):
    """(version, shard by slot) of the wanted version, or of the latest."""
    table = spark.read.parquet(path)
    version = version if version is not None else table.agg(F.max("version")).first()[0]
    rows = table.where(F.col("version") == version).orderBy("slot").select("shard").collect()
    return version, np.array([r[0] for r in rows])


def placed(spark: SparkSession, docs: DataFrame, n_slots=SLOTS, shards=SHARDS, key="doc_id", text="text", map_path=None) -> DataFrame:
    """Every record with its shard and its place there, under the latest map after a rebalance.

    What reaches the driver are n_slots rows of counts, whatever the corpus.
    """
    records = with_slot(docs, n_slots, key, text)
    rows, load = np.zeros(n_slots, np.int64), np.zeros(n_slots, np.int64)
    for slot, n, b in records.groupBy("virtual_slot").agg(F.count("*"), F.sum("size")).collect():
        rows[slot], load[slot] = n, b
    path = map_path or shared_dir(spark, "slot-map")
    if map_path is None:
        save_map(spark, path, 0, even_map(n_slots, shards))
    version, shard_of = load_map(spark, path)
    save_map(spark, path, version + 1, rebalanced(load, shard_of, shards))
    version, shard_of = load_map(spark, path)
    first = np.zeros(n_slots, np.int64)
    for shard in range(shards):
        mine = np.flatnonzero(shard_of == shard)
        first[mine] = np.cumsum(rows[mine]) - rows[mine]
    # n_slots rows of three numbers: its size is fixed by the parameter
    places = spark.createDataFrame([(s, int(shard_of[s]), int(first[s])) for s in range(n_slots)], "virtual_slot int, shard int, first long")
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return records.withColumn("rank", rank).join(F.broadcast(places), "virtual_slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("rank") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.lit(int(version)).alias("map_version"))


def query(spark, sf_dir):
    return placed(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
