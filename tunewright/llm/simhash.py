"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint has a bit for every bit position that is set in more than
half of the hashes of its word shingles.  Fingerprints link when they differ in at
most two bits.  The index holds, for every distinct fingerprint and every segment
of it, the small Hamming ball of that segment: the fingerprint with each single
bit of the segment turned, and the fingerprint itself once.  Two fingerprints
that differ in at most two bits always meet in an entry (both turn one of the bits
in which they differ, whichever segments these lie in), and what meets is verified
by the complete distance.  An entry is met by 65 distinct fingerprints at the most,
so no group of copies makes a large bucket; its members are tied to the smallest
one, which is within two bits of all of them.

Copies share a fingerprint and enter the index once.  Components of the links are
found in rounds of star joins (common.components).

Defined cases: a null or empty text, or one of white space, has fingerprint zero
and is linked like any other; a text of fewer words than a shingle is hashed
whole; rows that share an id are rows of their own; a null id is never the name
of a component unless all its members have none; an empty table gives no rows;
other columns, of whatever name, are kept aside.
"""

import itertools
import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tunewright.llm.common import components, materialised, packed_row, unpacked

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE, SEED, MAX_BITS, SEGMENTS = 3, 42, 2, 4


def fingerprint(text, shingle=SHINGLE, seed=SEED, chunk=1 << 16):
    """64-bit fingerprint of a text, as a signed integer."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z are lowered, only ASCII white space parts words
    if not words:
        return 0
    if len(words) < shingle:
        pieces, n = iter((b" ".join(words),)), 1
    else:
        pieces, n = map(b" ".join, zip(*(itertools.islice(words, k, None) for k in range(shingle)))), len(words) - shingle + 1
    count, digest = np.zeros(64, np.int64), xxhash.xxh64_digest
    while part := b"".join([digest(p, seed) for p in itertools.islice(pieces, chunk)]):
        count += np.unpackbits(np.frombuffer(part, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > n).tobytes(), "big", signed=True)


def _with_fingerprint(shingle, seed):
    def run(batches):
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            found = pa.array((fingerprint(t.as_py(), shingle, seed) for t in column), pa.int64(), size=len(column))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found], names=[*batch.schema.names[:-1], "fp"])

    return run


def fingerprinted(docs: DataFrame, text="text", carry=("doc_id",), shingle=SHINGLE, seed=SEED) -> DataFrame:
    """The carried columns and fp; the text itself is read and dropped."""
    frame = docs.select(*carry, F.col(text).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:-1])
    return frame.mapInArrow(_with_fingerprint(shingle, seed), f"{kinds}, fp long")


def links(prints: DataFrame, segments=SEGMENTS) -> DataFrame:
    """Verified links (a, b) of distinct fingerprints (fp): each index entry ties what it holds to the smallest."""
    width = 64 // segments
    balls = [F.shiftleft(F.lit(1).cast("long"), s * width + bit) for s in range(segments) for bit in range(width)]
    entries = prints.select("fp", F.explode(F.array(F.lit(0).cast("long"), *balls)).alias("turned"))
    entries = entries.select("fp", F.col("fp").bitwiseXOR(F.col("turned")).alias("entry"))
    met = entries.withColumn("first", F.min("fp").over(Window.partitionBy("entry"))).where("fp <> first")
    return met.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("first"))) <= MAX_BITS).select(F.col("fp").alias("a"), F.col("first").alias("b")).distinct()


def groups(spark: SparkSession, prints: DataFrame) -> DataFrame:
    """(fp, root, component_id) for every distinct fingerprint of rows (doc_id, fp)."""
    distinct = materialised(spark, prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "fingerprints")
    roots = components(spark, links(distinct), "simhash")
    labelled = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", F.coalesce("component", "fp").alias("root"), "doc_id")
    labelled = materialised(spark, labelled, "simhash-roots")
    return labelled.join(labelled.groupBy("root").agg(F.min("doc_id").alias("component_id")), "root").select("fp", "root", "component_id")


def deduplicated(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row of each group, that with the smallest doc_id, with the columns of docs."""
    packed = docs.select(packed_row(docs).alias("_row"), F.col("doc_id"), F.col("text"))
    rows = materialised(spark, fingerprinted(packed, carry=("_row", "doc_id")), "simhash-rows")
    found = groups(spark, rows.select("doc_id", "fp"))
    first = rows.select("doc_id", "fp").join(found.select("fp", "root"), "fp").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")).alias("first"))
    # join and window share one dealing of the texts: the key of a null id is a value of its own
    key = ["_none", "_id", "fp"]
    keyed = lambda frame, i: frame.withColumns({"_none": F.col(i).isNull(), "_id": F.coalesce(F.col(i), F.lit(0))})
    first = keyed(first.select(F.col("first.doc_id").alias("keep_id"), F.col("first.fp").alias("fp")), "keep_id").select(*key)
    kept = keyed(rows, "doc_id").select(*key, "_row").join(first, key)
    once = F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64("_row")))
    return unpacked(kept.withColumn("_n", once).where("_n = 1"), "_row", docs.columns)


def query(spark, sf_dir):
    rows = materialised(spark, fingerprinted(spark.read.parquet(f"{sf_dir}/documents.parquet")), "simhash-rows")
    return rows.join(groups(spark, rows), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
