"""Removing repeated passages by a depth-limited radix sort of suffixes.

Two suffixes are ordered only as far as the threshold, 50 bytes; those that are
still equal there are the places of one repeated window.  The sort goes from the
most significant digit down and drops a group as soon as it lies in one document:

* The first digit of a suffix is its anchor, the piece of 16 bytes with the smallest
  hash among those that lie in its first 50 bytes.  Equal windows have equal
  anchors, and neighbouring suffixes mostly share theirs, so a run of suffixes moves
  as one short string instead of 50 bytes each.  Pass one is a shuffle of anchors
  alone: hash ranges count the documents of each anchor, and only suffixes whose
  anchor lies in two or more go on.
* The surviving runs are dealt out by the first digit, and each range refines its
  groups by the bytes themselves, eight a pass, until 50 bytes are compared.

Documents are held in chunks, by a hash of their id.  A chunk sends a string it
holds many times once, with its smallest document, so a passage that a third of all
documents share is one entry per chunk, and gets back which of its suffixes also
start in a smaller document.  The three places that read the texts (anchors, runs,
removal) share one shuffle of them.

Defined cases: a null text is empty; a text shorter than the threshold has nothing
to remove; rows that share an id are never smaller than each other, and equal ones
among them get equal results; a row without id is neither changed nor compared; an
empty table gives no rows; other columns, of whatever name, are kept aside.
"""

import hashlib
import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from tunewright.llm.blobs import from_cell, mix, range_of, to_cell
from tunewright.llm.common import packed_row, parts_for, text_bytes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEPTH = 50
PIECE = 16  # bytes of an anchor
REACH = DEPTH - PIECE + 1  # places of an anchor in a window, and so the most suffixes of a run
BLOCK = 1 << 20  # window starts that are hashed together
CHUNK_BYTES = 8 << 20
LEAST_RANGES = 64
POSITION = (1 << 21) - 1


class Chunk:
    """The distinct documents of a chunk laid end to end, in the order of id and hash, so that places in it are names."""

    def __init__(self, ids, texts):
        """ids without nulls (or None for a row to leave alone), texts as bytes."""
        rows = [(i, xxhash.xxh64_intdigest(t), k) for k, (i, t) in enumerate(zip(ids, texts)) if i is not None]
        rows.sort()
        self.document = np.full(len(texts), -1, np.int64)  # of every row
        parts, owners, last = [], [], None
        for i, h, k in rows:
            if (i, h) != last:
                last = (i, h)
                parts.append(texts[k])
                owners.append(i)
            self.document[k] = len(parts) - 1
        self.owner = np.array(owners, np.int64)
        self.ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        self.data = np.frombuffer(b"".join(parts), np.uint8)

    def document_of(self, places):
        return np.searchsorted(self.ends, places, "right") - 1

    def runs(self):
        """(place, length, anchor) of runs of windows with one anchor; no window leaves its document."""
        out = []
        n = len(self.data) - DEPTH + 1
        for start in range(0, max(n, 0), BLOCK):
            stop = min(start + BLOCK, n)
            part = self.data[start:stop + DEPTH - 1]
            eight = np.ndarray((len(part) - 7,), "<u8", part.tobytes(), strides=(1,)).copy()
            h = mix(eight[:-8] * np.uint64(0x9E3779B97F4A7C15) + eight[8:] * np.uint64(0xD6E8FEB86659FD93))
            least = h & ~np.uint64(POSITION) | np.arange(len(h), dtype=np.uint64)
            wide = 1
            while wide * 2 <= REACH:
                least = np.minimum(least[:-wide], least[wide:])
                wide *= 2
            if wide < REACH:
                least = np.minimum(least[:wide - REACH], least[REACH - wide:])
            at = (least & np.uint64(POSITION)).astype(np.int64)
            inside = np.ones(len(at), bool)
            for end in self.ends[np.searchsorted(self.ends, start, "right"):np.searchsorted(self.ends, stop + DEPTH - 1)]:
                inside[max(0, end - DEPTH + 1 - start):max(0, min(end, stop) - start)] = False
            change = np.concatenate([[True], (at[1:] != at[:-1]) | ~inside[:-1]]) & inside
            first = np.flatnonzero(change)
            if len(first):
                out.append((first + start, np.add.reduceat(inside.astype(np.int64), first), mix(h[at[first]])))  # the smallest hashes, spread evenly again
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return tuple(np.concatenate(c) for c in zip(*out))


def content_hashes(data, places, lengths, block=1 << 16):
    """Two hashes of each string data[place:place+length], of up to DEPTH + REACH - 1 bytes."""
    width = -(-(DEPTH + REACH - 1) // 8) * 8
    padded = np.concatenate([data, np.zeros(width, np.uint8)])
    one, two = np.empty(len(places), np.uint64), np.empty(len(places), np.uint64)
    step = np.arange(width)
    for k in range(0, len(places), block):
        n = lengths[k:k + block]
        rows = padded[places[k:k + block, None] + step]
        rows[step >= n[:, None]] = 0
        words = rows.view("<u8")
        a, b = n.astype(np.uint64), ~n.astype(np.uint64)
        for j in range(words.shape[1]):
            a = mix(a ^ words[:, j])
            b = (b ^ words[:, j]) * np.uint64(0x9FB21C651E98DF25)
            b ^= b >> np.uint64(29)
        one[k:k + block], two[k:k + block] = a, mix(b)
    return one, two


def equal_groups(one, two):
    """(order, first of each group in it) of equal pairs; members keep their order."""
    order = np.lexsort((two, one))
    a, b = one[order], two[order]
    return order, np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(order) else np.zeros(0, np.int64)


def _rows(schema, *columns):
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _chunk_of(table):
    ids = table.column("doc_id").to_pylist()
    return Chunk(ids, [t or b"" for t in table.column("text").cast(pa.binary()).to_pylist()])


ANCHORS_DDL = "bucket int, chunk int, cell binary"
ANCHORS = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("cell", pa.binary())])


def _anchors(ranges):
    """Per hash range, the anchors of a chunk and whether they lie in one of its documents (1) or more (2)."""
    def run(key, table):
        chunk = _chunk_of(table)
        place, _, anchor = chunk.runs()
        owner = chunk.owner[chunk.document_of(place)] if len(place) else place
        order = np.argsort(anchor, kind="stable")
        anchor, owner = anchor[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])) if len(anchor) else np.zeros(0, np.int64)
        many = np.ones(len(first), np.uint64)
        if len(first):
            many += (np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)).astype(np.uint64)
        anchor = anchor[first]
        at = range_of(anchor, ranges)
        some = [k for k in range(ranges) if at[k] < at[k + 1]]
        return _rows(ANCHORS, some, [key[0].as_py()] * len(some), [to_cell(anchor[at[k]:at[k + 1]], many[at[k]:at[k + 1]]) for k in some])

    return run


def _shared_anchors(batches):
    """Back to every chunk: those of its anchors that two or more documents have."""
    held = {}
    for batch in batches:
        for bucket, chunk, cell in zip(*(c.to_pylist() for c in batch.columns)):
            held.setdefault(bucket, []).append((chunk, cell))
    while held:
        bucket, cells = held.popitem()
        parts = [(chunk, *from_cell(cell)) for chunk, cell in cells]
        del cells
        keys, many = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
        chunk = np.repeat(np.array([p[0] for p in parts], np.int32), [len(p[1]) for p in parts])
        order = np.argsort(keys, kind="stable")
        keys, many, chunk = keys[order], many[order], chunk[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        alive = np.repeat(np.add.reduceat(many, first) > 1, np.diff(np.append(first, len(keys))))
        keys, chunk = keys[alive], chunk[alive]
        order = np.argsort(chunk, kind="stable")
        keys, chunk = keys[order], chunk[order]
        at = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]])) if len(chunk) else np.zeros(0, np.int64)
        ends = np.append(at[1:], len(chunk))
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(chunk[at]), pa.array([to_cell(keys[a:b]) for a, b in zip(at, ends)], pa.binary())], names=["chunk", "cell"])


RUNS_DDL = "bucket int, chunk int, kind int, entries binary, strings binary"
RUNS = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("kind", pa.int32()), ("entries", pa.binary()), ("strings", pa.binary())])
#: Kinds of cells: strings to compare, places with their masks, places that share the mask of another place.
STRINGS, MASKS, SAME = 0, 1, 2


def _slices(data, places, lengths):
    """The bytes of several strings, one after another."""
    step = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return data[np.repeat(places, lengths) + step]


def _surviving_runs(ranges):
    """Per hash range, the different strings of a chunk's surviving runs, each with its smallest document.

    Other places of a string stay with the chunk: in a larger document all their
    suffixes start earlier, in the same one they share the first place's mask.
    Both pass the ranges as they are, by the number of the chunk.
    """
    def run(key, table, cells):
        if not table.num_rows or not cells.num_rows:
            return RUNS.empty_table()
        codec, number = pa.Codec("zstd", compression_level=1), key[0].as_py()
        wanted = np.sort(np.concatenate([from_cell(c)[0] for c in cells.column("cell").to_pylist()]))
        chunk = _chunk_of(table)
        place, count, anchor = chunk.runs()
        found = np.minimum(np.searchsorted(wanted, anchor), len(wanted) - 1)
        alive = wanted[found] == anchor
        place, count, anchor = place[alive], count[alive], anchor[alive]
        if not len(place):
            return RUNS.empty_table()
        order, first = equal_groups(*content_hashes(chunk.data, place, count + DEPTH - 1))
        head = order[first]  # places ascend within a group, and with them the documents
        of = np.repeat(head, np.diff(np.append(first, len(order))))
        other = order != of
        mine, of = order[other], of[other]
        same = chunk.owner[chunk.document_of(place[mine])] == chunk.owner[chunk.document_of(place[of])]
        out = []
        for kind, at, beside in ((MASKS, mine[~same], _full(count[mine[~same]])), (SAME, mine[same], place[of[same]].astype(np.uint64))):
            if len(at):
                by = np.argsort(place[at], kind="stable")
                out.append((number % ranges, number, kind, to_cell(place[at][by].astype(np.uint64), beside[by]), b""))
        by = np.argsort(anchor[head], kind="stable")
        keys = anchor[head][by]
        at = range_of(keys, ranges)
        for b in range(ranges):
            mine = head[by[at[b]:at[b + 1]]]
            if len(mine):
                owner = chunk.owner[chunk.document_of(place[mine])]
                entries = to_cell(keys[at[b]:at[b + 1]], place[mine], count[mine], owner.view(np.uint64))
                strings = _slices(chunk.data, place[mine], count[mine] + DEPTH - 1).tobytes()
                out.append((b, number, STRINGS, entries, codec.compress(strings, asbytes=True)))
        return _rows(RUNS, *zip(*out))

    return run


def _full(count):
    """Masks of whole runs."""
    return (np.uint64(1) << count.astype(np.uint64)) - np.uint64(1)


def refined(data, starts, groups, owners):
    """For each suffix the smallest owner among those of its group that are equal to DEPTH bytes.

    Most significant digit first, eight bytes a pass; a group of one owner is
    finished as soon as it is that.
    """
    least = owners.copy()
    active = np.arange(len(starts))
    eight = np.ndarray((max(0, len(data) - 7),), "<u8", np.ascontiguousarray(data).tobytes(), strides=(1,))
    for at in [*range(0, DEPTH - 7, 8), DEPTH - 8]:
        if not len(active):
            return least
        digit = eight[starts[active] + at]
        order = np.lexsort((digit, groups))
        active, digit, groups = active[order], digit[order], groups[order]
        first = np.concatenate([[True], (digit[1:] != digit[:-1]) | (groups[1:] != groups[:-1])])
        begin = np.flatnonzero(first)
        size = np.diff(np.append(begin, len(active)))
        low, high = np.minimum.reduceat(owners[active], begin), np.maximum.reduceat(owners[active], begin)
        alive = np.repeat(low != high, size)
        groups = np.repeat(np.arange(len(begin)), size)[alive]
        active = active[alive]
        low = np.repeat(low, size)[alive]
    least[active] = low
    return least


SHARED_DDL = "chunk int, cell binary"
COVER_DDL = "chunk int, kind int, cell binary"
SLICE = 1 << 20  # suffixes that are refined together


def earlier_starts(key, count, owner, starts, data):
    """For each string a mask: bit i is set if its i-th suffix also starts in a document before the string's own.

    key is the strings' common first digit, ascending.
    """
    # equal strings of different chunks count as one, that of the smallest document
    order, first = equal_groups(*content_hashes(data, starts, count + DEPTH - 1))
    string = np.empty(len(order), np.int64)
    string[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
    low = np.minimum.reduceat(owner[order], first)
    head = order[first]
    # the windows of those strings whose anchor has other strings too
    by = np.argsort(key[head], kind="stable")
    k = key[head][by]
    group = np.cumsum(np.concatenate([[True], k[1:] != k[:-1]])) - 1
    shared = np.bincount(group)[group] > 1
    some, group = by[shared], group[shared]
    n = count[head[some]]
    step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    least = refined(data, np.repeat(starts[head[some]], n) + step, np.repeat(group, n), np.repeat(low[some], n))
    mask = np.where(low[string] < owner, _full(count), np.uint64(0))
    where = np.full(len(first), -1, np.int64)
    where[some] = np.cumsum(n) - n
    entry = np.flatnonzero((mask == 0) & (where[string] >= 0))
    if len(entry):
        m = count[entry]
        step = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
        before = least[np.repeat(where[string[entry]], m) + step] < np.repeat(owner[entry], m)
        mask[entry] = np.add.reduceat(before.astype(np.uint64) << step.astype(np.uint64), np.cumsum(m) - m)
    return mask


def _cover(chunks, kinds, cells):
    return pa.RecordBatch.from_arrays([pa.array(chunks, pa.int32()), pa.array(kinds, pa.int32()), pa.array(cells, pa.binary())], names=["chunk", "kind", "cell"])


def _covered(batches):
    """Back to every chunk: places whose suffixes start in a smaller document, as masks over the run."""
    held = {}
    for batch in batches:
        for bucket, chunk, kind, entries, strings in zip(*(c.to_pylist() for c in batch.columns)):
            if kind == STRINGS:
                held.setdefault(bucket, []).append((chunk, entries, strings))
            else:
                yield _cover([chunk], [kind], [entries])
    codec = pa.Codec("zstd")
    while held:
        bucket, rows = held.popitem()
        parts = [(chunk, from_cell(entries), strings) for chunk, entries, strings in rows]
        del rows
        key, place, count, owner = (np.concatenate([p[1][k] for p in parts]) for k in range(4))
        place, count, owner = place.astype(np.int64), count.astype(np.int64), owner.view(np.int64)
        chunk = np.repeat(np.array([p[0] for p in parts], np.int32), [len(p[1][0]) for p in parts])
        sizes = [int(p[1][2].sum()) + len(p[1][2]) * (DEPTH - 1) for p in parts]
        data = np.frombuffer(b"".join(codec.decompress(p[2], decompressed_size=s, asbytes=True) for p, s in zip(parts, sizes)), np.uint8)
        del parts
        starts = np.cumsum(count + DEPTH - 1) - (count + DEPTH - 1)
        # whole first digits at a time, so that what is refined together stays small
        order = np.argsort(key, kind="stable")
        k = key[order]
        begins = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        so_far = np.cumsum(count[order])
        mask = np.zeros(len(key), np.uint64)
        at = 0
        while at < len(order):
            limit = int(np.searchsorted(so_far, (so_far[at - 1] if at else 0) + SLICE))
            later = begins[np.searchsorted(begins, max(limit, at + 1)):]
            end = int(later[0]) if len(later) else len(order)
            mine = order[at:end]
            lengths = count[mine] + DEPTH - 1
            part = _slices(data, starts[mine], lengths)
            mask[mine] = earlier_starts(key[mine], count[mine], owner[mine], np.cumsum(lengths) - lengths, part)
            at = end
        some = np.flatnonzero(mask)
        some = some[np.lexsort((place[some], chunk[some]))]
        chunk, place, mask = chunk[some], place[some].astype(np.uint64), mask[some]
        if len(chunk):
            at = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]]))
            ends = np.append(at[1:], len(chunk))
            yield _cover(chunk[at], [MASKS] * len(at), [to_cell(place[a:b], mask[a:b]) for a, b in zip(at, ends)])


def removed_bytes(chunk, kinds, cells):
    """Mask of the chunk's bytes that a marked window covers."""
    marked = [from_cell(c) for k, c in zip(kinds, cells) if k == MASKS]
    if marked:
        places, masks = (np.concatenate(c) for c in zip(*marked))
        order = np.argsort(places, kind="stable")
        places, masks = places[order], masks[order]
        for place, first in (from_cell(c) for k, c in zip(kinds, cells) if k == SAME):
            at = np.minimum(np.searchsorted(places, first), len(places) - 1)
            hit = places[at] == first
            marked.append([place[hit], masks[at[hit]]])
    change = np.zeros(len(chunk.data) + DEPTH + 1, np.int32)
    for places, masks in marked:
        for bit in range(REACH):
            start = places[(masks >> np.uint64(bit)) & np.uint64(1) == 1].astype(np.int64) + bit
            np.add.at(change, start, 1)
            np.add.at(change, start + DEPTH, -1)
    return np.cumsum(change)[:len(chunk.data)] > 0


def spans(gone):
    return int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1])) if len(gone) else 0


DIGEST_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
DIGEST = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def _rest_of(table, cells):
    """(row, bytes, removed mask or None) of every row of a chunk."""
    chunk = _chunk_of(table)
    gone = removed_bytes(chunk, cells.column("kind").to_pylist(), cells.column("cell").to_pylist()) if cells.num_rows else None
    for row, document in enumerate(chunk.document):
        if document < 0:
            text = table.column("text")[row].as_py()
            yield row, np.frombuffer((text or "").encode() if not isinstance(text, bytes) else text, np.uint8), None
        else:
            a, b = chunk.ends[document], chunk.ends[document + 1]
            yield row, chunk.data[a:b], None if gone is None or not gone[a:b].any() else gone[a:b]


def _digests(key, table, cells):
    out = []
    ids = table.column("doc_id").to_pylist() if table.num_rows else []
    for row, data, gone in _rest_of(table, cells) if ids else ():
        kept = data if gone is None else data[~gone]
        out.append((ids[row], len(data), len(data) - len(kept), 0 if gone is None else spans(gone), hashlib.sha256(kept.tobytes()).hexdigest()))
    return _rows(DIGEST, *zip(*out)) if out else DIGEST.empty_table()


def whole_characters(data, gone):
    """The mask without the bytes of characters that are only partly in it."""
    start = (data & 0xC0) != 0x80
    first = np.flatnonzero(start)
    size = np.diff(np.append(first, len(data)))
    return np.repeat(np.add.reduceat(gone.astype(np.int64), first) == size, size)


def _texts(schema):
    """The rows with what is left of the text; a character that only partly repeats stays."""
    def run(key, table, cells):
        if not table.num_rows:
            return schema.empty_table()
        texts = []
        for row, data, gone in _rest_of(table, cells):
            texts.append((data if gone is None else data[~whole_characters(data, gone)]).tobytes().decode())
        # a text that was null stays null: nothing is removed from it
        null = table.column("text").is_null().to_pylist()
        return pa.table([table.column("_row"), pa.array([None if n else t for n, t in zip(null, texts)], pa.string())], names=["_row", "_left"]).cast(schema)

    return run


def _marked(spark: SparkSession, docs: DataFrame):
    """(chunked documents, cells of marked places by chunk); docs has doc_id, text and what is carried."""
    n_bytes = text_bytes(docs, "text")
    parts = parts_for(spark, n_bytes, CHUNK_BYTES)
    ranges = max(LEAST_RANGES, parts_for(spark, n_bytes, 2 * CHUNK_BYTES))
    name = F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text")))
    # twice as many chunks as partitions even out what a hash deals to each
    dealt = docs.withColumn("chunk", F.pmod(name, F.lit(2 * parts)).cast("int")).repartition(parts, "chunk")
    anchors = dealt.groupBy("chunk").applyInArrow(_anchors(ranges), ANCHORS_DDL)
    shared = anchors.repartition(ranges, "bucket").mapInArrow(_shared_anchors, SHARED_DDL)
    runs = dealt.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(_surviving_runs(ranges), RUNS_DDL)
    covered = runs.repartition(ranges, "bucket").mapInArrow(_covered, COVER_DDL)
    return dealt, covered


def digests(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the digest of what is left, one row per row of docs."""
    dealt, covered = _marked(spark, docs.select(F.col("doc_id").cast("long"), "text"))
    return dealt.groupBy("chunk").cogroup(covered.groupBy("chunk")).applyInArrow(_digests, DIGEST_DDL)


def without_repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of docs with repeated passages cut out of `text`, and `n_chars`, if there is one, set to the new length."""
    from pyspark.sql.pandas.types import to_arrow_schema

    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), packed_row(docs.drop("text")).alias("_row"))
    dealt, covered = _marked(spark, packed)
    schema = packed.select("_row", F.col("text").alias("_left")).schema
    rows = dealt.groupBy("chunk").cogroup(covered.groupBy("chunk")).applyInArrow(_texts(to_arrow_schema(schema)), schema)
    kept = {c: F.col("_left") if c == "text" else F.col("_row").getField(c) for c in docs.columns}
    if "n_chars" in kept:
        kept["n_chars"] = F.length("_left").cast(docs.schema["n_chars"].dataType)
    return rows.select(*[c.alias(name) for name, c in kept.items()])


def query(spark, sf_dir):
    return digests(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
