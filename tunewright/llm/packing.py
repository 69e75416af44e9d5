"""Packing documents into sequences along a space-filling curve.

A document's byte four-grams are hashed into a vector, which fixed random signs
project to three dimensions; its place on a Hilbert curve through them is the sort
key.  The table is cut into ranges of about equal bytes of that key (and a hash, which
parts equal texts), by borders from a sample of rows, and each task packs its own stretch of the curve: the documents' tokens,
each followed by the end token, are one stream that is cut every 4096 tokens, so
documents that share a sequence are neighbours on the curve.  What is left at a
task's end is cut into powers of two.  So no sequence needs padding.

Text is tokenised once, in the task that packs it.  Words are cut at ASCII white
space, which the tokenizer drops and never merges across, and plain ones at the
tokenizer's own borders within them, for all bytes of a piece of text at once.  The
different runs of a piece are looked up once each, and a bounded table of the worker
process remembers the ids of runs.

Defined cases: a null or empty text is the end token alone; a text of any length
is tokenised in pieces; rows that share an id are packed each by itself; a null id
is kept; an empty table gives no rows; other columns, of whatever name, are not
read.
"""

import itertools
import json
import os
import sys
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from tunewright.llm.common import parts_for, per_process

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 4096
END = 2
TOKENIZER = "word_bpe_49k.json"
BUCKETS, DIMENSIONS, BITS = 256, 3, 16
PIECE = 2 << 20  # bytes of text that are looked at together
REMEMBERED = 350_000  # runs in each of two tables
TOGETHER = 512  # new runs that are tokenised as one text
SPACE, LETTER, DIGIT, MARK, ODD = range(5)  # kinds of bytes
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SAMPLE, MOST_SAMPLED = 200, 1_000_000  # rows looked at to place a range's border, and for all borders together


def hilbert(coordinates, bits=BITS):
    """Index on the Hilbert curve of integer points (n x d): rotations undone from the top bit, Gray code, bits interleaved."""
    x = [c.astype(np.uint64) for c in coordinates.T]
    one, top = np.uint64(1), np.uint64(1 << (bits - 1))
    q = top
    while q > one:
        low = q - one
        for axis in x:
            high = (axis & q) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ axis) & low)
            x[0] ^= np.where(high, low, swap)
            if axis is not x[0]:
                axis ^= swap
        q >>= one
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    flip = np.zeros_like(x[0])
    q = top
    while q > one:
        flip ^= np.where((x[-1] & q) != 0, q - one, np.uint64(0))
        q >>= one
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            out = (out << one) | (((axis ^ flip) >> np.uint64(bit)) & one)
    return out.astype(np.int64)


def _text_column(column):
    """Bytes of all texts in one array, and where each starts and ends."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None and len(column) else np.zeros(0, np.uint8)
    return data, ends


def curve_keys(column):
    """Hilbert keys of a column of texts."""
    data, ends = _text_column(column)
    n = len(column)
    signs = np.random.default_rng(1).choice([-1.0, 1.0], (BUCKETS, DIMENSIONS)) / np.sqrt(BUCKETS)
    places = np.empty((n, DIMENSIONS))
    first = 0
    while first < n:  # texts of about PIECE bytes at once, a longer one alone
        last = min(max(first + 1, int(np.searchsorted(ends, ends[first] + PIECE, "right")) - 1), first + PIECE // BUCKETS // 8)
        counts = np.zeros((last - first, BUCKETS))
        part = data[ends[first]:ends[last]]
        if len(part) >= 4:
            gram = np.ndarray(len(part) - 3, "<u4", part, strides=(1,))
            bucket = ((gram * np.uint32(2654435761)) >> np.uint32(24)).astype(np.int64)
            at = (ends[first:last + 1] - ends[first]).tolist()
            for k, (a, b) in enumerate(itertools.pairwise(at)):
                if b - a >= 4:
                    counts[k] = np.bincount(bucket[a:b - 3], minlength=BUCKETS)
        # BUCKETS numbers a text are kept for one piece only
        places[first:last] = np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)) @ signs
        first = last
    return hilbert(((places + 1) / 2 * ((1 << BITS) - 1)).astype(np.uint64))


def _keys(curve, other):
    """Keys (curve, other) as fixed strings of bytes in their order."""
    both = np.empty((len(curve), 2), ">u8")
    both[:, 0], both[:, 1] = curve, np.asarray(other).astype(np.int64).astype(np.uint64) + np.uint64(1 << 63)
    return both.view("S16").ravel()


def _with_key(borders=None):
    """Task: doc_id, text and other with the text's place on the curve and, given borders, the range it lies in."""
    def run(batches):
        for batch in batches:
            curve = curve_keys(batch.column(1))
            columns = [*batch.columns, pa.array(curve)]
            if borders is not None:
                columns.append(pa.array(np.searchsorted(borders, _keys(curve, batch.column(2)), "right").astype(np.int32)))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "other", "curve", "part"][:len(columns)])
    return run


def _measured(batches):
    """Task: the keys of its rows and the bytes of their texts, one cell each."""
    keys, sizes = [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column(1).cast(pa.binary())
        ends = np.frombuffer(text.buffers()[1], np.int32)[text.offset:text.offset + len(text) + 1].astype(np.int64)
        keys.append(_keys(curve_keys(batch.column(1)), batch.column(2)))
        sizes.append(np.diff(ends) + 1)
    if keys:
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(c).tobytes()], pa.binary()) for c in (keys, sizes)], names=["keys", "sizes"])


def borders_of(frame: DataFrame, rows, n):
    """n - 1 keys that part the bytes of a hash sample (about SAMPLE a range, MOST_SAMPLED in all) evenly."""
    share = min(1.0, min(SAMPLE * n, MOST_SAMPLED) / max(1, rows))
    some = frame.where(F.pmod(F.xxhash64("other"), F.lit(1 << 40)) < int(share * (1 << 40)))
    # 24 bytes a sampled row
    found = some.mapInArrow(_measured, "keys binary, sizes binary").collect() if n > 1 else []
    keys = np.frombuffer(b"".join(r["keys"] for r in found), "S16")
    if not len(keys):
        return np.zeros(0, "S16")
    size = np.frombuffer(b"".join(r["sizes"] for r in found), np.int64)
    order = np.argsort(keys, kind="stable")
    upto = np.cumsum(size[order])
    return keys[order][np.minimum(np.searchsorted(upto, upto[-1] * np.arange(1, n) / n), len(keys) - 1)]


def _taken(starts, flat, at):
    """The parts of a flat array that begin at starts, picked by number: (flat, length of each)."""
    lengths = starts[at + 1] - starts[at]
    step = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return flat[np.repeat(starts[at], lengths) + step], lengths


def _simple(tokenizer):
    """Of a byte-level BPE that cuts texts as SPLIT does: (the same without normalizer and SPLIT, for runs already cut and in lower case; by id, whether
    a token ends a run); else None."""
    from tokenizers import Tokenizer

    told = json.loads(tokenizer.to_str())
    steps = (told["normalizer"] or {}).get("normalizers", []), (told["pre_tokenizer"] or {}).get("pretokenizers", [])
    model, byte_level = told["model"], {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
    known = ([{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
             [{"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True}, byte_level])
    suffix = model.get("end_of_word_suffix")
    if steps != known or not suffix or model["type"] != "BPE" or any("<|" not in t["content"] for t in told["added_tokens"]):
        return None
    if sum(len(t) == 1 for t in model["vocab"]) < 256 or sum(len(t) == 1 + len(suffix) and t.endswith(suffix) for t in model["vocab"]) < 256:
        return None
    told |= {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, byte_level]}}
    last = np.zeros(max(model["vocab"].values()) + 1, bool)
    last[[k for token, k in model["vocab"].items() if token.endswith(suffix)]] = True
    return Tokenizer.from_str(json.dumps(told)), last


def _kinds():
    kinds = np.full(256, ODD, np.uint8)
    kinds[0x21:0x7F] = MARK
    kinds[ord("'")] = ODD
    for (first, last), kind in ("09", DIGIT), ("az", LETTER), ("AZ", LETTER):
        kinds[ord(first):ord(last) + 1] = kind
    kinds[list(b" \t\n\x0b\x0c\r")] = SPACE
    return kinds


class WordIds:
    """Ids of the words of texts, with two tables of runs already seen: a full one becomes the old one, whose runs move over when they are met again.

    Where the tokenizer is known to cut words so, a run is some letters in lower
    case, a digit, or some marks; a word with an apostrophe, a control string or a
    character beyond ASCII and the letters of Latin-1 is one run as it is, and so is
    any word for another tokenizer.
    """

    def __init__(self, path, remembered=REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if not os.path.isabs(path):
            import public_tokenizers

            path = public_tokenizers.path(path)
        self.tokenizer, self.remembered = Tokenizer.from_file(path), remembered
        self.simple = _simple(self.tokenizer)
        self.kinds = _kinds()
        if self.simple is None:
            self.kinds[self.kinds != SPACE] = ODD
        self.place, self.starts, self.flat = {}, np.zeros(1, np.int64), np.zeros(0, np.uint32)
        self._clear()

    def _clear(self):
        self.old = self.place, self.starts, self.flat
        self.place, self.starts, self.flat = {}, np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _remember(self, words, flat, lengths):
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words))))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        self.flat = np.concatenate([self.flat, flat])

    def _encoded(self, words):
        """Ids of different words, tokenised as one text, and how many each has: a token belongs to the word it starts in."""
        words = [w.decode() for w in words]
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        starts = np.cumsum([0, *(len(w) + 1 for w in words[:-1])])
        place = np.fromiter((o[0] for o in found.offsets), np.int64, len(found.ids))
        return np.array(found.ids, np.uint32), np.bincount(np.searchsorted(starts, place, "right") - 1, minlength=len(words))

    def _encoded_runs(self, runs):
        """Ids of different runs other than odd words, and how many each has: its last token says so."""
        tokenizer, last = self.simple
        ids = np.array(tokenizer.encode_batch_fast([b" ".join(runs).decode()], add_special_tokens=False)[0].ids, np.uint32)
        return ids, np.diff(np.flatnonzero(last[ids]), prepend=-1)

    def cut(self, data):
        """Runs of some bytes of text: (where each starts, its number among the different ones, the different ones, which of those are odd words)."""
        raw = np.frombuffer(data, np.uint8)
        kind = self.kinds[raw]
        if self.simple is not None:
            pair = np.flatnonzero(raw[:-1] == 0xC3)
            pair = pair[(raw[pair + 1] & 0xC0 == 0x80) & (raw[pair + 1] & 0xDF != 0x97)]  # all but the signs of times and division
            kind[pair] = kind[pair + 1] = LETTER
            kind[np.flatnonzero((raw[:-1] == ord("<")) & (raw[1:] == ord("|")))] = ODD
        solid = kind != SPACE
        before = np.concatenate([[SPACE], kind[:-1]]).astype(np.uint8)
        odd = np.flatnonzero(kind == ODD)
        if len(odd):
            edges = np.flatnonzero(solid != np.concatenate([[False], solid[:-1]]))
            begin, end = edges[::2], np.append(edges, len(raw))[1:len(edges) + 1:2]
            whole = np.unique(np.searchsorted(begin, odd, "right") - 1)
            size = end[whole] - begin[whole]
            kind[np.repeat(begin[whole] - np.cumsum(size) + size, size) + np.arange(size.sum())] = ODD
            before[1:] = kind[:-1]
        starts = solid & ((kind != before) | (kind == DIGIT))
        low = np.where((kind == LETTER) & (raw < 0x80), raw | 0x20, raw)
        if self.simple is not None:
            pair = pair[(kind[pair] == LETTER) & (raw[pair + 1] < 0x9F)] + 1
            low[pair] = raw[pair] | 0x20
        begin = np.flatnonzero(starts)
        upto = np.append(np.flatnonzero(starts[solid]), np.count_nonzero(solid)).astype(np.int32)
        runs = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(upto), pa.py_buffer(low[solid])]).dictionary_encode()
        number = runs.indices.to_numpy(zero_copy_only=False)
        is_odd = np.zeros(len(runs.dictionary), bool)
        is_odd[number] = kind[begin] == ODD
        return begin, number, runs.dictionary.to_pylist(), is_odd

    def _learn(self, runs, is_odd):
        """Runs that the table lacks, from the old table or the tokenizer."""
        place, starts, flat = self.old
        before = np.fromiter(map(place.get, runs, itertools.repeat(-1)), np.int64, len(runs))
        self._remember([runs[k] for k in np.flatnonzero(before >= 0)], *_taken(starts, flat, before[before >= 0]))
        for encoded, mine in (self._encoded, is_odd), (self._encoded_runs, ~is_odd):
            new = [runs[k] for k in np.flatnonzero((before < 0) & mine)]
            if new:
                flat, lengths = zip(*(encoded(new[k:k + TOGETHER]) for k in range(0, len(new), TOGETHER)))
                self._remember(new, np.concatenate(flat), np.concatenate(lengths))

    def documents(self, texts):
        """(flat ids, ids per text) of some texts (bytes)."""
        if len(self.place) > self.remembered:
            self._clear()
        begin, number, runs, is_odd = self.cut(b"\n".join(texts))
        at = np.fromiter(map(self.place.get, runs, itertools.repeat(-1)), np.int64, len(runs))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            unknown = [runs[k] for k in missing]
            self._learn(unknown, is_odd[missing])
            at[missing] = np.fromiter(map(self.place.__getitem__, unknown), np.int64, len(unknown))
        flat, lengths = _taken(self.starts, self.flat, at[number])
        upto = np.searchsorted(begin, np.cumsum([len(t) + 1 for t in texts]))
        return flat, np.diff(np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], upto])])

    def long_text(self, text, piece=PIECE):
        """Ids of one text, cut at white space into pieces of about that many bytes."""
        parts, at = [], 0
        while at < len(text):
            end = min(len(text), at + piece)
            while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
                end += 1
            parts.append(self.documents([text[at:end]])[0])
            at = end
        return np.concatenate(parts)

    def batches(self, texts):
        """(first, last, flat ids, ids per text) for runs of texts of about PIECE bytes; only a run's texts are held."""
        first, size, run = 0, 0, []
        for k, text in enumerate(texts):
            if len(text) > 2 * PIECE:
                if run:
                    yield (first, k, *self.documents(run))
                flat = self.long_text(text)
                yield k, k + 1, flat, np.array([len(flat)])
                first, size, run = k + 1, 0, []
                continue
            size += len(text)
            run.append(text)
            if size >= PIECE:
                yield (first, k + 1, *self.documents(run))
                first, size, run = k + 1, 0, []
        if run:
            yield (first, first + len(run), *self.documents(run))


def powers(n):
    """n as a sum of falling powers of two."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
PIECES_DDL = ", ".join(f"{f.name} long" for f in PIECES)


class Stream:
    """The tokens of one task as a stream, cut into sequences; the open last sequence is held back."""

    def __init__(self, first_sequence, length=LENGTH):
        self.sequence, self.length = first_sequence, length
        self.flat = np.zeros(0, np.uint32)
        self.doc = self.null = self.start = self.total = self.begin = np.zeros(0, np.int64)

    def add(self, doc, null, flat, tokens):
        """Documents with their ids (end token included); returns the pieces of all sequences that are full now."""
        size = len(self.flat)
        self.begin = np.concatenate([self.begin, size + np.cumsum(tokens) - tokens])
        self.doc, self.null = np.concatenate([self.doc, doc]), np.concatenate([self.null, null])
        self.start, self.total = np.concatenate([self.start, np.zeros(len(doc), np.int64)]), np.concatenate([self.total, tokens])
        self.flat = np.concatenate([self.flat, flat])
        n = len(self.flat) // self.length
        out = self._cut(np.arange(n + 1) * self.length)
        # the open sequence: its documents, the first of them cut
        done = n * self.length
        k = max(0, int(np.searchsorted(self.begin, done, "right")) - 1) if done < len(self.flat) else len(self.begin)
        self.start = self.start[k:] + np.maximum(0, done - self.begin[k:])
        self.begin = np.maximum(self.begin[k:], done) - done
        self.doc, self.null, self.total, self.flat = self.doc[k:], self.null[k:], self.total[k:], self.flat[done:].copy()
        return out

    def rest(self):
        """Pieces of what is left, in sequences of powers of two."""
        return self._cut(np.concatenate([[0], np.cumsum(powers(len(self.flat)))]).astype(np.int64))

    def _cut(self, cuts):
        end = int(cuts[-1])
        if not end:
            return None
        at = np.union1d(self.begin[self.begin < end], cuts)
        begin, length = at[:-1], np.diff(at)
        doc = np.searchsorted(self.begin, begin, "right") - 1
        seq = np.searchsorted(cuts, begin, "right") - 1
        ids = memoryview(np.ascontiguousarray(self.flat, "<u4")).cast("B")
        crc = [zlib.crc32(ids[4 * a:4 * (a + n)]) for a, n in zip(begin.tolist(), length.tolist())]
        out = [pa.array(self.doc[doc], mask=self.null[doc].astype(bool)), self.start[doc] + begin - self.begin[doc], length, crc, self.total[doc],
               self.sequence + seq, begin - cuts[seq]]
        self.sequence += len(cuts) - 1
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in out], schema=PIECES)


def _pack(path, length):
    def run(batches):
        words, stream = None, Stream(TaskContext.get().partitionId() << 40, length)
        for batch in batches:
            words = words or per_process(f"words of {path}", lambda: WordIds(path))
            null = np.asarray(batch.column(0).is_null()).astype(np.int64)
            doc = np.asarray(batch.column(0).fill_null(0)).astype(np.int64)
            texts = (t.as_py() for t in batch.column(1).cast(pa.binary()))
            for first, last, flat, tokens in words.batches(texts):
                whole = np.insert(flat, np.cumsum(tokens), END).astype(np.uint32)
                out = stream.add(doc[first:last], null[first:last], whole, tokens + 1)
                if out is not None:
                    yield out
        out = stream.rest()
        if out is not None:
            yield out

    return run


def packed(spark: SparkSession, docs: DataFrame, key="doc_id", text="text", tokenizer=TOKENIZER, length=LENGTH, partitions=None) -> DataFrame:
    """Pieces of documents in sequences; a sequence_id is unique, its high bits are the task."""
    frame = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows, size = frame.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n = partitions or parts_for(spark, size)
    frame = frame.withColumn("other", F.xxhash64("doc_id", "text"))
    keyed = frame.mapInArrow(_with_key(borders_of(frame, rows, n)), "doc_id long, text string, other long, curve long, part int")
    along = keyed.repartitionById(n, F.col("part")).sortWithinPartitions("curve", "other", "doc_id")
    return along.select("doc_id", "text").mapInArrow(_pack(tokenizer, length), PIECES_DDL)


def query(spark, sf_dir):
    return packed(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
