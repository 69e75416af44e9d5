"""Scores of an interpolated modified Kneser-Ney bigram model.

Counting, in Spark: tokens are hashed, every batch sums its own counts and sends
them as compressed cells (blobs) to hash ranges.  A range of the vocabulary is a
sorted array of word hashes with their counts; a word's id is its place there.
Pairs of ids, hashed again, are counted the same way, and each pair range then
sends what it knows of contexts (how often, how many followers once, twice, more)
and of words (how many different predecessors) back to the vocabulary ranges.
No range is a word's own, so neither a frequent word nor a long document makes a
task large.

The model is a set of files in the shared folder: sorted hash arrays with counts
and, along the vocabulary, arrays of context totals, back-off mass and predecessor
counts.  Scoring tasks memory-map them and look a batch's distinct words and pairs
up by binary search in ascending order.  (A store that cannot be mapped is copied
to a nameless temporary file first.)

p(w|v) = max(c(vw) - D(c), 0) / c(v.) + g(v) p(w), with three discounts from counts
of counts; p(w) is the same with numbers of different predecessors, interpolated
with 1 / (V + 1), so an unknown word has a probability.  The order is two: the counts of
longer n-grams would not fit the disk the job is given.

Defined cases: a null or empty text is its end token; a null id counts as an empty
one where the fold is drawn; a corpus without training documents leaves
1 / (V + 1) = 1 for every token; repeated rows count each; an empty table gives no
rows; other columns, of whatever name, are not read.
"""

import sys
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from tunewright.llm.blobs import from_cell, merged, mix, range_of, summed, to_cell
from tunewright.llm.common import SharedWriter, materialised, parts_for, shared_dir, shared_file, text_bytes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOLDS, HELD_OUT = 5, 1
END, BEGIN = b"\n", b"\t"  # no word holds white space
CHUNK = 4 << 20  # bytes of text that are counted or scored together
LEAST_RANGES = 64
CELL_DDL = "bucket int, cell binary"
CELL = pa.schema([("bucket", pa.int32()), ("cell", pa.binary())])


def _hash(token):
    return np.uint64(xxhash.xxh64_intdigest(token))


def chunks(column, size=CHUNK):
    """(first, last) row ranges of about that many bytes of text."""
    first, held = 0, 0
    for k, text in enumerate(column):
        held += len(text.as_buffer() or b"") if text.is_valid else 0
        if held >= size:
            yield first, k + 1
            first, held = k + 1, 0
    if first < len(column):
        yield first, len(column)


def tokens(texts):
    """Hashes of all tokens of some texts (bytes), and tokens per text: words lower-cased, then the end."""
    out, counts = [], []
    for text in texts:
        words = text.lower().split()
        counts.append(len(words) + 1)
        out.append(b"".join(map(xxhash.xxh64_digest, words)))
        out.append(xxhash.xxh64_digest(END))
    return np.frombuffer(b"".join(out), ">u8").astype(np.uint64), np.array(counts)


def _texts(column, first, last):
    return [t.as_py() or b"" for t in column.slice(first, last - first)]


def _cells(ranges, keys, *values):
    """A batch of cells from ascending keys."""
    at = range_of(keys, ranges)
    some = [k for k in range(ranges) if at[k] < at[k + 1]]
    return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(
        [to_cell(keys[at[k]:at[k + 1]], *(v[at[k]:at[k + 1]] for v in values)) for k in some], pa.binary())], schema=CELL)


def _count_words(ranges):
    def run(batches):
        for batch in batches:
            column = batch.column(0).cast(pa.binary())
            held = []
            for first, last in chunks(column):
                found = np.unique(tokens(_texts(column, first, last))[0], return_counts=True)
                held.append((found[0], found[1].astype(np.uint64)))
            if held:
                yield _cells(ranges, *summed(*(np.concatenate(c) for c in zip(*held))))

    return run


def _by_bucket(batches):
    held = {}
    for batch in batches:
        for bucket, cell in zip(*(c.to_pylist() for c in batch.columns)):
            held.setdefault(bucket, []).append(cell)
    return held.items()


FILES_DDL = "bucket int, file string, n long, total long, cc array<long>"
FILES = pa.schema([("bucket", pa.int32()), ("file", pa.string()), ("n", pa.int64()), ("total", pa.int64()), ("cc", pa.list_(pa.int64()))])


def _file(folder, kind, bucket, *arrays):
    name = f"{kind}-{bucket:06d}-{TaskContext.get().taskAttemptId()}.bin"
    out = SharedWriter(f"{folder}/{name}")
    for a in arrays:
        out.write(np.ascontiguousarray(a).tobytes())
    out.close()
    return name


def _counts_of_counts(counts):
    return np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[1:5].tolist()


def _row(schema, *values):
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)


def _write_words(folder):
    def run(batches):
        for bucket, cells in _by_bucket(batches):
            keys, counts = merged(cells)
            yield _row(FILES, bucket, _file(folder, "words", bucket, keys, counts), len(keys), int(counts.sum()), [])

    return run


def mapped(uri, *kinds_and_lengths):
    """Arrays laid end to end in a file, memory-mapped."""
    fs, path = shared_file(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        raw = np.memmap(path, np.uint8, "r")
    else:
        copy = tempfile.TemporaryFile()
        with fs.open_input_stream(path) as stream:
            while part := stream.read(1 << 24):
                copy.write(part)
        copy.flush()
        raw = np.memmap(copy, np.uint8, "r")
    out, at = [], 0
    for kind, n in kinds_and_lengths:
        size = n * np.dtype(kind).itemsize
        out.append(raw[at:at + size].view(kind))
        at += size
    return out


class Vocabulary:
    """Ids and counts of word hashes; shards are the hash ranges, in order."""

    def __init__(self, folder, shards, ranges):
        self.folder, self.ranges, self.open = folder, ranges, {}
        self.shards = {b: (file, n) for b, file, n in shards}
        sizes = np.array([self.shards.get(b, ("", 0))[1] for b in range(ranges)], np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.size = int(self.first[-1])

    def find(self, keys):
        """(id or -1, count) of ascending distinct hashes."""
        ids, counts = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.uint64)
        at = range_of(keys, self.ranges)
        for b, (file, n) in self.shards.items():
            lo, hi = at[b], at[b + 1]
            if lo < hi:
                if b not in self.open:
                    self.open[b] = mapped(f"{self.folder}/{file}", ("<u8", n), ("<u8", n))
                known, c = self.open[b]
                place = np.minimum(np.searchsorted(known, keys[lo:hi]), n - 1)
                hit = known[place] == keys[lo:hi]
                ids[lo:hi] = np.where(hit, place + self.first[b], -1)
                counts[lo:hi] = np.where(hit, c[place], 0)
        return ids, counts

    def owners(self, ids):
        """Borders of the shards in ascending ids."""
        return np.searchsorted(ids, self.first)


def _pairs(hashes, counts, vocabulary):
    """Ids of tokens (-1 unknown) and of what stands before each, the begin mark before a text's first; counts of the tokens."""
    distinct, back = np.unique(hashes, return_inverse=True)
    ids, known = vocabulary.find(distinct)
    token = ids[back]
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[np.cumsum(counts) - counts] = vocabulary.size  # the begin mark has the id after the last word's
    return token, before, known[back]


def pair_key(before, token):
    return mix(before.astype(np.uint64) << np.uint64(32) | token.astype(np.uint64))


def _unmixed(keys):
    """before and token of keys, by the inverse of mix."""
    h = keys.copy()
    for factor in (0x9CB4B2F8129337DB, 0x4F74430C22A54005):
        h ^= h >> np.uint64(33)
        h *= np.uint64(factor)
    h ^= h >> np.uint64(33)
    return h >> np.uint64(32), h & np.uint64(0xFFFFFFFF)


def _count_pairs(folder, shards, ranges):
    def run(batches):
        vocabulary = Vocabulary(folder, shards, ranges)
        for batch in batches:
            column = batch.column(0).cast(pa.binary())
            held = []
            for first, last in chunks(column):
                token, before, _ = _pairs(*tokens(_texts(column, first, last)), vocabulary)
                found = np.unique(pair_key(before, token), return_counts=True)
                held.append((found[0], found[1].astype(np.uint64)))
            if held:
                yield _cells(ranges, *summed(*(np.concatenate(c) for c in zip(*held))))

    return run


PAIRS_DDL = f"{CELL_DDL}, kind string, file string, n long, total long, cc array<long>"
PAIRS = pa.schema([*CELL, ("kind", pa.string()), ("file", pa.string()), ("n", pa.int64()), ("total", pa.int64()), ("cc", pa.list_(pa.int64()))])


def _write_pairs(folder, firsts):
    """Pair files, and cells with what each range knows of contexts and of words, for the vocabulary ranges."""
    def run(batches):
        for bucket, cells in _by_bucket(batches):
            keys, counts = merged(cells)
            file = _file(folder, "pairs", bucket, keys, counts.astype("<u4") if counts.max() < 1 << 32 else counts)
            wide = int(counts.max() >= 1 << 32)
            yield _row(PAIRS, bucket, None, "file", file, len(keys), wide, _counts_of_counts(counts))
            before, token = _unmixed(keys)
            one = np.ones(len(keys), np.uint64)
            context = summed(before, counts, (counts == 1).astype(np.uint64), (counts == 2).astype(np.uint64), (counts > 2).astype(np.uint64))
            for kind, columns in (("context", context), ("word", summed(token, one))):
                at = np.searchsorted(columns[0].astype(np.int64), firsts)
                for b in range(len(firsts) - 1):
                    if at[b] < at[b + 1]:
                        yield _row(PAIRS, b, to_cell(*(c[at[b]:at[b + 1]] for c in columns)), kind, None, None, None, None)

    return run


def _write_stats(folder, firsts):
    """Along the vocabulary: context totals, followers once, twice and more often, different predecessors."""
    def run(batches):
        held = {}
        for batch in batches:
            for bucket, cell, kind in zip(*(batch.column(k).to_pylist() for k in range(3))):
                held.setdefault(bucket, {}).setdefault(kind, []).append(cell)
        for bucket, kinds in held.items():
            n = int(firsts[bucket + 1] - firsts[bucket])
            table = np.zeros((5, n), np.uint64)
            for kind, rows in (("context", slice(0, 4)), ("word", slice(4, 5))):
                if kind in kinds:
                    ids, *values = merged(kinds[kind])
                    table[rows, ids.astype(np.int64) - firsts[bucket]] = values
            yield _row(FILES, bucket, _file(folder, "stats", bucket, table), n, int(table[4].sum()), _counts_of_counts(table[4][table[4] > 0]))

    return run


def discounts(cc):
    """Three discounts from the numbers of n-grams seen once, twice, three and four times; fixed ones where a number is zero."""
    n1, n2, n3, n4 = map(float, cc)
    if not all((n1, n2, n3, n4)):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.0), float(k)) for k, d in enumerate(found, 1))


class Model:
    """The files of a trained model, opened where they are needed."""

    def __init__(self, folder, ranges, words, pairs, stats, totals):
        self.folder, self.ranges, self.words, self.pairs, self.stats, self.totals = folder, ranges, words, pairs, stats, totals

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("vocabulary", "pair_files", "stat_files")}

    def open(self):
        self.vocabulary = Vocabulary(self.folder, self.words, self.ranges)
        self.pair_files = {b: mapped(f"{self.folder}/{file}", ("<u8", n), ("<u8" if wide else "<u4", n)) for b, file, n, wide in self.pairs}
        self.stat_files = {b: mapped(f"{self.folder}/{file}", ("<u8", 5 * n))[0].reshape(5, n) for b, file, n in self.stats}
        return self

    def _pair_counts(self, keys):
        """Counts of ascending keys."""
        out, at = np.zeros(len(keys)), range_of(keys, self.ranges)
        for b, (known, counts) in self.pair_files.items():
            part = keys[at[b]:at[b + 1]]
            if len(part):
                place = np.minimum(np.searchsorted(known, part), len(known) - 1)
                out[at[b]:at[b + 1]] = np.where(known[place] == part, counts[place], 0)
        return out

    def _stats(self, ids):
        """The five numbers of ascending ids (the begin mark's included)."""
        out = np.zeros((5, len(ids)))
        first = self.vocabulary.first.copy()
        first[-1] += 1  # the begin mark stands in the last shard
        at = np.searchsorted(ids, first)
        for b, table in self.stat_files.items():
            lo, hi = at[b], at[b + 1]
            if lo < hi:
                out[:, lo:hi] = table[:, ids[lo:hi] - first[b]]
        return out

    def unigram(self, predecessors):
        """p(w) from numbers of different predecessors (0 for an unknown word)."""
        d, all_, v = self.totals["word_discounts"], self.totals["pairs"], self.totals["vocabulary"]
        if not all_:
            return np.full(len(predecessors), 1.0 / (v + 1))
        cc = self.totals["word_kinds"]
        free = (d[0] * cc[0] + d[1] * cc[1] + d[2] * cc[2]) / all_
        cut = np.choose(np.minimum(predecessors, 3).astype(np.int64), [0.0, *d])
        return np.maximum(predecessors - cut, 0) / all_ + free / (v + 1)

    def probabilities(self, token, before):
        """p(token | before) for arrays of ids, -1 unknown."""
        d = self.totals["pair_discounts"]
        distinct, back = np.unique(np.concatenate([token, before]), return_inverse=True)
        known = np.searchsorted(distinct, 0)
        stats = np.zeros((5, len(distinct)))
        stats[:, known:] = self._stats(distinct[known:])
        of_token, of_before = stats[4][back[:len(token)]], stats[:4, back[len(token):]]
        lower = self.unigram(of_token)
        both = np.flatnonzero((token >= 0) & (before >= 0))
        keys, again = np.unique(pair_key(before[both], token[both]), return_inverse=True)
        count = np.zeros(len(token))
        count[both] = self._pair_counts(keys)[again]
        total = of_before[0]
        seen = total > 0
        total = np.where(seen, total, 1)
        free = np.where(seen, (d[0] * of_before[1] + d[1] * of_before[2] + d[2] * of_before[3]) / total, 1.0)
        cut = np.choose(np.minimum(count, 3).astype(np.int64), [0.0, *d])
        return np.maximum(count - cut, 0) / total + free * lower


def _dealt(frame, ranges):
    return frame.repartition(ranges, "bucket")


def train(spark: SparkSession, texts: DataFrame, folder=None, ranges=None) -> Model:
    """A model of the column `text`; the driver gets one row per file."""
    texts = texts.select(F.coalesce("text", F.lit("")).alias("text"))
    folder = folder or shared_dir(spark, "ngrams")
    ranges = ranges or max(LEAST_RANGES, parts_for(spark, text_bytes(texts, "text")))
    words = _dealt(texts.mapInArrow(_count_words(ranges), CELL_DDL), ranges).mapInArrow(_write_words(folder), FILES_DDL)
    words = materialised(spark, words, "ngram-words").collect()
    shards = sorted((r.bucket, r.file, r.n) for r in words)
    vocabulary = Vocabulary(folder, shards, ranges)
    if vocabulary.size >= 1 << 31:
        raise ValueError("more than 2^31 different words: pairs of ids need more than 64 bits")
    firsts = vocabulary.first.copy()
    firsts[-1] += 1
    cells = _dealt(texts.mapInArrow(_count_pairs(folder, shards, ranges), CELL_DDL), ranges)
    pairs = materialised(spark, cells.mapInArrow(_write_pairs(folder, firsts), PAIRS_DDL), "ngram-pairs")
    files = pairs.where("kind = 'file'").select("bucket", "file", "n", "total", "cc").collect()
    stats = _dealt(pairs.where("kind <> 'file'").select("bucket", "cell", "kind"), ranges).mapInArrow(_write_stats(folder, firsts), FILES_DDL)
    stats = materialised(spark, stats, "ngram-stats").collect()
    add = lambda rows: np.sum([r.cc for r in rows] or [[0] * 4], axis=0).tolist()
    distinct = sum(r.n for r in files)
    word_cc = add(stats)
    kinds = (word_cc[0], word_cc[1], vocabulary.size - word_cc[0] - word_cc[1])
    totals = {"tokens": sum(r.total for r in words), "vocabulary": vocabulary.size, "pairs": distinct, "word_kinds": kinds,
              "pair_discounts": discounts(add(files)), "word_discounts": discounts(word_cc)}
    return Model(folder, ranges, shards, sorted((r.bucket, r.file, r.n, r.total) for r in files), sorted((r.bucket, r.file, r.n) for r in stats), totals)


SCORES_DDL = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                    ("base_score", pa.float64()), ("score", pa.float64())])


def _score(model):
    def run(batches):
        opened = None
        n, v = model.totals["tokens"], model.totals["vocabulary"]
        for batch in batches:
            opened = opened or model.open()
            column = batch.column(2).cast(pa.binary())
            for first, last in chunks(column):
                hashes, counts = tokens(_texts(column, first, last))
                token, before, known = _pairs(hashes, counts, opened.vocabulary)
                base = np.log10((known + 0.5) / (n + 0.5 * (v + 1)))
                at = np.cumsum(counts) - counts
                each = lambda x: np.add.reduceat(x, at)  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first), batch.column(1).slice(first, last - first), pa.array(counts, pa.int64()),
                    pa.array(each((known > 0).astype(np.int64))), pa.array(each(base)),
                    pa.array(each(np.log10(opened.probabilities(token, before))))], schema=SCORES)

    return run


def scored(model: Model, docs: DataFrame, held_out) -> DataFrame:
    """Every document's tokens and log10 probabilities; held_out is a column of docs that is passed on."""
    frame = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    return frame.mapInArrow(_score(model), SCORES_DDL).withColumn("train_tokens", F.lit(int(model.totals["tokens"])).cast("long"))


def fold():
    """Column: whether a document is held out, by the checksum of its id."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(FOLDS)) == HELD_OUT


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scored(train(spark, docs.where(~fold())), docs, fold())
