"""WARC archives with a two-level capture index.

Writing: every page becomes one record, a gzip member of its own, in the archive
file of its task.  Of the records with equal payloads of some length one holds the
payload and the others are revisits that name it.  Payloads are told apart by
their SHA-1 and length.

Index: captures sorted by reversed-host URL key (``org,example,blog)/a?b``) lie in
compressed blocks of some hundred lines; an index file ends with its sparse block
directory, the first key and the place of every block.  The list of index files
with their first keys, one row per file, is the upper level.

Reading: the keys to look up are range-sorted, so a task meets neighbouring keys;
it finds the file and the block by binary search, reads that block alone, finds
the lines, and fetches each record by one range read.  Payload digests are
computed again and held against the record's own.

Files carry the number of the task attempt, and only those that a finished
attempt has named are ever read, so a repeated task leaves no half-written one
behind that counts.

Defined cases: a null payload is empty; a null or malformed address is indexed
under ``)`` and its text; rows that share a page id are records of their own (with
equal payloads and the largest id, all of them hold it); an empty table gives no
archives and no rows; other columns, of whatever name, are not read.
"""

import base64
import bisect
import hashlib
import json
import sys
import zlib

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from tunewright.llm.common import SharedWriter, materialised, shared_dir, shared_file

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST_REVISIT = 1000  # bytes from which an equal payload is not stored again
BLOCK_LINES = 300
LEVEL = 4
DATE = "2000-01-01T00:00:00Z"  # pages carry no capture time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url):
    """Column: host labels reversed, without user, port and `www`, then path and query; no fragment."""
    url = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^#]*)", 1)
    host = F.regexp_replace(F.lower(host), r"^www\.", "")
    return F.when(host == "", F.concat(F.lit(")"), url)).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(rest == "", "/").otherwise(rest)))


def with_roles(pages: DataFrame) -> DataFrame:
    """(url_key, page_id, url, html, record_type, refers_to): which record holds a payload that several share."""
    pages = pages.select(F.col("page_id").cast("long"), "url", F.coalesce(F.col("html"), F.lit("")).alias("html"))
    pages = pages.withColumns({"_sha1": F.sha1("html"), "_bytes": F.octet_length("html")})
    shared = (pages.where(F.col("_bytes") >= LEAST_REVISIT).groupBy("_sha1", "_bytes")
              .agg(F.max("page_id").alias("_holder"), F.count("*").alias("_n")).where("_n > 1").drop("_n"))
    both = pages.join(shared, ["_sha1", "_bytes"], "left")
    revisit = F.col("_holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_holder"))
    return both.select(url_key(F.col("url")).alias("url_key"), "page_id", "url", "html",
                       F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("_holder")).alias("refers_to"))


def _record_id(page_id):
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id, url, payload, record_type, refers_to, level=LEVEL):
    """One WARC record as a gzip member."""
    sha1 = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if record_type == "response" else http
    address = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {address}", f"WARC-Payload-Digest: sha1:{sha1}", "Content-Type: application/http;msgtype=response",
            f"Content-Length: {len(block)}"]
    if record_type == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + squeeze.flush()


def parsed(member):
    """page_id, payload_bytes, payload_digest, record_type, refers_to of a record; a payload is held against its digest."""
    data = zlib.decompress(member, 31)
    head, block = data.split(b"\r\n\r\n", 1)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[:int(fields["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    length = int(http.rsplit(b"Content-Length: ", 1)[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if fields["WARC-Type"] == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload doesn't match its digest")
    number = lambda name: int(x) if (x := fields.get(name, "")[10:-1]) else None
    return number("WARC-Record-ID"), length, digest, fields["WARC-Type"], number("WARC-Refers-To")


def _attempt():
    task = TaskContext.get()
    return f"{task.partitionId():06d}-{task.taskAttemptId()}"


CAPTURE = pa.schema([("url_key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
CAPTURE_DDL = "url_key string, page_id long, file string, offset long, length long"


def _write(folder):
    def run(batches):
        out, name = None, None
        for batch in batches:
            rows = []
            for key, page_id, url, html, kind, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name = f"pages-{_attempt()}.warc.gz"
                    out = SharedWriter(f"{folder}/{name}")
                data = record(page_id, url, html.encode(), kind, refers)
                rows.append((key, page_id, name, out.at, len(data)))
                out.write(data)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), CAPTURE)], schema=CAPTURE)
        if out:
            out.close()

    return run


def write_archives(spark: SparkSession, pages: DataFrame, folder) -> DataFrame:
    """Writes the archives and returns the captures (url_key, page_id, file, offset, length), themselves written down."""
    return materialised(spark, with_roles(pages).mapInArrow(_write(folder), CAPTURE_DDL), "captures")


INDEX_DDL = "first_key string, first_id long, file string, directory_at long, length long"
INDEX = pa.schema([("first_key", pa.string()), ("first_id", pa.int64()), ("file", pa.string()), ("directory_at", pa.int64()), ("length", pa.int64())])


def _place(key, page_id):
    """Order of captures in the index; a null id comes first."""
    return key, page_id is not None, page_id or 0


def _write_index(folder):
    def run(batches):
        out, directory, block, first = None, [], [], None

        def flush():
            data = zlib.compress("\n".join(json.dumps(line) for line in block).encode(), LEVEL)
            directory.append((block[0][0], block[0][1], out.at, len(data)))
            out.write(data)
            block.clear()

        for batch in batches:
            for line in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name = f"index-{_attempt()}.cdxz"
                    out, first = SharedWriter(f"{folder}/{name}"), line
                block.append(line)
                if len(block) == BLOCK_LINES:
                    flush()
        if out:
            if block:
                flush()
            data, at = zlib.compress(json.dumps(directory).encode(), LEVEL), out.at
            out.write(data)
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((first[0], first[1], name, at, len(data)), INDEX)], schema=INDEX)

    return run


def write_index(spark: SparkSession, captures: DataFrame, folder, partitions=None) -> list:
    """Writes the index files; returns the upper level, (first key, first id, file, directory's place and length) per file."""
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = captures.repartitionByRange(n, "url_key", "page_id").sortWithinPartitions("url_key", "page_id")
    files = materialised(spark, ordered.mapInArrow(_write_index(folder), INDEX_DDL), "index-files")
    return sorted((tuple(r) for r in files.collect()), key=lambda r: _place(r[0], r[1]))


class CaptureIndex:
    """Looks captures up: binary search over files, then over the directory of one, then within one block."""

    def __init__(self, folder, files):
        self.folder, self.files = folder, files
        self.keys = [_place(f[0], f[1]) for f in files]
        self.open_files, self.directories, self.block = {}, {}, (None, None)

    def bytes(self, name, at, length):
        if name not in self.open_files:
            if len(self.open_files) > 200:
                self.open_files.popitem()[1].close()
            fs, path = shared_file(f"{self.folder}/{name}")
            self.open_files[name] = fs.open_input_file(path)
        return self.open_files[name].read_at(length, at)

    def _directory(self, k):
        if k not in self.directories:
            if len(self.directories) > 4:
                self.directories.clear()
            _, _, name, at, length = self.files[k]
            rows = json.loads(zlib.decompress(self.bytes(name, at, length)))
            self.directories[k] = rows, [_place(r[0], r[1]) for r in rows]
        return self.directories[k]

    def _lines(self, k, b):
        if self.block[0] != (k, b):
            _, _, at, length = self._directory(k)[0][b]
            lines = [json.loads(x) for x in zlib.decompress(self.bytes(self.files[k][2], at, length)).decode().split("\n")]
            self.block = (k, b), (lines, [_place(x[0], x[1]) for x in lines])
        return self.block[1]

    def find(self, key, page_id):
        """Lines of all captures with this key and id; they may go on in later blocks and files."""
        want = _place(key, page_id)
        k = max(0, bisect.bisect_left(self.keys, want) - 1)
        while k < len(self.files) and self.keys[k] <= want:
            firsts = self._directory(k)[1]
            b = max(0, bisect.bisect_left(firsts, want) - 1)
            while b < len(firsts) and firsts[b] <= want:
                lines, places = self._lines(k, b)
                yield from lines[bisect.bisect_left(places, want):bisect.bisect_right(places, want)]
                b += 1
            k += 1


READ_DDL = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def _read(folder, files):
    def run(batches):
        index = CaptureIndex(folder, files)
        for batch in batches:
            rows = []
            for key, page_id in zip(*(c.to_pylist() for c in batch.columns)):
                for line in index.find(key, page_id):
                    rows.append(parsed(index.bytes(*line[2:])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), READ)], schema=READ)

    return run


def read_back(wanted: DataFrame, folder, files, partitions=None) -> DataFrame:
    """Records of the wanted (url_key, page_id), fetched through the index."""
    n = partitions or int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = wanted.select("url_key", "page_id").distinct().repartitionByRange(n, "url_key", "page_id").sortWithinPartitions("url_key", "page_id")
    return ordered.mapInArrow(_read(folder, files), READ_DDL)


def query(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    folder = shared_dir(spark, "warc")
    files = write_index(spark, write_archives(spark, pages, folder), folder)
    return read_back(pages.select(url_key(F.col("url")).alias("url_key"), F.col("page_id").cast("long")), folder, files)


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS h FROM pages)
, d AS (SELECT page_id, octet_length(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest FROM p)
, m AS (SELECT payload_bytes, payload_digest, max(page_id) AS holder FROM d WHERE payload_bytes >= 1000 GROUP BY ALL HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN holder IS NULL OR holder = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN holder <> page_id THEN holder END AS refers_to
FROM d LEFT JOIN m USING (payload_bytes, payload_digest)
"""
