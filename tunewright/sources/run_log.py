"""`run_log`: a data source for step logs of runs, to read, to write and to follow.

A log is a folder of text files whose lines are a run's id, a tab, and a `[START]`,
`[STEP]` or `[END]` line.  Reading gives one row per step; other lines and damaged
ones are skipped.  A partition is a range of bytes of one file, and a line belongs to
the range it starts in.  A stream's offset is the number of whole lines' bytes seen of
every file, so files may appear and grow.  Writing takes (episode_id, line_no, line) rows that
come grouped by run and in order; a task writes one file, which appears when all have
succeeded.

    spark.dataSource.register(RunLogSource)
    spark.read.format("run_log").load(path)
"""

import io
import json
import re
import sys
import uuid
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STEP = re.compile(r"\[STEP\] step=(\d+) action=(\S+) reward=(-?[\d.]+) done=(true|false) error=(.*)")
SCHEMA = "episode_id bigint, step_no bigint, action_type string, reward double, done boolean"
RANGE_BYTES = 64 << 20


def _place(uri):
    """(file system, path) of a folder in any store that Arrow knows."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _files(uri):
    """(path, size) of the folder's files; names that begin with . or _ are not data."""
    from pyarrow import fs

    store, path = _place(uri)
    found = store.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
    return sorted((f.path, f.size) for f in found if f.is_file and f.base_name[:1] not in "._")


@dataclass
class ByteRange(InputPartition):
    path: str
    start: int
    end: int


def _ranges(path, start, end, size=RANGE_BYTES):
    return [ByteRange(path, at, min(end, at + size)) for at in range(start, end, size)]


def _lines(uri, part):
    """The lines that start in a range of bytes."""
    store, _ = _place(uri)
    with io.BufferedReader(store.open_input_file(part.path), 1 << 20) as file:
        at = part.start
        if at:  # a line that began before belongs to the range before
            file.seek(at - 1)
            at += len(file.readline()) - 1
        else:
            file.seek(0)
        while at < part.end:
            line = file.readline()
            if not line:
                return
            at += len(line)
            yield line.decode("utf-8", "replace").rstrip("\n")


def _rows(uri, part):
    for line in _lines(uri, part):
        run, _, text = line.partition("\t")
        found = STEP.fullmatch(text)
        if found and run.lstrip("-").isdigit():
            step, action, reward, done, _ = found.groups()
            yield int(run), int(step), action, float(reward), done == "true"


class RunLogReader(DataSourceReader):
    def __init__(self, uri):
        self.uri = uri

    def partitions(self):
        return [r for path, size in _files(self.uri) for r in _ranges(path, 0, size)] or [ByteRange("", 0, 0)]

    def read(self, partition):
        return _rows(self.uri, partition) if partition.end else iter(())


class RunLogStreamReader(DataSourceStreamReader):
    def __init__(self, uri):
        self.uri = uri

    def initialOffset(self):
        return {"files": "{}"}

    def latestOffset(self):
        return {"files": json.dumps({path: self._whole(path, size) for path, size in _files(self.uri)}, sort_keys=True)}

    def _whole(self, path, size, step=1 << 16):
        """Bytes of a file up to its last line end; a line being written is left for later."""
        store, _ = _place(self.uri)
        with store.open_input_file(path) as file:
            end = size
            while end > 0:
                start = max(0, end - step)
                file.seek(start)
                at = file.read(end - start).rfind(b"\n")
                if at >= 0:
                    return start + at + 1
                end = start
        return 0

    def partitions(self, start, end):
        seen = json.loads(start["files"])
        return [r for path, upto in json.loads(end["files"]).items() for r in _ranges(path, seen.get(path, 0), upto)]

    def read(self, partition):
        return _rows(self.uri, partition)

    def commit(self, end):
        pass


@dataclass
class Written(WriterCommitMessage):
    path: str


class RunLogWriter(DataSourceWriter):
    def __init__(self, uri, overwrite):
        self.uri, self.overwrite = uri, overwrite
        if overwrite and _files(uri):
            raise ValueError("a run log is only appended to")

    def write(self, iterator):
        store, path = _place(self.uri)
        store.create_dir(path, recursive=True)
        name = f"{path}/.open-{uuid.uuid4().hex}"
        with store.open_output_stream(name) as out:
            for row in iterator:
                out.write(f"{row['episode_id']}\t{row['line']}\n".encode())
        return Written(name)

    def commit(self, messages):
        store, _ = _place(self.uri)
        for m in messages:
            if m is not None:
                store.move(m.path, m.path.replace("/.open-", "/part-"))

    def abort(self, messages):
        store, _ = _place(self.uri)
        for m in messages:
            if m is not None:
                store.delete_file(m.path)


class RunLogSource(DataSource):
    @classmethod
    def name(cls):
        return "run_log"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return RunLogReader(self.options["path"])

    def streamReader(self, schema):
        return RunLogStreamReader(self.options["path"])

    def writer(self, schema, overwrite):
        return RunLogWriter(self.options["path"], overwrite)
