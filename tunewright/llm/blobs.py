"""Sorted numbers as compressed binary cells, so that a shuffle moves few wide rows instead of many narrow ones.

A cell holds what one batch has for one bucket: ascending 64-bit keys as
differences, and whole numbers beside them; bytes of one significance lie together
and are compressed.  The buckets are hash ranges, so a key that a third of all rows
have is one entry per batch and bucket.
"""

import struct
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ZSTD = "zstd"


def _planes(values):
    data = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8).T.tobytes()
    return pa.Codec(_ZSTD, compression_level=1).compress(data, asbytes=True)


def _values(data, n):
    raw = pa.Codec(_ZSTD).decompress(data, decompressed_size=8 * n, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view("<u8").reshape(n)


def to_cell(keys, *values):
    """Bytes of ascending uint64 keys and of columns of whole numbers of their length."""
    parts = [_planes(np.diff(keys, prepend=np.uint64(0))), *map(_planes, values)]
    return struct.pack(f"<II{len(parts)}I", len(keys), len(parts), *map(len, parts)) + b"".join(parts)


def from_cell(cell):
    """[keys, values...] as uint64 arrays."""
    n, k = struct.unpack_from("<II", cell)
    sizes = struct.unpack_from(f"<{k}I", cell, 8)
    out, at = [], 8 + 4 * k
    for size in sizes:
        out.append(_values(cell[at:at + size], n))
        at += size
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


def mix(keys):
    """A bijection of 64-bit numbers that spreads them evenly."""
    h = keys.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def range_of(keys, ranges):
    """Which of that many equal ranges of the 64-bit numbers a key lies in, for ascending keys: the borders' places (ranges + 1)."""
    borders = np.array([(k << 64) // ranges for k in range(1, ranges)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, borders), [len(keys)]])


def summed(keys, *values):
    """Ascending distinct keys and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], *(np.add.reduceat(v[order], first) if len(keys) else v for v in values)


def merged(cells):
    """Distinct keys of several cells with the sums of their values."""
    columns = [from_cell(c) for c in cells]
    return summed(*(np.concatenate(c) for c in zip(*columns)))
