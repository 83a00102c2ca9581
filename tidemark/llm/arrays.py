"""Arrays in files of the shared folder, written by tasks and mapped into memory by other tasks."""

import uuid
from collections import OrderedDict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import functions as F

from tidemark.session import work_folder


def _place(path):
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def save(folder, name, arrays):
    """Path of a new file with the arrays one after the other, each padded to 8 bytes."""
    target, place = _place(folder)
    target.create_dir(place)
    file = f"{name}-{uuid.uuid4().hex}"
    with target.open_output_stream(f"{place}/{file}") as out:
        for array in arrays:
            data = array.tobytes()
            out.write(data + bytes(-len(data) % 8))
    return f"{folder}/{file}"


@lru_cache(maxsize=4096)
def _mapped(place):
    return np.memmap(place, np.uint8, "r")


# Files that cannot be mapped, the last used at the end: at most `READ_BYTES`, or one file that is larger.
_READ, READ_BYTES = OrderedDict(), 256 << 20


def _read(source, place):
    if place not in _READ:
        with source.open_input_stream(place) as file:
            _READ[place] = np.frombuffer(file.read(), np.uint8)
        while len(_READ) > 1 and sum(map(len, _READ.values())) > READ_BYTES:
            _READ.popitem(last=False)
    _READ.move_to_end(place)
    return _READ[place]


def load(path, types, rows):
    """Arrays of a file: mapped where it is local or mounted, read otherwise."""
    source, place = _place(path)
    data = _mapped(place) if isinstance(source, fs.LocalFileSystem) else _read(source, place)
    columns, at = [], 0
    for kind in types:
        size = rows * np.dtype(kind).itemsize
        columns.append(data[at : at + size].view(kind))
        at += size + -size % 8
    return columns


def leading_bits(hashes, buckets):
    """Bucket of each hash; `buckets` is a power of two."""
    bits = buckets.bit_length() - 1
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


class HashSet:
    """Distinct 64-bit hashes in sorted files, one per bucket; only their names travel."""

    def __init__(self, df, column, rows_per_file=1_000_000):
        spark = df.sparkSession
        self.buckets = 1
        while self.buckets * rows_per_file < df.count():
            self.buckets *= 2
        folder, buckets = work_folder(spark, "hashes"), self.buckets

        def write(batches):
            found = [batch.column(0).to_numpy(zero_copy_only=False) for batch in batches]
            hashes = np.unique(np.concatenate(found).view(np.uint64)) if found else np.zeros(0, np.uint64)
            for b in np.unique(leading_bits(hashes, buckets)):
                part = hashes[leading_bits(hashes, buckets) == b]
                yield pa.RecordBatch.from_pydict({"bucket": [int(b)], "path": [save(folder, "set", [part])], "rows": [len(part)]})

        bits = self.buckets.bit_length() - 1
        bucket = F.shiftrightunsigned(F.col(column), 64 - bits) if bits else F.lit(0)
        dealt = df.select(F.col(column)).repartition(self.buckets, bucket)
        self.files = {}
        for row in dealt.mapInArrow(write, "bucket long, path string, rows long").collect():
            self.files.setdefault(row.bucket, []).append((row.path, row.rows))

    def contains(self, hashes):
        """Whether each hash is in the set."""
        out = np.zeros(len(hashes), bool)
        bucket = leading_bits(hashes, self.buckets)
        for b in np.unique(bucket):
            at = np.flatnonzero(bucket == b)
            for path, rows in self.files.get(int(b), []):
                (known,) = load(path, ("u8",), rows)
                place = np.minimum(np.searchsorted(known, hashes[at]), rows - 1)
                out[at] |= known[place] == hashes[at]
        return out
