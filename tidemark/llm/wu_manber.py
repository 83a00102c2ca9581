"""Benchmark passages in documents by Wu-Manber search over words.

Words are runs of letters, digits and bytes outside ASCII, A-Z lower-cased. A benchmark item is
cut into windows of 10 consecutive words; an item of fewer words is one window. All windows of
one length are searched together: a table tells for a pair of words how far the search may move
on (pairs in no window allow the largest step), and where it may not move, the pair that ends
a window selects the few windows to compare word by word.

Windows are written to the shared folder in chunks of at most `CHUNK` windows; a task searches
one chunk after the other over each batch, so memory does not grow with the benchmark, and
nothing but file names passes through the driver.

Null texts and texts without words have no words and no hits. Null and repeated items: an item
without text or words has no windows, items with equal windows are all counted, an item id
that occurs twice counts once, and items without id count as one with an empty id. An empty benchmark hits nothing. Other columns are ignored.
"""

import pickle
import re
import uuid
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import functions as F

from tidemark.session import work_folder

WINDOW = 10
CHUNK = 200_000
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+").findall


def words_of(text):
    """Words of a text as bytes."""
    return _WORDS(text.encode("utf-8", "surrogatepass").lower()) if text else []


def windows_of(words, size=WINDOW):
    """All runs of `size` words; fewer words are one run, none are none."""
    if not words:
        return []
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


class Searcher:
    """Shift and bucket tables of windows of one length."""

    def __init__(self, length, windows):
        self.length = length
        self.block = min(2, length)
        self.longest = length - self.block + 1
        self.shift, self.buckets = {}, {}
        for words, items in windows.items():
            for end in range(self.block, length + 1):
                block = words[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.longest), length - end)
            self.buckets.setdefault(words[length - self.block :], {})[words] = items

    def search(self, words):
        """Yield (first word, items) of every occurrence, overlapping ones too."""
        length, block, longest = self.length, self.block, self.longest
        shift, buckets = self.shift.get, self.buckets
        offset = length - block
        at, last = offset, len(words) - block
        while at <= last:
            pair = tuple(words[at : at + block])
            step = shift(pair, longest)
            if step:
                at += step
                continue
            first = at - offset
            items = buckets[pair].get(tuple(words[first : first + length]))
            if items is not None:
                yield first, items
            at += 1


def searchers(windows):
    """Searchers of all lengths from windows with their items."""
    by_length = {}
    for words, items in windows.items():
        by_length.setdefault(len(words), {})[words] = items
    return [Searcher(length, group) for length, group in sorted(by_length.items())]


def find(text, chunks):
    """(number of words, spans of hit words, ids of items) of one text; chunks are lists of searchers."""
    words = words_of(text)
    spans, items = [], set()
    for tables in chunks:
        for table in tables:
            for first, found in table.search(words):
                spans.append((first, first + table.length))
                items.update(found)
    return len(words), union(spans), sorted(items)


def union(spans):
    """Sorted spans without overlaps."""
    merged = []
    for first, end in sorted(spans):
        if merged and first <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((first, end))
    return merged


def write_windows(benchmark, id_col="item_id", text_col="text", size=WINDOW, chunk=CHUNK):
    """Distinct windows with their item ids, in files of the shared folder; returns their paths.

    Windows are dealt by their hash, so a passage that many items share is kept once.
    """
    spark = benchmark.sparkSession
    folder = work_folder(spark, "windows")
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))

    @F.arrow_udf("array<binary>")
    def windows(texts: pa.Array) -> pa.Array:
        return pa.array([[b" ".join(w) for w in windows_of(words_of(t.as_py()), size)] for t in texts], pa.list_(pa.binary()))

    table = items.select("item", F.explode(F.array_distinct(windows("text"))).alias("window")).distinct()
    plain = work_folder(spark, "window-rows")
    table.write.parquet(plain)
    table = spark.read.parquet(plain)
    files = -(-table.count() // chunk)
    if not files:
        return []

    def write(parts):
        rows = [row for part in parts for row in part.to_pylist()]
        rows.sort(key=lambda row: (row["file"], row["window"], row["item"]))
        for name, group in groupby(rows, key=lambda row: row["file"]):
            found = {}
            for row in group:
                found.setdefault(tuple(row["window"].split(b" ")), []).append(row["item"])
            target, path = fs.FileSystem.from_uri(f"{folder}/{name}.windows")
            target.create_dir(path.rsplit("/", 1)[0])
            attempt = f"{path}.{uuid.uuid4().hex}"
            with target.open_output_stream(attempt) as out:
                out.write(pickle.dumps(found))
            target.move(attempt, path)
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}.windows"]})

    dealt = table.withColumn("file", F.pmod(F.xxhash64("window"), F.lit(files))).repartition(files, "file")
    return sorted(row.path for row in dealt.select("file", "window", "item").mapInArrow(write, "path string").collect())


@lru_cache(maxsize=1)
def _chunk(path):
    source, name = fs.FileSystem.from_uri(path)
    with source.open_input_stream(name) as file:
        return searchers(pickle.loads(file.read()))


RESULT = "struct<n_words:bigint,spans:array<struct<first:int,end:int>>,items:array<string>>"


def finder(benchmark, id_col="item_id", text_col="text", size=WINDOW, chunk=CHUNK):
    """Function of a text column that gives its words, merged hit spans (in words) and item ids."""
    paths = write_windows(benchmark, id_col, text_col, size, chunk)

    @F.arrow_udf(RESULT)
    def found(texts: pa.Array) -> pa.Array:
        texts = texts.to_pylist()
        results = [find(text, []) if not paths else None for text in texts]
        for path in paths:
            tables = _chunk(path)
            for i, text in enumerate(texts):
                one = find(text, [tables])
                results[i] = one if results[i] is None else _join(results[i], one)
        spans = [[{"first": first, "end": end} for first, end in r[1]] for r in results]
        columns = {
            "n_words": pa.array([r[0] for r in results], pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
            "items": pa.array([r[2] for r in results], pa.list_(pa.string())),
        }
        return pa.StructArray.from_arrays(columns.values(), columns)

    return found


def _join(left, right):
    """Results of two chunks for one text."""
    return left[0], union(left[1] + right[1]), sorted(set(left[2]) | set(right[2]))
