"""WARC archives compressed with Zstandard: one frame per record, one dictionary per file.

A file starts with a skippable frame that holds the dictionary, itself compressed or not; every
record follows as a frame of its own, so a reader can start at any frame. A file without that
leading frame has no dictionary.

Writing: each page becomes a `response` record (an HTTP response around the payload), or a
`revisit` without payload if an equal payload of at least `MIN_REVISIT` bytes belongs to a
smaller page id. Digests are compared, never payloads. A task writes its rows as they come into
files of about `FILE_BYTES`, under a new name in every attempt. The listing that Spark commits
names the files of the attempts that counted, and readers follow it, so a repeated task leaves
no record twice.

Reading: a task reads one file as a stream, one record in memory at a time. Each record is
checked: version line, mandatory fields, lengths of record and block, closing line ends, digest
of the payload. A record that fails keeps its row, with `problem` telling why; bytes that are
no frame end the file with such a row.

Null payloads are empty. Null URLs leave the field out. Null ids give a record without page
number. Equal rows each get a record; if all of them have the smallest id, all are responses.
An empty table writes one dictionary-less file per partition or none. Other columns are ignored.
"""

import hashlib
import io
import re
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import work_folder

MIN_REVISIT = 100
FILE_BYTES = 64 << 20
# The dictionary is trained on about this many payloads (twice as many at most) of at most this many bytes each.
SAMPLES, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 16 << 10, 64 << 10
# Fixed values of the formats.
SKIPPABLE_MAGIC, FRAME_MAGIC, DICTIONARY_MAGIC = 0x184D2A5D, 0xFD2FB528, 0xEC30A437
VERSION = b"WARC/1.1"
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")
DATE = "2024-01-01T00:00:00Z"
PAGE = "urn:page:"

RECORD = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("problem", T.StringType()),
    ]
)


def record(page_id, url, payload, digest, size, first):
    """Bytes of one record; `first` is the page that a revisit refers to."""
    name = lambda page: f"<{PAGE}{'' if page is None else page}>"
    fields = [
        ("WARC-Type", "revisit" if first is not None else "response"),
        ("WARC-Record-ID", name(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(size)),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if first is not None:
        fields += [("WARC-Refers-To", name(first)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
        block = head + b"\r\n"
    else:
        block = head + b"Content-Length: %d\r\n\r\n" % len(payload) + payload
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{key}: {value}\r\n" for key, value in fields)
    return VERSION + b"\r\n" + lines.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def parse(data):
    """Fields of a record's bytes, with `problem` None if it is valid."""
    out = dict.fromkeys(RECORD.names)
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        return out | {"problem": "no WARC header"}
    fields = {}
    for line in lines[1:]:
        key, colon, value = line.decode("utf-8", "surrogateescape").partition(":")
        if not colon:
            return out | {"problem": "bad header line"}
        fields[key.strip().lower()] = value.strip()
    bare = lambda key: fields[key].strip("<>") if key in fields else None
    out |= {"record_id": bare("warc-record-id"), "record_type": fields.get("warc-type"), "target_uri": fields.get("warc-target-uri"), "refers_to": bare("warc-refers-to")}
    out["payload_digest"] = fields.get("warc-payload-digest", "").rpartition(":")[2] or None
    if missing := [key for key in MANDATORY if key not in fields]:
        return out | {"problem": f"no {missing[0]}"}
    if not fields["content-length"].isdigit():
        return out | {"problem": "bad content-length"}
    length = int(fields["content-length"])
    if len(rest) != length + 4:
        return out | {"problem": "wrong length"}
    if rest[length:] != b"\r\n\r\n":
        return out | {"problem": "no closing line ends"}
    block = rest[:length]
    if out["record_type"] == "revisit":
        size = fields.get("x-payload-length", "")
        return out | {"payload_bytes": int(size) if size.isdigit() else None, "problem": None if out["refers_to"] else "no warc-refers-to"}
    payload = block
    if fields.get("content-type", "").startswith("application/http"):
        http, gap, payload = block.partition(b"\r\n\r\n")
        if not gap:
            return out | {"problem": "no HTTP header"}
        said = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
        if said and int(said[1]) != len(payload):
            return out | {"problem": "wrong HTTP length"}
    digest = hashlib.sha256(payload).hexdigest()
    if out["payload_digest"] not in (None, digest):
        return out | {"problem": "wrong digest"}
    return out | {"payload": payload, "payload_bytes": len(payload), "payload_digest": digest}


def train_dictionary(payloads):
    """Dictionary bytes, empty if the samples are too few."""
    samples = [p for p in payloads if p]
    if len(samples) < 16:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 4), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def dictionary_frame(dictionary):
    """The leading skippable frame."""
    content = zstandard.compress(dictionary)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(content)) + content


def read_records(stream, chunk=1 << 20):
    """Yield (offset, record bytes, problem) of an archive that is read as a stream."""
    held, offset, ended = b"", 0, False

    def fill(size):
        nonlocal held, ended
        parts, have = [held], len(held)
        while have < size and not ended:
            more = stream.read(max(chunk, size - have))
            ended = not more
            parts.append(more)
            have += len(more)
        held = b"".join(parts)
        return len(held) >= size

    options = {}
    if fill(8) and struct.unpack("<I", held[:4])[0] == SKIPPABLE_MAGIC:
        size = 8 + struct.unpack("<I", held[4:8])[0]
        if not fill(size):
            yield 0, None, "cut dictionary"
            return
        content, held, offset = held[8:size], held[size:], size
        try:
            if content[:4] == struct.pack("<I", FRAME_MAGIC):
                content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
            options = {"dict_data": zstandard.ZstdCompressionDict(content)} if content else {}
        except zstandard.ZstdError:
            yield 0, None, "bad dictionary"
            return
    decompressor = zstandard.ZstdDecompressor(**options)
    while fill(1):
        frame, parts, start = decompressor.decompressobj(), [], offset
        try:
            while True:
                taken = len(held)
                parts.append(frame.decompress(held))
                held = frame.unused_data if frame.eof else b""
                offset += taken - len(held)
                if frame.eof:
                    break
                if not fill(1):
                    yield start, None, "cut frame"
                    return
        except zstandard.ZstdError:
            yield start, None, "bad frame"
            return
        if data := b"".join(parts):
            yield start, data, None


def mark_revisits(pages, id_col, payload_col):
    """Pages as (id, url-free) rows with digest, size and the page that a revisit refers to.

    Groups with one page only leave the digest table first; what remains is written, so that its
    size is known: a small one is broadcast, a large one is joined by shuffle, where adaptive
    execution splits a digest that many pages share.
    """
    spark = pages.sparkSession
    data = F.coalesce(F.encode(F.col(payload_col), "utf-8"), F.lit(b""))
    rows = pages.withColumns({"_payload": data, "_digest": F.sha2(data, 256), "_size": F.octet_length(data).cast("long")})
    firsts = (
        pages.select(F.col(id_col).alias("id"), data.alias("payload"))
        .filter(F.octet_length("payload") >= MIN_REVISIT)
        .select("id", F.sha2("payload", 256).alias("_digest"))
        .groupBy("_digest")
        .agg(F.min("id").alias("_first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("_digest", "_first")
    )
    path = work_folder(spark, "equal-payloads")
    firsts.write.parquet(path)
    rows = rows.join(spark.read.parquet(path), "_digest", "left")
    return rows.withColumn("_first", F.when(F.col(id_col) != F.col("_first"), F.col("_first")))


def write_archives(pages, folder, id_col="page_id", url_col="url", payload_col="html"):
    """Write all pages below a folder of the shared file system; returns one row per file (path, records, bytes)."""
    pages = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"), F.col(payload_col).alias("payload"))
    usable = pages.filter(F.octet_length("payload").between(1, SAMPLE_BYTES))
    keep = max(1, pages.select("page").count() // SAMPLES)
    sample = usable.filter(F.pmod(F.xxhash64("page"), F.lit(keep)) == 0).select("payload").limit(2 * SAMPLES)
    dictionary = train_dictionary([row.payload.encode("utf-8", "surrogatepass") for row in sample.collect()])
    rows = mark_revisits(pages, "page", "payload")

    def write(batches):
        target, place = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        target.create_dir(place)
        options = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        compressor = zstandard.ZstdCompressor(level=3, write_checksum=True, **options)
        out, name, records, size = None, "", 0, 0

        def close():
            nonlocal out
            out.close()
            out = None
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [records], "bytes": [size]})

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    out, records, size = target.open_output_stream(f"{place}/{name}"), 0, 0
                    if dictionary:
                        size += out.write(dictionary_frame(dictionary))
                first = row["_first"]
                payload = b"" if first is not None else row["_payload"]
                size += out.write(compressor.compress(record(row["page"], row["url"], payload, row["_digest"], row["_size"], first)))
                records += 1
                if size >= FILE_BYTES:
                    yield close()
        if out is not None:
            yield close()

    # A revisit needs no payload: it does not travel to Python.
    kept = F.when(F.col("_first").isNull(), F.col("_payload")).alias("_payload")
    files = rows.select("page", "url", "_digest", "_size", "_first", kept).mapInArrow(write, "path string, records long, bytes long")
    listing = work_folder(pages.sparkSession, "archives")
    files.write.parquet(listing)
    return pages.sparkSession.read.parquet(listing)


def read_archives(files, path_col="path"):
    """Records of all archives that a frame names, one row each."""

    def read(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                source, name = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
                rows, held = [], 0
                with source.open_input_stream(name) as stream:
                    for offset, data, problem in read_records(stream):
                        row = parse(data) if problem is None else dict.fromkeys(RECORD.names) | {"problem": problem}
                        rows.append(row | {"path": path, "offset": offset})
                        held += len(data or b"")
                        if held > 8 << 20:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    paths = files.select(F.col(path_col).alias("path"))
    return paths.repartition(max(1, paths.count()), "path").mapInArrow(read, RECORD)


ARROW = pa.schema([(f.name, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[f.dataType.typeName()]) for f in RECORD])


def _batch(rows):
    return pa.RecordBatch.from_pylist(rows, ARROW)


def records_in(data):
    """All records of an archive given as bytes, for tests and small files."""
    return list(read_records(io.BytesIO(data)))


def page_of(name):
    """Page id column of a record name column, null for foreign names."""
    return F.regexp_extract(name, f"^{PAGE}(-?[0-9]+)$", 1).try_cast("long")
