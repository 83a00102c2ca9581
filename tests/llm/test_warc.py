import hashlib
import io
import struct

import pytest
import zstandard

from tidemark.llm import warc
from tidemark.llm.registry import op2_warc_zstd
from tidemark.session import work_folder

LONG = "<html>" + "equal payload " * 20 + "</html>"
PAGES = [
    (1, "http://a/", LONG),
    (2, None, LONG),
    (3, "http://c/\r\nX-Bad: 1", "short"),
    (4, "http://d/", "short"),
    (5, "http://e/ü ", None),
    (6, "", ""),
    (7, "http://g/", "é\r\n\r\n" * 4000),
    (-8, "http://h/", LONG),
    (9, "http://i/", "x" * 99),
    (10, "http://j/", "x" * 99),
    (11, "http://k/", "x" * 100),
    (12, "http://l/", "x" * 100),
    (None, "http://m/", LONG),
    (6, "", ""),
]


def expected(pages):
    first = {}
    for page, _, html in pages:
        if page is not None and len((html or "").encode()) >= 100:
            first[html] = min(page, first.get(html, page))
    rows = []
    for page, _, html in pages:
        data = (html or "").encode()
        of = first.get(html) if page is not None and first.get(html) != page else None
        rows.append((page, len(data), hashlib.sha256(data).hexdigest(), "response" if of is None else "revisit", of))
    return sorted(rows, key=str)


def test_round_trip(spark, tmp_path):
    extra = "'o' as path", "'p' as payload", "'q' as _digest"
    spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", *extra).write.parquet(str(tmp_path / "pages.parquet"))
    rows = op2_warc_zstd(spark, str(tmp_path)).collect()
    assert sorted([tuple(r)[:5] for r in rows], key=str) == expected(PAGES)
    assert all(r.problem is None for r in rows)


def test_payloads_come_back(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    pages = [(i, f"http://x/{i}", f"page {i} " * (i * 7)) for i in range(60)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    files = warc.write_archives(df, work_folder(spark, "warc-test"))
    assert files.count() > 1
    rows = warc.read_archives(files).collect()
    assert sorted((r.record_id, r.target_uri, bytes(r.payload).decode()) for r in rows) == sorted((f"urn:page:{i}", u, h) for i, u, h in pages)


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(df, work_folder(spark, "warc-test"))).collect() == []


def one(payload=b"hello", page=1):
    return warc.record(page, "http://x/", payload, hashlib.sha256(payload).hexdigest(), len(payload), None)


DICTIONARY = warc.train_dictionary([b"some page text %d about this and that " % i * 9 for i in range(300)])


@pytest.mark.parametrize("compressed", [True, False])
def test_dictionary_frame(compressed):
    assert DICTIONARY[:4] == struct.pack("<I", warc.DICTIONARY_MAGIC)
    frame = warc.dictionary_frame(DICTIONARY) if compressed else struct.pack("<II", warc.SKIPPABLE_MAGIC, len(DICTIONARY)) + DICTIONARY
    compress = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(DICTIONARY)).compress
    records = [one(b"some page text 5 about this", i) for i in range(3)]
    data = frame + b"".join(map(compress, records))
    for chunk in (1, 7, 1 << 20):
        found = list(warc.read_records(io.BytesIO(data), chunk))
        assert [f[1] for f in found] == records and found[0][0] == len(frame)
    lost = list(warc.read_records(io.BytesIO(data[len(frame) :])))
    assert lost == [(0, None, "bad frame")]


def test_broken_files():
    frame = zstandard.compress(one())
    read = warc.records_in
    assert read(b"") == []
    assert [p for _, _, p in read(frame + frame[:-3])] == [None, "cut frame"]
    assert [p for _, _, p in read(frame + b"garbage bytes")] == [None, "bad frame"]
    assert [p for _, _, p in read(struct.pack("<II", warc.SKIPPABLE_MAGIC, 50) + b"x")] == ["cut dictionary"]


@pytest.mark.parametrize(
    "old, new, problem",
    [
        (b"WARC/1.1", b"WARC/9.9", "no WARC header"),
        (b"WARC-Date: ", b"WARC-Dote: ", "no warc-date"),
        (b"\r\nWARC-Type: ", b"\r\nWARC-Typo: ", "no warc-type"),
        (b"hello\r\n\r\n", b"hello\r\n", "wrong length"),
        (b"hello\r\n\r\n", b"hellooo\r\n", "no closing line ends"),
        (b"hello", b"hallo", "wrong digest"),
        (b"Content-Length: 5\r\n\r\nhello", b"Content-Length: 4\r\n\r\nhello", "wrong HTTP length"),
        (b"WARC-Date: 2", b"WARC-Date 2", None),
    ],
)
def test_invalid_records(old, new, problem):
    data = one()
    assert old in data
    found = warc.parse(data.replace(old, new, 1))
    assert found["problem"] == problem if problem else found["problem"] is None or "no warc-date" in found["problem"]
    assert warc.parse(data)["problem"] is None and warc.parse(data)["payload"] == b"hello"


def test_too_few_samples_give_no_dictionary():
    assert warc.train_dictionary([b"x"] * 3) == b"" and warc.train_dictionary([]) == b""
