import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from helpers import AWKWARD, docs
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import pieces

MODEL = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
CHUNKS = pieces.Chunks(MODEL)


def test_model_can_be_chunked():
    assert CHUNKS.joinable


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" ▁\t\nab<>0xsé日😀\x00"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_ids_and_text_match_the_library(text):
    ids = CHUNKS.encode_all(pa.array([text], pa.string()))
    assert ids.to_pylist() == [LIBRARY.encode(text)]
    assert CHUNKS.decode_all(ids).to_pylist() == [LIBRARY.decode(LIBRARY.encode(text))]


def test_awkward_rows(spark):
    df = docs(spark, AWKWARD, extra=["ids"])
    rows = df.select("doc_id", "text", pieces.encoder(MODEL)("text").alias("coded")).withColumn("back", pieces.decoder(MODEL)("coded")).collect()
    assert len(rows) == len(AWKWARD)
    for row in rows:
        assert row.coded == LIBRARY.encode(row.text or "")
        assert row.back == LIBRARY.decode(row.coded)


def test_table_is_emptied_and_whole_texts_work_too(monkeypatch):
    monkeypatch.setattr(pieces, "TABLE_ROWS", 3)
    small = pieces.Chunks(MODEL)
    texts = ["a b c d e f", "a b c  x ", "g"]
    assert small.encode_all(pa.array(texts)).to_pylist() == LIBRARY.encode(texts)
    assert len(small.table) <= 4
    small.joinable = False
    assert small.encode_all(pa.array(texts)).to_pylist() == LIBRARY.encode(texts)


@pytest.mark.parametrize("lists", [[], [[]], [None], [[], None, [5, 6]]])
def test_decoding_empty_lists(lists):
    expected = [LIBRARY.decode(ids) if ids else "" for ids in lists]
    assert CHUNKS.decode_all(pa.array(lists, pa.list_(pa.int32()))).to_pylist() == expected


def test_empty_table(spark):
    assert docs(spark, []).select(pieces.encoder(MODEL)("text")).collect() == []


def test_round_trips_of_awkward_rows(spark):
    rows = docs(spark, AWKWARD).select("text", pieces.round_tripper(MODEL)("text").alias("coded")).collect()
    assert len(rows) == len(AWKWARD)
    for row in rows:
        assert row.coded.ids == LIBRARY.encode(row.text or "")
        assert row.coded.decoded == LIBRARY.decode(row.coded.ids)
