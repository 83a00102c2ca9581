"""SentencePiece encoding and decoding through a table of distinct chunks.

If no piece of a model holds a white space marker after another character, a piece cannot
cross from one marked word into the next. A text is then the sequence of its chunks (markers
and the characters up to the next marker), and the ids of the text are the ids of its chunks
in order. Each task keeps a table chunk -> ids: a new chunk is segmented once by the library,
all its occurrences are joined by position. The table is emptied once it holds `TABLE_ROWS`
chunks or `TABLE_BYTES` bytes, which costs time only. Models that break the condition are encoded text by text.

Null and empty texts have no ids; no ids decode to the empty text. Ids are int. Nothing is
shuffled, and texts of any length are encoded whole.
"""

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import functions as F

MARKER = "▁"
TABLE_ROWS, TABLE_BYTES = 600_000, 180 << 20
# Characters of texts that are split together.
TOGETHER = 1 << 18
# Characters that a changing normaliser would touch.
PROBE = "ﬁ ① Ａ   x́ \t\n  y "


class Chunks:
    """Encoder of one worker."""

    def __init__(self, model):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        crosses = re.compile(f"[^{MARKER}]{MARKER}")
        names = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        plain = MARKER + PROBE.replace(" ", MARKER)
        self.joinable = self.model.normalize(PROBE) == plain and not any(map(crosses.search, names))
        self.split = re.compile(f"{MARKER}+[^{MARKER}]*").findall
        self.clear()

    def clear(self):
        alone = np.array([self.model.piece_to_id(MARKER)], np.int32)
        self.table, self.held = {MARKER: alone.tobytes()}, 0

    def encode(self, texts):
        """Ids of each text of a list as bytes of int32."""
        if not self.joinable:
            return [array("i", self.model.encode(text)).tobytes() for text in texts]
        split = [self.split(MARKER + text.replace(" ", MARKER)) if text else [] for text in texts]
        # A small table of these texts' chunks serves all but their first look-up.
        known = {chunk: self.table.get(chunk) for chunk in set(chain.from_iterable(split))}
        new = [chunk for chunk, coded in known.items() if coded is None]
        # The library puts one marker in front of what it encodes.
        for chunk, ids in zip(new, self.model.encode([c[1:] for c in new], num_threads=1)):
            known[chunk] = self.table[chunk] = coded = array("i", ids).tobytes()
            self.held += 3 * len(chunk) + len(coded) + 150
        if self.held > TABLE_BYTES or len(self.table) > TABLE_ROWS:
            self.clear()
        return [b"".join(map(known.__getitem__, chunks)) for chunks in split]

    def encode_all(self, texts):
        """Arrow array of texts to an Arrow array of id lists."""
        coded, held, size = [], [], 0
        for text in texts:
            held.append(text.as_py() or "")
            size += len(held[-1])
            if size >= TOGETHER:
                coded += self.encode(held)
                held, size = [], 0
        coded += self.encode(held)
        ends = np.cumsum([0, *[len(c) // 4 for c in coded]])
        values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(coded))])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)

    def decode_all(self, lists):
        """Arrow array of id lists to an Arrow array of texts."""
        texts, ids, at = [], lists.flatten().to_numpy(zero_copy_only=False), 0
        for n in lists.value_lengths().fill_null(0).tolist():
            texts.append(self.model.decode(ids[at : at + n].tolist()) if n else "")
            at += n
        return pa.array(texts, pa.string())

    def round_trips(self, texts):
        """Arrow array of texts to an Arrow array of structs: the ids, and the text that they decode to."""
        ids = self.encode_all(texts)
        return pa.StructArray.from_arrays([ids, self.decode_all(ids)], ["ids", "decoded"])


@lru_cache(maxsize=2)
def _worker(model):
    return Chunks(model)


def read_model(path):
    """Bytes of a model file; they travel with the functions, so executors need no file."""
    with open(path, "rb") as file:
        return file.read()


def encoder(model):
    """Function of a text column that gives the column of its ids."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        worker = _worker(model)
        try:
            for texts in batches:
                yield worker.encode_all(texts)
        finally:
            worker.clear()

    return encode


def decoder(model):
    """Function of a column of ids that gives the column of their text."""

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        return _worker(model).decode_all(lists)

    return decode


def round_tripper(model):
    """Function of a text column that gives `ids` and `decoded`, the text of these ids.

    Both come from one worker: chained functions would keep two workers a task, each with a model, and send the ids
    to Python once more.
    """

    @F.arrow_udf("struct<ids: array<int>, decoded: string>")
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        worker = _worker(model)
        try:
            for texts in batches:
                yield worker.round_trips(texts)
        finally:
            worker.clear()

    return code
