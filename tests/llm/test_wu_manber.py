import random

import pytest
from helpers import AWKWARD, docs

from tidemark.llm import wu_manber as M


def plain(text, items):
    """(words, hit positions, ids) by trying every position."""
    words, hit, ids = M.words_of(text), set(), set()
    for name, item in items:
        for window in M.windows_of(M.words_of(item)):
            for at in range(len(words) - len(window) + 1):
                if tuple(words[at : at + len(window)]) == window:
                    hit.update(range(at, at + len(window)))
                    ids.add(str(name))
    return len(words), hit, sorted(ids)


def found(spark, texts, items, **options):
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as window", "'y' as item")
    find = M.finder(bench, **options)
    rows = docs(spark, list(enumerate(texts)), extra=["found"]).select("doc_id", find("text").alias("f")).collect()
    return {r.doc_id: (r.f.n_words, {w for s in r.f.spans for w in range(s.first, s.end)}, r.f["items"]) for r in rows}


def test_random_texts_match_plain_search(spark):
    random.seed(3)
    make = lambda n, kinds: " ".join(random.choice("abcdefgh"[:kinds]) for _ in range(n))
    items = [(i, make(random.choice([1, 2, 3, 9, 10, 11, 14, 25]), 2 + i % 4)) for i in range(20)]
    texts = [make(random.randrange(60), 2 + i % 4) for i in range(80)]
    texts += [f"X {items[7][1].upper()}, {items[12][1]}!" for _ in range(2)]
    rows = found(spark, texts, items)
    for i, text in enumerate(texts):
        assert rows[i] == plain(text, items), text


def test_words():
    assert M.words_of("Don't STOP_me Ünd 3.5x\u00a0y\x7f") == ["don".encode(), b"t", b"stop", b"me", "Ünd".encode(), b"3", b"5x\xc2\xa0y"]
    assert M.words_of(None) == M.words_of("") == M.words_of(" ._") == []


@pytest.mark.parametrize("items", [[], [(1, None)], [(1, ""), (2, " . ")]])
def test_nothing_to_find(spark, items):
    assert set(map(lambda r: (len(r[1]), len(r[2])), found(spark, ["a b", None], items).values())) == {(0, 0)}


def test_shared_windows_and_repeated_items(spark):
    text = "a b c d e f g h i j k"
    items = [(1, text), (1, text), (2, "b c d e f g h i j k"), (None, "a"), (10, "k")]
    rows = found(spark, ["A-b c d e f g h i j k!", "k k"], items)
    assert rows[0] == (11, set(range(11)), ["", "1", "10", "2"]) and rows[1] == (2, {0, 1}, ["10"])


def test_many_chunks_give_the_same(spark):
    items = [(i, " ".join(f"w{(i * 7 + k) % 40}" for k in range(12))) for i in range(30)]
    texts = [" ".join(f"w{(i + k) % 40}" for k in range(60)) for i in range(5)] + [None]
    assert found(spark, texts, items, chunk=5) == found(spark, texts, items)


def test_awkward_rows(spark):
    rows = found(spark, [t for _, t in AWKWARD], [(1, "words that repeats"), (2, "long " * 10), (3, "x" * 5000)])
    assert len(rows) == len(AWKWARD)
    assert rows[9][1] == set(range(3000)) and rows[8][2] == ["3"] and rows[0] == (0, set(), [])
