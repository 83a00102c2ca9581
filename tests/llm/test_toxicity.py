import random

import pytest
from helpers import AWKWARD, docs

from tidemark.llm import toxicity as T


def corpus(n, seed=5):
    random.seed(seed)
    syllables = [a + b for a in "bcdfgklmnprst" for b in ("a", "en", "i", "or", "ul")]
    rows = []
    for i in range(n):
        text = ["".join(random.choices(syllables, k=random.randrange(1, 4))) for _ in range(random.randrange(20, 120))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(random.randrange(1, 4)):
                text.insert(random.randrange(len(text)), random.choice(["vile", "wretch", "IDIOTIC"]))
        rows.append((" ".join(text), int(toxic)))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus(1000)
    model = T.fit([t for t, _ in rows[:800]], [y for _, y in rows[:800]])
    df = spark.createDataFrame([(t, y) for t, y in rows[800:]], "text string, y int")
    scored = df.select("y", T.scorer(model)("text").alias("s")).collect()
    assert all(0 <= r.s <= 1 for r in scored)
    assert sum((r.s >= 0.5) == (r.y == 1) for r in scored) >= 0.97 * len(scored)


def test_long_texts_are_read_to_the_end(spark):
    rows = corpus(400)
    model = T.fit([t for t, _ in rows], [y for _, y in rows])
    clean = " ".join(t for t, y in rows if not y)
    df = spark.createDataFrame([(1, clean), (2, clean + " wretch vile")], "id int, text string")
    low, high = [r.s for r in df.select("id", T.scorer(model)("text").alias("s")).orderBy("id").collect()]
    assert low < high


@pytest.mark.parametrize("labels", [[], [0, 0, 0], [1, 1]])
def test_missing_classes(spark, labels):
    model = T.fit(["some text"] * len(labels), labels)
    scores = {r.s for r in docs(spark, AWKWARD).select(T.scorer(model)("text").alias("s")).collect()}
    assert len(scores) == 1
    assert scores.pop() == pytest.approx((sum(labels) + 0.5) / (len(labels) + 1))


def test_sample_takes_labels_by_id(spark):
    table = docs(spark, AWKWARD, extra=["label", "id"])
    labels = spark.createDataFrame([(4, 0), (4, 1), (5, 0), (6, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    assert T.labelled_sample(table, labels) == (["one", "Zwei wörter"], [1, 0])


def test_sample_is_bounded_for_one_id_on_many_rows(spark, monkeypatch):
    rows = [(1, f"text {i} of one id " + "x" * (i % 50)) for i in range(20_000)] + [(i, "y" * 100) for i in range(2, 60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)], "doc_id long, toxic int")
    texts, found = T.labelled_sample(docs(spark, rows), labels)
    assert len(texts) == 59 and texts[0].startswith("text ") and found == [i % 2 for i in range(1, 60)]
    assert T.labelled_sample(docs(spark, rows), labels) == (texts, found)
    assert len(T.labelled_sample(docs(spark, rows), labels, rows=10)[0]) == 10
    assert 0 < sum(map(len, T.labelled_sample(docs(spark, rows), labels, total=1000)[0])) <= 1000
    assert T.labelled_sample(docs(spark, rows), labels, most_bytes=90)[0] == texts[:1]


def test_awkward_rows_and_empty_table(spark):
    rows = corpus(200)
    model = T.fit([t for t, _ in rows], [y for _, y in rows])
    found = docs(spark, AWKWARD).select("doc_id", T.scorer(model)("text").alias("s")).collect()
    assert len(found) == len(AWKWARD) and all(0 <= r.s <= 1 for r in found)
    assert docs(spark, []).select(T.scorer(model)("text")).collect() == []


def test_windows_of_several_words():
    lengths = T.Lengths([b"calm"], [b"wretch"], window=3)
    assert lengths.of_text("you are a wretch today") > lengths.of_text("you are a friend today")
    assert lengths.of_text("") == lengths.of_text(None) == lengths.of_text("123") == (0.0,) * T.FEATURES


def test_phrases_and_word_order_are_learned():
    rows = [(t + " " + ("river takes stone" if y else "stone takes river"), y) for t, y in ((t, i % 3 == 0) for i, (t, y) in enumerate(corpus(900)) if not y)]
    model = T.fit([t for t, _ in rows[:500]], [int(y) for _, y in rows[:500]])
    lengths = T.Lengths(model[0], model[1], model[3])
    x = [lengths.of_text(t) for t, _ in rows[500:]]
    hits = [(sum(a * b for a, b in zip(v, model[2])) + model[2][-1] >= 0) == y for v, (_, y) in zip(x, rows[500:])]
    assert sum(hits) >= 0.97 * len(hits)
