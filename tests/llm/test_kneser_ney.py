import math
import random
from collections import Counter, defaultdict

import pytest
from helpers import AWKWARD, docs, words

from tidemark.llm import kneser_ney as L


class Plain:
    """The same model from dictionaries."""

    def __init__(self, texts):
        rows = [words(t) + [None] for t in texts]
        self.n = Counter(w for row in rows for w in row)
        self.pairs = Counter(p for row in rows for p in zip([0, *row[:-1]], row))
        self.context, self.kinds, self.before = Counter(), defaultdict(Counter), Counter()
        for (a, b), n in self.pairs.items():
            self.context[a] += n
            self.kinds[a][min(n, 3)] += 1
            self.before[b] += 1
        of = lambda values: (lambda c: L.discounts([c[i] for i in (1, 2, 3, 4)]))(Counter(values))
        self.d, self.e = of(self.pairs.values()), of(self.before.values())

    def lower(self, w):
        if not self.pairs:
            return 1 / (len(self.n) + 1)
        cut = lambda n: n - self.e[min(n, 3) - 1] if n else 0
        rest = sum(self.e[min(n, 3) - 1] for n in self.before.values())
        return (cut(self.before[w]) + rest / (len(self.n) + 1)) / len(self.pairs)

    def p(self, v, w):
        if not self.context[v]:
            return self.lower(w)
        n = self.pairs[v, w]
        rest = sum(self.d[k - 1] * m for k, m in self.kinds[v].items())
        return ((n - self.d[min(n, 3) - 1] if n else 0) + rest * self.lower(w)) / self.context[v]

    def score(self, text):
        row, total = words(text) + [None], sum(self.n.values())
        base = sum(math.log10((self.n[w] + 0.1) / (total + 0.1 * (len(self.n) + 1))) for w in row)
        return len(row), sum(self.n[w] > 0 for w in row), base, sum(math.log10(self.p(v, w)) for v, w in zip([0, *row[:-1]], row))


def scored(spark, training, texts):
    model = L.train(docs(spark, list(enumerate(training)), extra=["n", "kind"]))
    rows = docs(spark, list(enumerate(texts))).select("doc_id", L.scorer(model)("text").alias("s")).collect()
    assert len(rows) == len(texts)
    return model, {r.doc_id: tuple(r.s) for r in rows}


def check(spark, training, texts):
    model, found = scored(spark, training, texts)
    plain = Plain(training)
    assert (model.tokens, model.vocabulary, model.pairs) == (sum(plain.n.values()), len(plain.n), len(plain.pairs))
    for i, text in enumerate(texts):
        assert found[i] == pytest.approx(plain.score(text)), text
    return plain


def sentences(n, seed=2):
    random.seed(seed)
    weights = [1 / (i + 1) for i in range(80)]
    return [" ".join(random.choices([f"W{i}" for i in range(80)], weights, k=random.randrange(30))) for _ in range(n)]


def test_scores_match_plain_model_and_sum_to_one(spark):
    plain = check(spark, sentences(300), sentences(40, seed=9) + ["never seen words", "W0 unseen W1", "", None])
    for v in (0, b"w0", b"w79", b"unseen"):
        assert sum(plain.p(v, w) for w in plain.n) + plain.p(v, b"unseen") == pytest.approx(1)


def test_many_buckets_and_frequent_words(spark, monkeypatch):
    training = sentences(300) + ["W0 " * 400]
    monkeypatch.setattr(L, "BUCKET_BYTES", sum(map(len, training)) // 15)
    monkeypatch.setattr(L, "SAMPLED", 1)
    monkeypatch.setattr(L, "HELD_TOKENS", 500)
    monkeypatch.setattr(L, "SCORED_TOKENS", 200)
    check(spark, training, sentences(40, seed=9))
    model = L.train(docs(spark, list(enumerate(training))))
    assert model.buckets == 16 and len(model.frequent)


@pytest.mark.parametrize("training", [[], [None], ["one"]])
def test_tiny_training_sets(spark, training):
    check(spark, training, ["one two", None, ""])


def test_awkward_rows(spark):
    texts = [t for _, t in AWKWARD]
    check(spark, texts, texts)


def test_learning_lowers_perplexity(spark):
    lines = ["the cat sat on the mat", "a dog ran to the river", "rain fell on a river"]
    _, found = scored(spark, lines * 20, [f"{a} {b}" for a in lines for b in lines])
    assert sum(s[3] for s in found.values()) > sum(s[2] for s in found.values())
    assert L.perplexity(-6.0, 3) == pytest.approx(100.0)
