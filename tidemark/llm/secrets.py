"""Secrets in texts: pattern candidates, false positives removed by a random forest.

Candidates are all values given to a credential's name, of any length and with any characters, whatever follows
`Bearer`, and all runs of at least `LEAST` letters, digits and `+/_-` that hold a digit. Which of them are secrets is
left to the forest. It looks at their length, at how likely their character transitions are in ordinary words, at how much of
them dictionary words cover, at how often their characters change between letters and digits and cases, at whether
they stand in a path, address or assignment, and at what their neighbouring words meant for labelled
findings. What is learned comes from all different texts, whole, and all different labelled findings: transitions and
dictionary from the counts of all words, neighbours from counts in `BUCKETS` buckets of words, cuts from a count of all
values of a feature, and the trees level by level, from counts of all findings per node, feature and cut. Tasks count, Spark
sums; the driver sees only sums whose number is fixed. Every text is scanned whole.

`silver_findings` labels findings where no audited ones are at hand, and only those that are clear: values
with letters that are given to a credential's name or follow `Bearer` are secrets; numbers that nothing is given, and values
behind a slash or in an address, are not. All others stay unlabelled, and the forest decides on them.

Null and empty texts have no candidates. Candidates do not overlap: assigned values come before runs, and
earlier ones before later ones. Without labelled findings of both kinds the forest is the share
of secrets among them, and one half without any. Repeated rows are scanned alike and are learned from once. Empty
tables give no rows; other columns are ignored.
"""

import re
from collections import Counter
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.arrays import HashSet
from tidemark.session import work_folder

LEAST = 8
# Bounds of earlier samples. Nothing reads them any more; the names stay for those who set them.
SAMPLE_TEXTS, SAMPLE_FINDINGS = 2000, 4000
DICTIONARY = 5000
NEIGHBOURS = 3
AROUND = 80
BUCKETS = 1 << 16
TREES, DEPTH, LEAF, CUTS, TRIED = 40, 8, 2, 63, 4
# Steps between the least and the largest value of a feature, from which its cuts are taken.
STEPS = 1024
# A task hands on its word counts from so many different words on.
WORDS_HELD = 200_000
LONG_TEXT = 1 << 20
MASK = "[SECRET]"
_DIGITS = re.compile("[0-9]+")
_REST = re.compile(r"[A-Za-z0-9+/_\-]*")
_OF_RUNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
_WORD = re.compile(r"[^\W\d_]+")
_NAME = r"(?:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key|credential|private[_-]?key)[\w\-]*[\"']?\s*[:=]\s*"
_CREDENTIAL = re.compile(rf"(?i)(?:{_NAME}[\"']?|\bbearer\s+)$")
# A value in quotes to their end on the line, or all up to a blank, quote, comma or semicolon.
_ASSIGNED = re.compile(rf"(?i)(?:{_NAME}|\bbearer\s+)(?:\"([^\"\n]+)\"|'([^'\n]+)'|[\"']?([^\s\"',;]+))")
_HINTS = ("token", "secret", "passw", "key", "credential", "bearer")
FEATURES = 12


def runs_with_digits(text):
    """(start, end) of every run that is long enough and holds a digit, from its digits outwards."""
    found, end = [], 0
    for m in _DIGITS.finditer(text):
        if m.start() >= end:
            start, least = m.start(), end
            while start > least and text[start - 1] in _OF_RUNS:
                start -= 1
            end = _REST.match(text, m.end()).end()
            if end - start >= LEAST:
                found.append((start, end))
    return found


def candidates(text):
    """(start, end) of every candidate, in order."""
    if not text:
        return []
    runs = runs_with_digits(text)
    lower = text.lower()
    if not any(hint in lower for hint in _HINTS):
        return runs
    given = [m.span(m.lastindex) for m in _ASSIGNED.finditer(text)]
    free, at = [], 0
    for start, end in runs:
        while at < len(given) and given[at][1] <= start:
            at += 1
        if at == len(given) or given[at][0] >= end:
            free.append((start, end))
    return sorted(given + free)


def neighbours(text, start, end):
    """Lower-case words before and after a span."""
    before = _WORD.findall(text[max(0, start - AROUND) : start].lower())[-NEIGHBOURS:]
    return before, _WORD.findall(text[end : end + AROUND].lower())[:NEIGHBOURS]


def silver_label(text, start, end):
    """1 for a value with letters that is given to a credential's name, 0 for what is clearly none, else None."""
    value, left = text[start:end], text[max(0, start - AROUND) : start]
    if _CREDENTIAL.search(left):
        return None if value.isdigit() else 1
    inside = "/" in value or left[-1:] in ("/", "@") or "://" in left.rsplit(" ", 1)[-1]
    return 0 if inside or not re.search("[A-Za-z]", value) else None


class Features:
    """Numbers of a candidate, from what ordinary words and labelled findings taught."""

    def __init__(self, transitions, dictionary, odds):
        self.transitions, self.dictionary, self.odds = transitions, frozenset(dictionary), odds
        self.sizes = sorted({len(w) for w in dictionary}, reverse=True)

    def covered(self, value):
        """Share of the characters that dictionary words cover, the longest word first at each place."""
        value, at, n = value.lower(), 0, 0
        while at < len(value):
            size = next((s for s in self.sizes if value[at : at + s] in self.dictionary), 0)
            n += size
            at += size or 1
        return n / len(value)

    def of(self, text, start, end):
        value = text[start:end]
        codes = np.minimum(np.frombuffer(value.lower().encode("utf-8", "surrogatepass"), np.uint8), 127)
        likely = float(self.transitions[codes[:-1], codes[1:]].mean()) if len(codes) > 1 else 0.0
        kinds = np.array([c.isdigit() + 2 * c.isupper() for c in value])
        _, counts = np.unique(codes, return_counts=True)
        shares = counts / len(codes)
        before, after = neighbours(text, start, end)
        odds = [self.odds.get(bucket_of(w), 0.0) for w in before] or [0.0]
        behind = [self.odds.get(bucket_of(w), 0.0) for w in after] or [0.0]
        left = text[max(0, start - AROUND) : start].rstrip("\"' ")
        return [
            np.log(len(value)),
            likely,
            self.covered(value),
            float((kinds[1:] != kinds[:-1]).mean()) if len(kinds) > 1 else 0.0,
            float((kinds == 1).mean()),
            float(-(shares * np.log2(shares)).sum()),
            float(value.count("/") + text[start - 1 : start].count("/") if start else value.count("/")),
            float("://" in text[max(0, start - AROUND) : start].rsplit(" ", 1)[-1]),
            float("@" in text[end : end + 1] or "." in text[end : end + 1] and text[end + 1 : end + 2].isalnum()),
            float(left.endswith(("=", ":")) or left[-6:].lower() == "bearer"),
            max(odds),
            max(behind),
        ]


def text_words(text):
    """Lower-case words of a text; those of a very long one come one by one."""
    text = text.lower()
    return _WORD.findall(text) if len(text) < LONG_TEXT else (m.group() for m in _WORD.finditer(text))


def _held_counts(counts):
    columns = [pa.nulls(len(counts), pa.int64()), pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["hash", "word", "n"])


def _count_words(repeated=None):
    """Rows (null, word, n) from rows (hash, text). Texts with a repeated hash are passed on as rows (hash, text, null)."""

    def count(batches):
        counts, seen = Counter(), set()
        for batch in batches:
            hashes = batch.column(0).to_numpy(zero_copy_only=False)
            later = repeated.contains(hashes.view(np.uint64)) if repeated else np.zeros(len(hashes), bool)
            for again, name, text in zip(later, hashes.tolist(), batch.column(1)):
                if not again:
                    counts.update(text_words(text.as_py()))
                    if len(counts) >= WORDS_HELD:
                        yield _held_counts(counts)
                        counts = Counter()
                elif name not in seen:
                    seen.add(name)
                    columns = [pa.array([name], pa.int64()), pa.array([text.as_py()], pa.string()), pa.nulls(1, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["hash", "word", "n"])
        if counts:
            yield _held_counts(counts)

    return count


WORD_COUNTS = "hash long, word string, n long"


def word_counts(docs, text_col="text"):
    """Rows (word, n) over all different texts, each whole. Texts that stand on one row only are counted where they are
    read; of the others one of each is counted."""
    text = docs.select(F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text")).filter("text is not null")
    repeated = _kept(text.groupBy("hash").count().filter("count > 1").select("hash"), "repeated-texts")
    counts = _kept(text.mapInArrow(_count_words(HashSet(repeated, "hash")), WORD_COUNTS), "word-counts")
    once = counts.filter("hash is not null").groupBy("hash").agg(F.min("word").alias("text"))
    counts = counts.filter("hash is null").union(once.mapInArrow(_count_words(), WORD_COUNTS))
    return _kept(counts.groupBy("word").agg(F.sum("n").alias("n")), "words")


def _count_transitions(batches):
    """Rows (cell, n) of pairs of characters from rows (word, n)."""
    counts = np.zeros(128 * 128, np.int64)
    for batch in batches:
        for word, n in zip(*(column.to_pylist() for column in batch.columns)):
            codes = np.minimum(np.frombuffer(word.encode("utf-8", "surrogatepass"), np.uint8), 127).astype(np.int64)
            np.add.at(counts, codes[:-1] * 128 + codes[1:], n)
    cells = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(counts[cells])], ["cell", "n"])


def ordinary_words(words):
    """Transition log probabilities and the most frequent words, from rows (word, n)."""
    counts = np.full(128 * 128, 0.1)
    cells = words.mapInArrow(_count_transitions, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    for row in cells.collect():
        counts[row.cell] += row.n
    counts = counts.reshape(128, 128)
    frequent = words.filter(F.length("word") > 2).orderBy(F.desc("n"), "word").limit(DICTIONARY).select("word")
    return np.log(counts / counts.sum(axis=1, keepdims=True)), [row.word for row in frequent.collect()]


def bucket_of(word):
    """Bucket of a neighbouring word."""
    return crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS


def _spans(batch):
    """(text, start, end, label) of findings (before, value, after, label)."""
    for before, value, after, label in zip(*(batch.column(i).to_pylist() for i in range(4))):
        yield before + value + after, len(before), len(before) + len(value), label


def _count_neighbours(batches):
    """Rows (bucket, n0, n1): findings of either label with a word of the bucket near them."""
    counts = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        for text, start, end, label in _spans(batch):
            counts[label, list({bucket_of(w) for w in sum(neighbours(text, start, end), [])})] += 1
    buckets = np.flatnonzero(counts.sum(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (buckets, *counts[:, buckets])], ["bucket", "n0", "n1"])


def neighbour_odds(findings, totals):
    """Smoothed log odds of being near a secret, per bucket of neighbouring words; `totals` are the findings by label."""
    counts = findings.mapInArrow(_count_neighbours, "bucket long, n0 long, n1 long").groupBy("bucket")
    rows = sorted(counts.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect())
    share = [np.log((n + 0.5) / (t + 1)) for n, t in zip(np.array([r[1:] for r in rows]).reshape(-1, 2).T, totals)]
    return dict(zip([r.bucket for r in rows], (share[1] - share[0]).tolist()))


def feature_cuts(x):
    """Cuts of every feature: values of its rows, evenly spread over them, from counts of all rows in `STEPS` steps."""
    ends = x.agg(*[f(c) for c in x.columns for f in (F.min, F.max)]).first()
    cells = []
    for i, c in enumerate(x.columns):
        low, high = ends[2 * i], ends[2 * i + 1]
        step = F.floor((F.col(c) - low) / (high - low) * STEPS) if high > low else F.lit(0)
        cells.append(F.struct(F.lit(i).alias("i"), step.cast("long").alias("step"), F.col(c).alias("x")))
    cells = x.select(F.inline(F.array(*cells))).groupBy("i", "step").agg(F.count("*").alias("n"), F.max("x").alias("x"))
    cuts = [[] for _ in x.columns]
    rows = sorted(cells.collect())
    for i in range(len(cuts)):
        found = [r for r in rows if r.i == i]
        total = np.cumsum([r.n for r in found])
        at = np.unique(np.searchsorted(total, np.linspace(0, total[-1], CUTS + 2)[1:-1])) if len(found) > CUTS else range(len(found))
        # Nothing lies above the last value.
        cuts[i] = [found[k].x for k in at if k < len(found) - 1]
    return cuts


# Shares of Poisson(1) up to 0, 1, 2, ...
_UP_TO = np.exp(-1) * np.cumsum(1 / np.cumprod([1, *range(1, 20)]))


def tried_features(tree, node):
    """Features that are tried at a node."""
    return np.random.default_rng([17, tree, node]).choice(FEATURES, TRIED, replace=False)


def _node_counts(splits, open_nodes):
    """Rows (tree, node, tried, bin, n0, n1): findings of either label in the open nodes, by bin of each tried feature.

    A finding counts as often as Poisson(1) says by its hash and the tree, which is a bootstrap sample on any partitioning.
    """
    slots = {key: i for i, key in enumerate(open_nodes)}
    tried = np.array([tried_features(*key) for key in open_nodes])
    per_tree = {}
    for tree, node in open_nodes:
        per_tree.setdefault(tree, []).append(node)
    size = 2 << DEPTH
    trees = {tree: (np.full(size, -1), np.zeros(size, np.int64)) for tree in per_tree}
    for (tree, node), split in splits.items():
        if tree in trees:
            trees[tree][0][node], trees[tree][1][node] = split

    def route(tree, bins):
        feature, cut = trees[tree]
        node, every = np.ones(len(bins), np.int64), np.arange(len(bins))
        for _ in range(DEPTH):
            at = feature[node]
            node = np.where(at < 0, node, 2 * node + (bins[every, at] > cut[node]))
        return node

    def count(batches):
        counts = np.zeros((len(open_nodes), TRIED, CUTS + 1, 2), np.int32)
        for batch in batches:
            names = batch.column(0).to_numpy().view(np.uint64)
            labels = batch.column(1).to_numpy()
            bins = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, FEATURES).astype(np.int64)
            for tree, nodes in per_tree.items():
                chance = W.mix(names ^ W.mix(np.uint64([tree + 1]))) / 2.0**64
                weight = np.searchsorted(_UP_TO, chance)
                slot_of = np.full(size, -1)
                slot_of[nodes] = [slots[tree, node] for node in nodes]
                slot = slot_of[route(tree, bins)]
                here = np.flatnonzero((slot >= 0) & (weight > 0))
                for k in range(TRIED):
                    at = slot[here]
                    np.add.at(counts, (at, k, bins[here, tried[at, k]], labels[here]), weight[here])
        slot, k, bin_, _ = np.nonzero(counts.sum(axis=3, keepdims=True))
        keys = np.array(open_nodes)[slot].T
        columns = [*keys, k, bin_, *counts[slot, k, bin_].astype(np.int64).T]
        names = ["tree", "node", "tried", "bin", "n0", "n1"]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names)

    return count


def best_splits(rows, splits, open_nodes):
    """The best split (impurity, tried, bin, findings by label on the left, and in all) of each open node that has one."""
    schema = ", ".join(f"{c} long" for c in ("tree", "node", "tried", "bin", "n0", "n1"))
    counts = rows.mapInArrow(_node_counts(splits, open_nodes), schema).groupBy("tree", "node", "tried", "bin")
    counts = counts.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    whole = Window.partitionBy("tree", "node", "tried")
    so_far = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.select(
        "*",
        *[F.sum(f"n{i}").over(so_far).alias(f"l{i}") for i in (0, 1)],
        *[F.sum(f"n{i}").over(whole).alias(f"t{i}") for i in (0, 1)],
    )
    n, m = F.expr("l0 + l1"), F.expr("t0 + t1 - l0 - l1")
    counts = counts.filter((n >= LEAF) & (m >= LEAF))
    impurity = F.expr("l0") * F.expr("l1") / n + F.expr("t0 - l0") * F.expr("t1 - l1") / m
    found = F.struct(impurity.alias("impurity"), "tried", "bin", "l0", "l1", "t0", "t1")
    return counts.groupBy("tree", "node").agg(F.min(found).alias("best")).collect()


def grow_forest(rows, cuts, totals, trees=TREES):
    """Trees as nested tuples (feature, cut, left, right), leaves as shares, from rows (hash, label, bins).

    All open nodes of all trees are split at once, level by level.
    """
    share = totals[1] / sum(totals) if sum(totals) else 0.5
    if not all(totals):
        return [share]
    splits, shares = {}, {(tree, 1): share for tree in range(trees)}
    open_nodes = sorted(shares)
    for _ in range(DEPTH):
        later = []
        for row in best_splits(rows, splits, open_nodes) if open_nodes else []:
            _, k, cut, l0, l1, t0, t1 = row.best
            splits[row.tree, row.node] = int(tried_features(row.tree, row.node)[k]), cut
            for node, n0, n1 in ((2 * row.node, l0, l1), (2 * row.node + 1, t0 - l0, t1 - l1)):
                shares[row.tree, node] = n1 / (n0 + n1)
                if n0 and n1 and n0 + n1 >= 2 * LEAF:
                    later.append((row.tree, node))
        open_nodes = sorted(later)

    def nested(tree, node):
        if (tree, node) not in splits:
            return shares[tree, node]
        feature, cut = splits[tree, node]
        return feature, cuts[feature][cut], nested(tree, 2 * node), nested(tree, 2 * node + 1)

    return [nested(tree, 1) for tree in range(trees)]


def vote(forest, row):
    """Mean share over the trees."""
    total = 0.0
    for node in forest:
        while isinstance(node, tuple):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        total += node
    return total / len(forest)


def _kept(df, name):
    """The rows, written to the shared folder and read back."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


FINDINGS = "array<struct<before:string,value:string,after:string,label:int>>"


def silver_findings(docs, text_col="text"):
    """Findings (before, value, after, label) of all texts whose label is clear."""

    @F.arrow_udf(FINDINGS)
    def find(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts.to_pylist():
            labelled = [(a, b, silver_label(text, a, b)) for a, b in candidates(text)]
            rows.append(
                [
                    {"before": text[max(0, a - AROUND) : a], "value": text[a:b], "after": text[b : b + AROUND], "label": label}
                    for a, b, label in labelled
                    if label is not None
                ]
            )
        kind = pa.struct([("before", pa.string()), ("value", pa.string()), ("after", pa.string()), ("label", pa.int32())])
        return pa.array(rows, pa.list_(kind))

    return docs.select(F.explode(find(F.col(text_col))).alias("f")).select("f.*")


def _feature_rows(model):
    """Rows (hash, label, features) from findings (before, value, after, label, hash)."""

    def make(batches):
        features = Features(*model)
        for batch in batches:
            rows = np.array([features.of(*span[:3]) for span in _spans(batch)]).reshape(-1, FEATURES)
            columns = [batch.column(4), batch.column(3), *[pa.array(np.ascontiguousarray(c)) for c in rows.T]]
            yield pa.RecordBatch.from_arrays(columns, ["hash", "label", *COLUMNS])

    return make


def _bin_rows(cuts):
    """Rows (hash, label, bins) from rows (hash, label, features): one byte for the number of cuts below each feature."""

    def make(batches):
        for batch in batches:
            bins = [np.searchsorted(c, batch.column(i + 2).to_numpy()) for i, c in enumerate(cuts)]
            packed = np.array(bins).T.astype(np.uint8)
            columns = [batch.column(0), batch.column(1), pa.array([row.tobytes() for row in packed], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["hash", "label", "bins"])

    return make


COLUMNS = [f"x{i}" for i in range(FEATURES)]


def train(docs, findings, text_col="text"):
    """Model (transitions, dictionary, odds, forest) from all ordinary texts and all labelled findings."""
    transitions, dictionary = ordinary_words(word_counts(docs, text_col))
    parts = ["before", "value", "after", "label"]
    labelled = findings.filter("label is not null").select(*parts).distinct()
    labelled = _kept(labelled.withColumn("hash", F.xxhash64(*parts)), "findings")
    found = {row.label: row["count"] for row in labelled.groupBy("label").count().collect()}
    totals = [found.get(label, 0) for label in (0, 1)]
    odds = neighbour_odds(labelled, totals)
    if not all(totals):
        return transitions.tolist(), dictionary, odds, grow_forest(None, None, totals)
    schema = ", ".join(["hash long", "label int", *[f"{c} double" for c in COLUMNS]])
    x = _kept(labelled.mapInArrow(_feature_rows((transitions, dictionary, odds)), schema), "features")
    cuts = feature_cuts(x.select(COLUMNS))
    bins = _kept(x.mapInArrow(_bin_rows(cuts), "hash long, label int, bins binary"), "bins")
    return transitions.tolist(), dictionary, odds, grow_forest(bins, cuts, totals)


@lru_cache(maxsize=2)
def _worker(key):
    transitions, dictionary, odds, forest = key.model
    return Features(np.array(transitions), dictionary, odds), forest


class Held:
    """A model as a key of the workers' cache."""

    def __init__(self, model):
        self.model = model
        self.name = hash(repr(model[3]))

    def __hash__(self):
        return self.name

    def __eq__(self, other):
        return isinstance(other, Held) and self.model == other.model


def judged(text, held):
    """(start, end, probability) of every candidate of a text."""
    features, forest = _worker(held)
    return [(a, b, vote(forest, features.of(text, a, b))) for a, b in candidates(text)]


SPANS = "array<struct<start:int,end:int,probability:double>>"


def scanner(model):
    """Function of a text column that gives all candidates with their probability."""
    held = Held(model)

    @F.arrow_udf(SPANS)
    def scan(texts: pa.Array) -> pa.Array:
        names = ("start", "end", "probability")
        rows = [[dict(zip(names, found)) for found in judged(text.as_py(), held)] for text in texts]
        kind = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())])
        return pa.array(rows, pa.list_(kind))

    return scan


def masker(model, least=0.5):
    """Function of a text column that gives the text with its secrets masked; null stays null."""
    held = Held(model)

    @F.arrow_udf("string")
    def mask(texts: pa.Array) -> pa.Array:
        masked, out, after = {}, [], 0
        for i, value in enumerate(texts):
            text = value.as_py()
            spans = [(a, b) for a, b, probability in judged(text, held) if probability >= least]
            for start, end in reversed(spans):
                text = text[:start] + MASK + text[end:]
            if spans:
                masked[i] = text
        # Runs of texts without secrets are passed on as they are.
        for i in sorted(masked):
            out += [texts.slice(after, i - after), pa.array([masked[i]], texts.type)]
            after = i + 1
        return pa.chunked_array([*out, texts.slice(after)], texts.type).combine_chunks()

    return mask
