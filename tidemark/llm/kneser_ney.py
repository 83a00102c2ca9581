"""Scores of texts under an interpolated modified Kneser-Ney model of word pairs.

The order is fixed at two: with pairs alone a run writes 3.1 times its input, and distinct triples would add 1.9 times the
bytes of the pairs (2.5 million pairs, 3.4 million triples in 4.2 million tokens). Words are hashed to 64 bits. Each task counts the pairs of its own rows, so only distinct pairs
leave it. They are dealt by the leading bits of the first word's hash; the followers of frequent
words (known from a sample, which decides on nothing else) are dealt by the hash of the pair, so
no task holds them all. A second deal by word adds up what contexts and predecessors contribute.
What is gathered grows with the distinct pairs of the corpus:

    pairs   hash of the pair, count
    words   hash of the word, its count, followers seen once, twice, more often, its distinct predecessors

Each is a sorted array of hashes with arrays of values behind it, one file per bucket in the shared
folder. Scoring tasks map these files into memory and look up the distinct hashes of some texts
at a time; files that cannot be mapped are read through the file system instead. The driver sees
file names and sums, a few numbers per bucket.

    p(w | v) = (c(v w) - D(c)) / c(v) + (D1 n1(v) + D2 n2(v) + D3 n3(v)) / c(v) * q(w)
    q(w)     = (N(. w) - d(N)) / N(. .) + d-mass / N(. .) / (V + 1)

D and d come from the counts of counts of the whole table, as modified smoothing takes them. A text is
preceded by a start that is no word and closed by an end that is counted as a token.

Null and empty texts are the end alone. A training set without rows gives the uniform model over the
end and one unknown word. Repeated rows count each time. Other columns are ignored.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.arrays import leading_bits, load, save
from tidemark.session import work_folder

START = np.uint64(0x57A2757A2757A275)
# A task counts this many tokens before it sends what it has; scoring looks up this many at a time.
HELD_TOKENS, SCORED_TOKENS = 4_000_000, 500_000
# Bytes of text that share a bucket; a word with more than 1 / `SHARES` of a bucket's pairs is spread over all.
BUCKET_BYTES, SHARES = 8 << 20, 16
SAMPLED = 64
PAIR, WORD = 0, 1
# Columns of a block or file of each kind.
COLUMNS = {
    PAIR: [("pair", np.uint64), ("n", np.uint32)],
    WORD: [("word", np.uint64), ("n", np.uint64), ("n1", np.uint32), ("n2", np.uint32), ("n3", np.uint32), ("before", np.uint32)],
}
COUNTED = [("first", np.uint64), ("second", np.uint64), ("n", np.uint32)]
BLOCK = "kind int, bucket int, data array<binary>, path string, sums array<long>"
_BLOCK = pa.schema(
    [("kind", pa.int32()), ("bucket", pa.int32()), ("data", pa.list_(pa.binary())), ("path", pa.string()), ("sums", pa.list_(pa.int64()))]
)


def sequence(text):
    """Hashes of the words of a text with the start before and the end behind."""
    return np.concatenate(([START], W.text_words(text), [W.END]))


def pair_bucket(first, pairs, frequent, buckets):
    """Bucket of each pair: by its first word, or by itself if that is frequent."""
    return leading_bits(np.where(np.isin(first, frequent), pairs, first), buckets)


def summed(key, values):
    """Sorted distinct keys and the sums of each array of values."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return key[starts], [np.add.reduceat(v[order], starts) if len(starts) else v[:0] for v in values]


def blocks(kind, bucket, columns):
    """Rows of BLOCK, one per bucket; the columns are put in the order of buckets."""
    order = np.argsort(bucket, kind="stable")
    columns = [c[order] for c in columns]
    values, starts = np.unique(bucket[order], return_index=True)
    for b, start, end in zip(values, starts, [*starts[1:], len(order)]):
        yield {"kind": kind, "bucket": int(b), "data": [c[start:end].tobytes() for c in columns], "path": None, "sums": None}


def _send(rows):
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(map(len, row["data"] or []))
        if size > 8 << 20:
            yield pa.RecordBatch.from_pylist(held, _BLOCK)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, _BLOCK)


def _counter(frequent, buckets):
    """Pairs of the rows of a task, counted, as blocks by bucket."""

    def flush(parts):
        first = np.concatenate([p[:-1] for p in parts])
        second = np.concatenate([p[1:] for p in parts])
        order = np.lexsort((second, first))
        first, second = first[order], second[order]
        starts = np.flatnonzero(np.concatenate(([True], (first[1:] != first[:-1]) | (second[1:] != second[:-1]))))
        n = np.diff(np.append(starts, len(first))).astype(np.uint32)
        first, second = first[starts], second[starts]
        return _send(blocks(PAIR, pair_bucket(first, W.chain(first, second), frequent, buckets), [first, second, n]))

    def count(batches):
        parts, held = [], 0
        for batch in batches:
            for text in batch.column(0):
                parts.append(sequence(text.as_py()))
                held += len(parts[-1])
                if held >= HELD_TOKENS:
                    yield from flush(parts)
                    parts, held = [], 0
        if parts:
            yield from flush(parts)

    return count


def _groups(batches):
    """(kind, bucket, rows) from batches sorted by these."""
    key, group = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if (row["kind"], row["bucket"]) != key and group:
                yield *key, group
                group = []
            key = row["kind"], row["bucket"]
            group.append(row)
    if group:
        yield *key, group


def _columns(group, fields):
    return [np.concatenate([np.frombuffer(row["data"][i], t) for row in group]) for i, (_, t) in enumerate(fields)]


def _written(folder, kind, bucket, arrays, sums):
    """Row that names a new file with the arrays, each padded to 8 bytes."""
    name = f"{'pairs' if kind == PAIR else 'words'}-{bucket}"
    path = save(folder, name, [array.astype(kind_of) for (_, kind_of), array in zip(COLUMNS[kind], arrays)])
    return {"kind": kind, "bucket": bucket, "data": None, "path": path, "sums": [len(arrays[0]), *map(int, sums)]}


def _pair_merger(folder, buckets):
    """Write the pairs of each bucket; send on the file's row and what the pairs add to their words."""

    def merge(batches):
        for _, bucket, group in _groups(batches):
            first, second, n = _columns(group, COUNTED)
            pair = W.chain(first, second)
            order = np.argsort(pair, kind="stable")
            pair = pair[order]
            starts = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
            n = np.add.reduceat(n[order].astype(np.uint64), starts)
            pair, first, second = pair[starts], first[order][starts], second[order][starts]
            sums = [(n == i).sum() for i in (1, 2, 3, 4)]
            rows = [_written(folder, PAIR, bucket, [pair, n], sums)]
            one = np.ones(len(n), np.uint64)
            zero = 0 * one
            context, parts = summed(first, [n, one * (n == 1), one * (n == 2), one * (n > 2)])
            word, (before,) = summed(second, [one])
            # The end is no context: its count is that of the starts.
            starts_here = parts[0][context == START]
            if len(starts_here):
                context = np.append(context, W.END)
                parts = [np.append(p, v) for p, v in zip(parts, (starts_here[0], 0, 0, 0))]
            key = np.concatenate([context, word])
            zeros = zero[: len(word)]
            values = [*[np.concatenate([p, zeros]) for p in parts], np.concatenate([np.zeros(len(context), np.uint64), before])]
            key, values = summed(key, [v.astype(np.uint64) for v in values])
            typed = [v.astype(t) for v, (_, t) in zip([key, *values], COLUMNS[WORD])]
            yield from _send(rows + list(blocks(WORD, leading_bits(key, buckets), typed)))

    return merge


def _word_merger(folder):
    """Write the words of each bucket; pass the rows of pair files on."""

    def merge(batches):
        for kind, bucket, group in _groups(batches):
            if kind == PAIR:
                yield from _send(group)
                continue
            columns = _columns(group, COLUMNS[WORD])
            word, values = summed(columns[0], [v.astype(np.uint64) for v in columns[1:]])
            n, before, real = values[0], values[4], word != START
            sums = [n[real].sum(), (real & (n > 0)).sum(), *[(before == i).sum() for i in (1, 2, 3, 4)], (before > 2).sum()]
            yield from _send([_written(folder, WORD, bucket, [word, *values], sums)])

    return merge


def discounts(counts):
    """D1, D2, D3+ from the counts of counts 1 to 4; one half where these do not allow an estimate."""
    n1, n2, n3, n4 = map(float, counts)
    if not (n1 and n2 and n3):
        return [0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.05), i + 0.95) for i, d in enumerate(found)]


class Model:
    """Files and sums of a trained model; a few numbers per bucket, so it travels with functions."""

    def __init__(self, listing, frequent, buckets):
        self.frequent, self.buckets = np.array(sorted(frequent), np.uint64), buckets
        self.paths = {(row.kind, row.bucket): (row.path, row.sums[0]) for row in listing}
        total = lambda kind, i: sum(row.sums[i] for row in listing if row.kind == kind)
        self.pairs = total(PAIR, 0)
        self.pair_discounts = discounts([total(PAIR, i) for i in (1, 2, 3, 4)])
        self.tokens, self.vocabulary = total(WORD, 1), total(WORD, 2)
        counts = [total(WORD, i) for i in (3, 4, 5, 6)]
        self.word_discounts = discounts(counts)
        kinds = [counts[0], counts[1], total(WORD, 7)]
        self.word_rest = sum(d * k for d, k in zip(self.word_discounts, kinds)) / self.pairs if self.pairs else 1.0

    def look_up(self, kind, bucket, hashes):
        """Columns of values of each hash, 0 where it is not found."""
        fields = COLUMNS[kind]
        found = [np.zeros(len(hashes), np.float64) for _ in fields[1:]]
        order = np.lexsort((hashes, bucket))
        values, starts = np.unique(bucket[order], return_index=True)
        for b, start, end in zip(values, starts, [*starts[1:], len(order)]):
            if (kind, int(b)) not in self.paths:
                continue
            at = order[start:end]
            path, rows = self.paths[kind, int(b)]
            columns = load(path, tuple(t for _, t in fields), rows)
            place = np.minimum(np.searchsorted(columns[0], hashes[at]), len(columns[0]) - 1)
            hit = columns[0][place] == hashes[at]
            for out, column in zip(found, columns[1:]):
                out[at[hit]] = column[place[hit]]
        return found

    def score(self, sequences):
        """Per sequence: tokens, known tokens, base score, score (both log10)."""
        ends = np.cumsum([len(s) - 1 for s in sequences])
        first = np.concatenate([s[:-1] for s in sequences])
        second = np.concatenate([s[1:] for s in sequences])
        words, place = np.unique(np.concatenate([first, second]), return_inverse=True)
        n, n1, n2, n3, before = self.look_up(WORD, leading_bits(words, self.buckets), words)
        v, w = place[: len(first)], place[len(first) :]
        pair, pair_place = np.unique(W.chain(first, second), return_inverse=True)
        some = np.zeros(len(pair), np.int64)
        some[pair_place] = np.arange(len(first))
        bucket = pair_bucket(first[some], pair, self.frequent, self.buckets)
        (count,) = self.look_up(PAIR, bucket, pair)
        count = count[pair_place]

        cut = lambda c, d: np.where(c > 0, c - np.array([0.0, *d])[np.minimum(c, 3).astype(int)], 0.0)
        lower = (self.word_rest / (self.vocabulary + 1) + cut(before, self.word_discounts) / max(1, self.pairs))[w]
        d1, d2, d3 = self.pair_discounts
        seen = n[v] > 0
        rest = d1 * n1[v] + d2 * n2[v] + d3 * n3[v]
        p = np.where(seen, (cut(count, self.pair_discounts) + rest * lower) / np.where(seen, n[v], 1.0), lower)
        base = np.log10((n[w] + 0.1) / (self.tokens + 0.1 * (self.vocabulary + 1)))
        starts = np.concatenate(([0], ends[:-1]))
        add = lambda x: np.add.reduceat(x, starts)
        return np.diff(np.append(starts, ends[-1])), add((n[w] > 0).astype(np.int64)), add(base), add(np.log10(p))


def frequent_words(texts, buckets):
    """Words that hold more than 1 / `SHARES` of a bucket's share of a sample: at most `SHARES` * buckets."""

    def count(batches):
        for batch in batches:
            found = [sequence(text.as_py())[:-1] for text in batch.column(0)]
            if found:
                words, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_pydict({"word": words.view(np.int64), "n": n.astype(np.int64)})

    sample = texts.filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLED)) == 0)
    counts = sample.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    path = work_folder(texts.sparkSession, "sampled-words")
    counts.write.parquet(path)
    counts = texts.sparkSession.read.parquet(path)
    total = counts.agg(F.sum("n")).first()[0] or 0
    rows = counts.filter(F.col("n") * SHARES * buckets > total).select("word").collect()
    return np.array([row.word for row in rows], np.int64).view(np.uint64)


def train(texts, text_col="text"):
    """Model of all rows of a frame of texts."""
    spark = texts.sparkSession
    texts = texts.select(F.col(text_col).alias("text"))
    buckets = 1
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    while buckets * BUCKET_BYTES < size:
        buckets *= 2
    frequent = frequent_words(texts, buckets)
    folder, listing = work_folder(spark, "pair-model"), work_folder(spark, "pair-model-files")
    counted = texts.mapInArrow(_counter(frequent, buckets), BLOCK)
    # By number, not by its hash: no two buckets share a task.
    pairs = counted.repartitionById(buckets, "bucket").sortWithinPartitions("kind", "bucket").mapInArrow(_pair_merger(folder, buckets), BLOCK)
    files = pairs.repartitionById(buckets, "bucket").sortWithinPartitions("kind", "bucket").mapInArrow(_word_merger(folder), BLOCK)
    files.select("kind", "bucket", "path", "sums").write.parquet(listing)
    return Model(spark.read.parquet(listing).collect(), frequent.tolist(), buckets)


SCORES = "struct<n_tokens:bigint,n_known:bigint,base_score:double,score:double>"


def scorer(model):
    """Function of a text column that gives its scores."""

    @F.arrow_udf(SCORES)
    def score(texts: pa.Array) -> pa.Array:
        results, held, size = [], [], 0
        for text in texts:
            held.append(sequence(text.as_py()))
            size += len(held[-1])
            if size >= SCORED_TOKENS:
                results.append(model.score(held))
                held, size = [], 0
        if held:
            results.append(model.score(held))
        names = ["n_tokens", "n_known", "base_score", "score"]
        types = [np.int64, np.int64, np.float64, np.float64]
        columns = [np.concatenate([r[i] for r in results]).astype(t) if results else np.zeros(0, t) for i, t in enumerate(types)]
        return pa.StructArray.from_arrays([pa.array(c) for c in columns], names)

    return score


def perplexity(score, n_tokens):
    """Perplexity of a text from its score and tokens, as columns or numbers."""
    return math.e ** (-score * math.log(10) / n_tokens) if isinstance(score, float) else F.pow(F.lit(10.0), -score / n_tokens)
