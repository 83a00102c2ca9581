"""Toxicity by compression distance: two zstandard dictionaries, one of toxic and one of ordinary text.

Training takes a bounded sample of labelled rows: at most `SAMPLE_ROWS` ids in the order of their hash, one
text of at most `SAMPLE_BYTES` bytes each, `SAMPLE_TOTAL` bytes in all. The sample is split.

On the first part the dictionaries are trained. Both begin with the same `BASE` bytes, which zstandard's own
trainer picks from windows of all texts, so that what both classes have costs the same in both. Behind these
comes the class part, from text that tells the classes apart: stretches of a class's texts whose byte grams
(`GRAMS` bytes) are in so many more of its texts than of the other class's that the G statistic exceeds twice the
logarithm of the number of grams tried. Stretches may be parts of words, words, or phrases, as they stand in the
texts, and the most frequent lie last, where zstandard reaches them cheapest. (Dictionaries that are trained on the
classes with nothing in common differ most in chance matches of ordinary words: their held-out recall was near 0.)

On the other part everything else is calibrated: the two thresholds of a window's difference are the 0.99 and
0.999 quantiles over ordinary windows, a logistic model on the largest and mean differences and on the windows beyond the
thresholds gives the score, and of the `SIZES` of the class part the one with the smallest loss stays.

Scoring compresses every window of a text with both dictionaries: `WINDOW` words, each window half a window after
the one before it, between two runs of bytes that both dictionaries know, since the format finds no match in
the last bytes of its input and stores inputs as they are that hardly shrink. Literals are stored as they are, so
the difference of the lengths counts matches alone.

Null and empty texts and texts without words have no windows: all their numbers are 0. Very long texts are scored whole. If
the sample lacks one of the classes, every score is the share of toxic rows. Labels are taken as the
largest per id; null ids and labels take no part in training. An id on several rows is sampled with one of its texts.
Repeated rows score alike. An empty table gives no rows; other columns are ignored.
"""

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import work_folder

SAMPLE_ROWS, SAMPLE_BYTES, SAMPLE_TOTAL = 4000, 32 << 10, 8 << 20
BASE, SIZES, GRAMS = 16 << 10, (128, 256, 512, 1024, 2048, 4096, 8192, 16384), (6, 8)
FEATURES = 7
WINDOW = 32
# Bytes of difference that count before calibration.
NEAR, FAR = 4.0, 8.0
HEAD, TAIL = b"0123456789abcdefghijklmnopqrstuv", b"ABCDEFGHIJKLMNOP"
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+").findall


def words_of(text):
    return _WORDS(text.encode("utf-8", "surrogatepass").lower()) if text else []


def framed(words):
    return b" " + b" ".join(words) + b" "


class Lengths:
    """Differences of compression lengths of windows; `window` is a number of words, or that and two thresholds."""

    def __init__(self, ordinary, toxic, window=WINDOW):
        # Fixed values of the search: matches of six bytes and more, literals as they are.
        search = zstandard.ZstdCompressionParameters(
            window_log=18,
            hash_log=17,
            chain_log=17,
            search_log=6,
            min_match=6,
            target_length=1,
            strategy=zstandard.STRATEGY_FAST,
            write_content_size=False,
            write_dict_id=False,
        )
        self.window, self.near, self.far = window if isinstance(window, (tuple, list)) else (window, NEAR, FAR)
        self.compress = []
        for parts in (ordinary, toxic):
            content = zstandard.ZstdCompressionDict(HEAD + b"".join(parts) + TAIL, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.compress.append(zstandard.ZstdCompressor(dict_data=content, compression_params=search).compress)

    def windows(self, words):
        """Windows that overlap by half."""
        step = max(1, self.window // 2)
        return [words[i : i + self.window] for i in range(0, max(1, len(words) - self.window + step), step)] if words else []

    def differences(self, text):
        """Bytes that the toxic dictionary saves over the ordinary one, per window of a text."""
        ordinary, toxic = self.compress
        windows = [HEAD + framed(w) + TAIL for w in self.windows(words_of(text))]
        return np.array([len(ordinary(w)) - len(toxic(w)) for w in windows], float)

    def of_text(self, text):
        return self.of_differences(self.differences(text))

    def of_differences(self, found):
        """Numbers on the differences of all windows of a text."""
        if not len(found):
            return (0.0,) * FEATURES
        top = np.sort(np.partition(found, -4)[-4:] if len(found) > 4 else found)
        near = found > self.near
        return (
            float(top[-1]),
            float(top[-2:].mean()),
            float(top.mean()),
            float(found.mean()),
            10 * float(near.mean()),
            float(np.log1p(near.sum())),
            float(np.log1p((found > self.far).sum())),
        )


def grams(text, size):
    """Numbers of all runs of `size` bytes (at most 8) of a text."""
    data = np.frombuffer(text, np.uint8).astype(np.uint64)
    out = np.zeros(max(0, len(data) - size + 1), np.uint64)
    for i in range(size if len(out) else 0):
        out = out << np.uint64(8) | data[i : i + len(out)]
    return out


def gram_texts(texts, size):
    """Distinct grams and the number of texts that hold each."""
    found = [np.unique(grams(text, size)) for text in texts]
    return np.unique(np.concatenate(found), return_counts=True)


def _times_log(x):
    return x * np.log(np.maximum(x, 1e-9))


def typical(mine, n, other, m):
    """Grams that are in more of `n` texts than of `m` other ones, by the G test over all grams."""
    keys, seen = mine[0], mine[1].astype(float)
    at = np.minimum(np.searchsorted(other[0], keys), len(other[0]) - 1)
    others = np.where(other[0][at] == keys, other[1][at], 0).astype(float)
    cells = _times_log(seen) + _times_log(others) + _times_log(n - seen) + _times_log(m - others)
    sums = _times_log(seen + others) + _times_log(n + m - seen - others) + _times_log(float(n)) + _times_log(float(m)) - _times_log(float(n + m))
    return keys[(seen / n > others / m) & (2 * (cells - sums) >= 2 * np.log(len(keys) + len(other[0])))]


def stretches(texts, told, size):
    """How often each stretch that told grams cover without a gap stands in the texts."""
    found = Counter()
    for text in texts if len(told) else ():
        codes = grams(text, size)
        if len(codes):
            hit = told[np.minimum(np.searchsorted(told, codes), len(told) - 1)] == codes
            edges = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).view(np.int8)))
            found.update(text[a : b + size - 1] for a, b in zip(edges[::2], edges[1::2]))
    return found


def class_parts(toxic, ordinary):
    """Repeated stretches that tell each class, those that save most first."""
    found = Counter(), Counter()
    for size in GRAMS:
        seen = [gram_texts(texts, size) for texts in (toxic, ordinary)]
        for i, texts in enumerate((toxic, ordinary)):
            told = typical(seen[i], len(texts), seen[1 - i], len((toxic, ordinary)[1 - i]))
            found[i].update(stretches(texts, told, size))
    out = []
    for counts in found:
        parts = []
        for part, times in sorted(counts.items(), key=lambda x: (-x[1] * (len(x[0]) - 3), x[0])):
            if times > 1 and sum(map(len, parts)) < max(SIZES) and not any(part in other for other in parts):
                parts.append(part)
        out.append(parts)
    return out


def cut(parts, size):
    """The first parts of at most `size` bytes in all, in reverse."""
    kept = np.cumsum([0, *map(len, parts)])[1:] <= size
    return [part for part, fits in zip(parts, kept) if fits][::-1]


def base_of(texts, window):
    """Content that zstandard's trainer picks from the windows of texts of words."""
    samples = [framed(words[i : i + window]) for words in texts for i in range(0, len(words), window)]
    try:
        return zstandard.train_dictionary(BASE, samples, k=64, d=8, f=20, accel=1, level=3).as_bytes()
    except zstandard.ZstdError:
        # Too little text to choose from: all of it.
        return b"".join(samples)[-BASE:]


def fit_logistic(x, y, ridge=1e-2, steps=50):
    """Weights (bias last) of a logistic model by Newton steps, and its mean loss."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-8:
            break
    p = np.clip(1 / (1 + np.exp(-np.clip(x @ w, -30, 30))), 1e-9, 1 - 1e-9)
    return w, -np.mean(np.where(y == 1, np.log(p), np.log(1 - p)))


def fit(texts, labels, sizes=SIZES, window=WINDOW):
    """Model (ordinary parts, toxic parts, weights, (window, thresholds)) from texts and 0/1 labels."""
    labels = np.array(labels, int)
    learn = np.arange(len(labels)) % 5 < 3
    check = ~learn
    if min(np.bincount(labels[learn], minlength=2)) == 0 or min(np.bincount(labels[check], minlength=2)) == 0:
        share = (labels.sum() + 0.5) / (len(labels) + 1)
        return [], [], [0.0] * FEATURES + [float(np.log(share / (1 - share)))], (window, NEAR, FAR)
    # Repeated texts count once.
    rows = list(dict.fromkeys((text, int(y)) for text, y, l in zip(texts, labels, learn) if l))
    by_class = [[words_of(text) for text, y in rows if y == label] for label in (1, 0)]
    base = base_of(by_class[1], window)
    toxic, ordinary = class_parts(*[[framed(words) for words in part] for part in by_class])
    checked, y = [text for text, c in zip(texts, check) if c], labels[check]
    best = None
    for size in sizes:
        parts = [base, *cut(ordinary, size)], [base, *cut(toxic, size)]
        found = [Lengths(*parts, window).differences(text) for text in checked]
        plain = [f for f, label in zip(found, y) if not label and len(f)] or [np.zeros(1)]
        near, far = np.quantile(np.concatenate(plain), [0.99, 0.999]).tolist()
        lengths = Lengths(*parts, (window, near, far))
        x = np.array([lengths.of_differences(f) for f in found])
        middle, spread = x.mean(axis=0), np.where(x.std(axis=0) > 1e-6, x.std(axis=0), 1.0)
        weights, loss = fit_logistic((x - middle) / spread, y)
        if best is None or loss < best[0]:
            slopes = weights[:-1] / spread
            best = loss, (*parts, [*slopes.tolist(), float(weights[-1] - slopes @ middle)], (window, near, far))
        if size >= max(sum(map(len, toxic)), sum(map(len, ordinary))):
            break
    return best[1]


def labelled_sample(
    docs, labels, id_col="doc_id", text_col="text", label_col="toxic", rows=SAMPLE_ROWS, most_bytes=SAMPLE_BYTES, total=SAMPLE_TOTAL
):
    """Texts and labels of at most `rows` labelled ids and `total` bytes, in the order of their ids.

    Ids come in the order of their hash, each with one of its texts of at most `most_bytes` bytes.
    """
    spark = docs.sparkSession
    label = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    label = label.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.octet_length("text") <= most_bytes)
    label = label.join(texts.select("id"), "id", "left_semi")
    chosen = label.orderBy(F.xxhash64("id"), "id").limit(rows)
    path = work_folder(spark, "sample-ids")
    chosen.write.parquet(path)
    chosen = spark.read.parquet(path)
    # At most `rows` ids. One text of each is left before the shuffle and after it.
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first")
    found = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(one, F.max("label").alias("label"))
    path = work_folder(spark, "sample")
    found.select("id", "first.text", "label").write.parquet(path)
    found = spark.read.parquet(path)
    size = F.sum(F.octet_length("text")).over(Window.orderBy(F.xxhash64("id"), "id"))
    fits = found.select("id", size.alias("size")).filter(F.col("size") <= total).select("id")
    kept = found.join(F.broadcast(fits), "id", "left_semi").collect()
    kept.sort(key=lambda row: (row.id, row.text))
    return [row.text for row in kept], [row.label for row in kept]


@lru_cache(maxsize=2)
def _worker(ordinary, toxic, window):
    return Lengths(ordinary, toxic, window)


def scorer(model):
    """Function of a text column that gives its score from 0 to 1."""
    ordinary, toxic, weights, window = tuple(model[0]), tuple(model[1]), np.array(model[2]), model[3]

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lengths = _worker(ordinary, toxic, window)
        for texts in batches:
            yield pd.Series(of_batch(lengths, texts))

    def of_batch(lengths, texts):
        x = np.array([lengths.of_text(text) for text in texts], float).reshape(-1, FEATURES)
        return 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))

    return score
