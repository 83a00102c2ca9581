"""Periodic runs of words inside texts, by seeds and extension along diagonals.

A run is a stretch of consecutive words with smallest period q and at least `least` and at least
`times` * q words that no neighbouring word extends. On the diagonal of lag q (words i and i + q) it
shows as at least max(least - q, (times - 1) * q) matches in a row: the overlap that every run is sure to
have. Lags fall into classes, each with a seed length that no run of the class falls short of:

- the first seed length k is the smallest such overlap over all q, for lags up to k;
- the next one is (times - 1) * (k + 1), for lags beyond k up to itself, and so on: the classes grow
  geometrically, so their number is logarithmic in the words.

In each class all k-grams of the text are indexed by hash. Since k is at least the lag, a k-gram that lies
in a run of period q occurs next exactly q words later, so of all occurrence pairs of the text only
neighbouring ones are enumerated, n of them and never all pairs. A seed is extended to both
sides, word by word, and a table of the furthest covered word per lag suppresses seeds that an earlier
extension of the same lag has passed. The k-gram's next occurrence being q words away also shows
that no smaller period fits the run.

K-gram hashes have 64 bits; extensions compare the words themselves, so a collision could hide
a seed (chance about 2**-64 a pair) but never invent a run.

Null and empty texts and texts of white space have no words, no runs and an empty collapsed text. Texts
are worked on whole, one row at a time; repeated rows give equal results. Words count as equal if
their bytes are; nothing is lower-cased. Empty tables give empty results; other columns are not touched.
"""

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidemark.llm import words as W

LEAST, TIMES = 24, 3
RESULT = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def split_words(text):
    """Words of a text as bytes: runs outside space and U+0009 to U+000D."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def seed_classes(n, least=LEAST, times=TIMES):
    """Rows (seed length, lags beyond, lags up to) for a text of `n` words."""
    if times < 3:
        raise ValueError("runs of fewer than three periods have no such seeds")
    k, beyond = min(max(least - q, (times - 1) * q) for q in range(1, least + 1)), 0
    # A run of the class has at least `times` * (beyond + 1) words.
    while max(least, times * (beyond + 1)) <= n:
        yield k, beyond, k
        k, beyond = (times - 1) * (k + 1), k


class Grams:
    """Hashes of all k-grams of a text for growing k, from those of half the length."""

    def __init__(self, ids):
        self.hashes, self.size = W.mix(ids.astype(np.uint64) + np.uint64(1)), 1

    def of(self, k):
        while 2 * self.size <= k:
            self.hashes = W.chain(self.hashes[: -self.size], self.hashes[self.size :])
            self.size *= 2
        rest = k - self.size
        return W.chain(self.hashes[: len(self.hashes) - rest], self.hashes[rest:]) if rest else self.hashes


def seeds(hashes, beyond, up_to):
    """(lag, position) of k-grams that occur next within the lags of a class, sorted; None if no k-gram repeats."""
    order = np.argsort(hashes, kind="stable")
    same = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
    if not len(same):
        return None
    at = order[same]
    lag = order[same + 1] - at
    near = (lag > beyond) & (lag <= up_to)
    at, lag = at[near], lag[near]
    order = np.lexsort((at, lag))
    at, lag = at[order], lag[order]
    # A seed right behind another of its lag lies in what that one covers.
    first = np.ones(len(at), bool)
    first[1:] = (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + 1)
    return np.column_stack([lag[first], at[first]])


def reach(ids, at, lag, step):
    """First place from `at` on (or last one before it, for step -1) where the words `lag` apart differ."""
    size = 64
    while True:
        low, high = (at, min(at + size, len(ids) - lag)) if step > 0 else (max(at - size, 0), at)
        differ = np.flatnonzero(ids[low:high] != ids[low + lag : high + lag])
        if len(differ):
            return low + int(differ[0] if step > 0 else differ[-1])
        if high == len(ids) - lag if step > 0 else low == 0:
            return high if step > 0 else -1
        at, size = high if step > 0 else low, 2 * size


def find_runs(ids, least=LEAST, times=TIMES):
    """All runs (start, length, period) of an array of word numbers, by start, then period."""
    found, grams = [], Grams(ids)
    for k, beyond, up_to in seed_classes(len(ids), least, times):
        if k >= len(ids):
            break
        starts = seeds(grams.of(k), beyond, up_to)
        if starts is None:
            # Longer k-grams repeat only where shorter ones do.
            break
        covered = {}
        for lag, at in starts.tolist():
            if at < covered.get(lag, 0):
                continue
            end = covered[lag] = reach(ids, at, lag, 1)
            start = reach(ids, at, lag, -1) + 1
            if end - start + lag >= max(least, times * lag) and end > at:
                found.append((start, end - start + lag, lag))
    return sorted(found, key=lambda run: (run[0], run[2]))


def numbered(words):
    """Array with a number for each word, equal for equal words."""
    names = {}
    return np.array([names.setdefault(w, len(names)) for w in words], np.int64)


def collapse(words, runs):
    """The words without those that repeat a run's first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


def analyse(words, least=LEAST, times=TIMES):
    """(number of words, runs, collapsed text) of one text's words."""
    runs = find_runs(numbered(words), least, times) if len(words) >= least else []
    return len(words), runs, b" ".join(collapse(words, runs)).decode("utf-8", "surrogatepass")


def run_finder(least=LEAST, times=TIMES, rewrite=None):
    """Function of a text column (and a column of key texts, given `rewrite`) that gives `RESULT`.

    `rewrite` is a function of a row's key and words that gives the words to work on.
    """

    def table(rows):
        return pd.DataFrame(rows, columns=["n_words", "runs", "collapsed"])

    def result(words):
        n, runs, collapsed = analyse(words, least, times)
        return n, [{"start": s, "length": m, "period": q} for s, m, q in runs], collapsed

    if rewrite is None:

        @F.pandas_udf(RESULT)
        def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for texts in batches:
                yield table([result(split_words(text)) for text in texts])

        return find

    @F.pandas_udf(RESULT)
    def find_rewritten(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, keys in batches:
            yield table([result(rewrite(key, split_words(text))) for text, key in zip(texts, keys)])

    return find_rewritten


def strongest(runs):
    """Column of the run with the greatest exact length / period; ties to the smaller start, then period."""

    def better(best, run):
        left, right = run["length"] * best["period"], best["length"] * run["period"]
        return F.when(best.isNull() | (left > right), run).otherwise(best)

    # Runs come by start, then period, so the first of equals stays.
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    return F.aggregate(runs, none, better)


def looped(key, words):
    """Words with a periodic tail for one key in ten, as a fixed rule of the test tables demands.

    With h the CRC-32 of the key's decimal text and g = h // 10: if 10 divides h, each word from a = g mod n on
    becomes one of the p = 1 + (n - a) // (3 + g mod 8) words from there. Rows without key stay.
    """
    h = crc32(key.encode()) if key else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]
