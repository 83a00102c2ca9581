"""Hashed words of whole batches of texts, with numpy inside a task.

A word is a run of bytes outside white space (space and U+0009 to U+000D). Its hash is a
polynomial over random byte values modulo 2**64, then mixed. All hashes are the same on
every executor: they depend on fixed seeds only. Two different words of one corpus collide
with a chance of about 2**-64 a pair.
"""

import numpy as np

_RANDOM = np.random.Generator(np.random.PCG64(20240501))
_BYTE_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
END = np.uint64(0xE0D0E0D0E0D0E0D1)
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_POWERS = {}


def _powers(base, n):
    """First n powers of a number modulo 2**64; kept and grown as needed."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        known = _POWERS[base] = np.multiply.accumulate(steps)
    return known[:n]


def mix(x):
    """Spread every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def chain(left, right):
    """Hash of a sequence that goes on with one more word."""
    return mix(left * _BASE + right + np.uint64(1))


def text_words(text):
    """Hashes of the words of one text, A-Z lower-cased; none for null."""
    if not text:
        return np.empty(0, np.uint64)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    space = _SPACES[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * _powers(_BASE, len(data)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers(_INVERSE, len(data) + 1)[starts] + (ends - starts).astype(np.uint64))


def shingles(words, size):
    """Sorted distinct hashes of all runs of `size` words; fewer words make one run, none make none."""
    if not len(words):
        return words
    runs = max(1, len(words) - size + 1)
    width = min(size, len(words))
    codes = np.full(runs, width, np.uint64)
    for i in range(width):
        codes = chain(codes, words[i : i + runs])
    return np.unique(codes)
