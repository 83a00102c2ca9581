import hashlib
import random
from zlib import crc32

import pytest
from helpers import AWKWARD, docs

from tidemark.llm import periodic_runs as R
from tidemark.llm import registry


def plain(words, least=24, times=3):
    """All runs by walking every diagonal."""
    found = []
    for q in range(1, len(words) // times + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, times * q):
                if not any(words[i : i + length - r] == words[i + r : i + length] for r in range(1, q)):
                    found.append((i, length, q))
            i = j + 1 if j == i else j
    return sorted(found, key=lambda r: (r[0], r[2]))


def periodic(random, kinds):
    """Words with repeated stretches, some of them repeated inside."""
    word = lambda: str(random.randrange(kinds))
    words = [word() for _ in range(random.randrange(40))]
    for _ in range(random.randrange(4)):
        part = [word() for _ in range(random.randrange(1, 40))]
        if random.random() < 0.3:
            part = part * 2 + part[:3]
        words += (part * random.randrange(1, 8))[: random.randrange(1, 200)]
    return words


@pytest.mark.parametrize("kinds", [1, 2, 3, 5])
def test_runs_match_plain_diagonals(kinds):
    source, total = random.Random(kinds), 0
    for _ in range(250):
        words = periodic(source, kinds)
        expected = plain(words)
        assert (R.find_runs(R.numbered(words)) if words else []) == expected
        total += len(expected)
    assert total > 20


@pytest.mark.parametrize("least, times", [(1, 3), (10, 4), (40, 5)])
def test_other_bounds(least, times):
    source = random.Random(least)
    for _ in range(150):
        words = periodic(source, 2)
        if words:
            assert R.find_runs(R.numbered(words), least, times) == plain(words, least, times)


def test_fewer_than_three_periods_are_refused():
    with pytest.raises(ValueError):
        list(R.seed_classes(100, times=2))


def test_long_texts_take_one_extension_per_run():
    calls, real = [], R.reach

    def counted(*args):
        calls.append(args)
        return real(*args)

    R.reach = counted
    try:
        assert R.find_runs(R.numbered(["a"] * 100_000)) == [(0, 100_000, 1)]
        line = [str(i) for i in range(999)]
        assert R.find_runs(R.numbered(line * 60 + ["end"])) == [(0, 59_940, 999)]
    finally:
        R.reach = real
    assert len(calls) <= 8


def digests(key, text):
    """A row of the query, by plain code."""
    words = (text or "").encode().split()
    h = crc32(str(key).encode())
    if key is not None and h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        words = [words[i] if i < a else words[a + (i - a) % (1 + (n - a) // (3 + g % 8))] for i in range(n)]
    runs = plain(words)
    keep = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in runs)]
    sha = lambda data: hashlib.sha256(data).hexdigest()
    listed = sha("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode())
    best = (None,) * 4
    for s, m, q in runs:
        if best[0] is None or m * best[2] > best[1] * q:
            best = s, m, q, 1000 * m // q
    return key, len(runs), *best, listed, sha(b" ".join(keep))


def test_query_on_awkward_rows(spark, monkeypatch):
    source = random.Random(9)
    rows = AWKWARD + [(2**60 + i, " ".join(periodic(source, 3)) + "\t  Ä") for i in range(60)]
    rows += [(i, " ".join(f"w{j}" for j in range(200 + i))) for i in range(100, 160)]
    assert sum(key is not None and crc32(str(key).encode()) % 10 == 0 for key, _ in rows) > 5
    table = docs(spark, rows, extra=["runs", "r", "collapsed", "start", "period"])
    monkeypatch.setattr(registry, "table", lambda *_: table)
    found = registry.QUERIES["op11_run_seeds"](spark, "")
    assert [t for _, t in found.dtypes] == ["bigint"] * 6 + ["string"] * 2
    text = lambda rows: sorted(map(str, rows))
    assert text(tuple(r) for r in found.collect()) == text(digests(key, t) for key, t in rows)


def test_empty_table_and_plain_texts(spark):
    find = R.run_finder()
    assert docs(spark, []).select(find("text")).collect() == []
    row = docs(spark, [(1, "so " * 30)]).select(find("text").alias("r")).collect()[0].r
    assert (row.n_words, [tuple(x) for x in row.runs], row.collapsed) == (30, [(0, 30, 1)], "so")
