import numpy as np
import pytest

from tidemark.llm import cross_polytope as C
from tidemark.llm import registry

INF, NAN = float("inf"), float("nan")


def table(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    return df.selectExpr("*", "'x' as id", "'y' as class", "'z' as name", "'w' as n")


def plain(rows, least=0.95):
    """Rows of the result by comparing all pairs."""
    sound = [i for i, (key, v, _) in enumerate(rows) if key is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    unit = {i: C.unit(np.array([rows[i][1]], float))[0] for i in sound}
    up, links = {i: i for i in sound}, dict.fromkeys(range(len(rows)), 0)

    def top(i):
        return i if up[i] == i else top(up[i])

    for i in sound:
        for j in sound:
            if i < j and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                links[i] += 1
                links[j] += 1
                a, b = sorted((top(i), top(j)), key=lambda k: (rows[k][0], k))
                up[b] = a
    component = {i: rows[top(i)][0] if i in up else rows[i][0] for i in range(len(rows))}
    return sorted(((rows[i][0], links[i], component[i], rows[i][0] == component[i]) for i in links), key=str)


def found(df, **options):
    return sorted((tuple(r) for r in C.near_duplicates(df, **options).collect()), key=str)


def families(seed, dim, n=600):
    """Vectors in tight, loose and copied groups, and vectors alone."""
    random = np.random.default_rng(seed)
    x = random.standard_normal((n, dim))
    x[100:160] = x[100] + 0.02 * random.standard_normal((60, dim))
    x[200:300] = x[200] + 0.16 * random.standard_normal((100, dim))
    x[300:340] = x[300]
    x[340:350] = 3 * x[300]
    return [(int(i) * 2 + 1, v.tolist(), 0) for i, v in zip(random.permutation(n), x.astype(np.float32))]


@pytest.mark.parametrize("dim", [8, 24, 64])
def test_links_match_all_pairs(spark, dim):
    rows = families(dim, dim)
    got = found(table(spark, rows))
    assert got == plain(rows)
    assert sum(r[1] for r in got) > 3000


def test_cuts_of_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(C, "CUT_ROWS", 16)
    monkeypatch.setattr(C, "CHUNK_PAIRS", 64)
    rows = families(5, 16, 400)
    assert found(table(spark, rows)) == plain(rows)


def test_several_rotations_per_bucket(spark):
    """A small mean size asks for two rotations a bucket, and so for more tables."""
    rows = families(6, 32, 500)
    assert C.functions_for(32, 500, mean_rows=2).k == 2
    got, expected = found(table(spark, rows), mean_rows=2, miss=1e-4), plain(rows)
    assert sum(r[1] for r in got) >= 0.999 * sum(r[1] for r in expected)
    assert [r[2] for r in got] == [r[2] for r in expected]


def test_awkward_rows(spark):
    rows = [
        (3, [1.0, 0.0], 0),
        (2, [2.0, 0.0], 0),
        (2, [2.0, 0.0], 0),
        (1, [0.0, 1.0], 0),
        (4, None, 0),
        (5, [], 0),
        (6, [0.0, -0.0], 0),
        (7, [NAN, 1.0], 0),
        (8, [INF, 1.0], 0),
        (9, [None, 1.0], 0),
        (10, [1.0, 0.0, 0.0], 0),
        (11, [1.0], 0),
        (12, [-1.0], 0),
        (13, [0.5], 0),
        (14, [-0.0, 7.0], 0),
        (None, [1.0, 0.0], 0),
        (None, [1.0, 0.0], 0),
    ]
    assert found(table(spark, rows)) == plain(rows)
    assert found(table(spark, rows, "double")) == plain(rows)
    huge = [(1, [1e300, 1e300], 0), (2, [1e-300, 1.1e-300], 0), (3, [-1e300, 1e300], 0)]
    assert found(table(spark, huge, "double")) == plain(huge)


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0], 0)], [(0, None, 0)]])
def test_small_tables(spark, rows):
    assert found(table(spark, rows)) == plain(rows)


def test_transform_keeps_lengths_and_visits_come_by_gap():
    x = C.unit(np.random.default_rng(1).standard_normal((50, 64)))
    assert np.allclose(C.hadamard(C.hadamard(x)), x) and np.allclose(np.square(C.hadamard(x)).sum(axis=1), 1)
    hashes = C.functions_for(64, 10_000)
    codes = hashes.codes(0, x)
    assert (codes[:, 0] != 0).all() and codes.shape[1] == 1 + C.PROBES
    # Visits stop somewhere, and do not start again.
    assert (np.diff((codes != 0).astype(int), axis=1) <= 0).all() and (codes == 0).any()


def test_links_at_the_threshold_are_missed_rarely():
    random = np.random.default_rng(2)
    x = C.unit(random.standard_normal((20_000, 64)))
    side = random.standard_normal(x.shape)
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * C.unit(side - (side * x).sum(axis=1, keepdims=True) * x)
    hashes = C.functions_for(64, 100_000)
    missed = np.ones(len(x), bool)
    for t in range(hashes.tables):
        missed &= ~C.meet(hashes.codes(t, x), hashes.codes(t, y))
    assert missed.mean() <= 3 * C.MISS


def test_query(spark, monkeypatch):
    rows = families(7, 64, 400)
    monkeypatch.setattr(registry, "table", lambda *_: table(spark, rows))
    result = registry.QUERIES["op13_cross_polytope"](spark, "")
    assert result.dtypes == [("vec_id", "bigint"), ("n_links", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
    assert sorted((tuple(r) for r in result.collect()), key=str) == plain(rows)
