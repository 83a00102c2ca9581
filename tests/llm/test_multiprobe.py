import numpy as np
import pytest

from tidemark.llm import multiprobe as A


def table(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    return df.selectExpr("*", "'x' as id", "'y' as codes", "'z' as rank")


def plain(rows, asked, top=10):
    """query -> [(score, id)] by comparing with all."""
    sound = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and v and None not in v]
    sound = [(i, v) for i, v in sound if np.isfinite(v).all() and v.any()]
    out = {}
    for i, v in sound:
        if asked(i):
            best = {}
            for j, u in sound:
                if j != i and len(u) == len(v):
                    d = float(np.sqrt(((u - v) ** 2).sum()))
                    best[j] = min(d, best.get(j, d))
            merged = {**best, **{j: min(d, best.get(j, d)) for d, j in out.get(i, [])}}
            out[i] = sorted((d, j) for j, d in merged.items())[:top]
    return out


def found(df, condition, **options):
    rows = A.search(df, df.filter(condition), **options).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_and_exact_scores(spark):
    random = np.random.default_rng(1)
    x = random.standard_normal((1500, 24)).astype(np.float32)
    x[300:700] = x[0] + 0.01 * random.standard_normal((400, 24))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    got, want = found(table(spark, rows), "vec_id % 50 = 0"), plain(rows, lambda i: i % 50 == 0)
    hits = [len({j for _, j in got[q]} & {j for _, j in want[q]}) / 10 for q in want]
    assert np.mean(hits) >= 0.9
    for q, best in got.items():
        for score, j in best:
            assert score == pytest.approx(np.sqrt(((x[q].astype(float) - x[j].astype(float)) ** 2).sum()), abs=1e-12)
        assert best == sorted(best)


def test_all_buckets_give_exact_results(spark, monkeypatch):
    monkeypatch.setattr(A, "BLOCK_ROWS", 10)
    monkeypatch.setattr(A, "WHOLE_ROWS", 10)
    random = np.random.default_rng(2)
    x = np.round(random.standard_normal((150, 4)), 1)
    x[40:90] = [1, 2, 3, 4]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    got = found(table(spark, rows, "double"), "vec_id % 10 = 0", chance=0.99999, tables=4)
    want = plain(rows, lambda i: i % 10 == 0)
    assert {q: [j for _, j in b] for q, b in got.items()} == {q: [j for _, j in b] for q, b in want.items()}


def clustered(n=5000, dim=32):
    """Nine tenths of the rows in five tight clusters, the others apart; ids of both kinds are asked."""
    random = np.random.default_rng(8)
    x = random.standard_normal((n, dim))
    centres = random.standard_normal((5, dim)) * 3
    x[: n * 9 // 10] = centres[np.arange(n * 9 // 10) % 5] + 0.01 * x[: n * 9 // 10]
    return [(int(i), v.tolist(), 0) for i, v in zip(random.permutation(n), x.astype(np.float32))], n * 9 // 10


def test_every_query_gets_its_rows_where_clusters_are_tight(spark):
    rows, tight = clustered()
    got, asked = found(table(spark, rows), "vec_id % 50 = 0"), lambda i: i % 50 == 0
    x = np.array([v for _, v, _ in rows])
    ids = np.array([i for i, _, _ in rows])
    recall = {True: [], False: []}
    for at, (i, v, _) in enumerate(rows):
        if asked(i):
            d = np.sqrt(np.square(x - np.array(v)).sum(axis=1))
            order = [j for j in np.lexsort((ids, d)) if j != at][:10]
            assert len(got[i]) == 10
            recall[at < tight].append(len({int(ids[j]) for j in order} & {j for _, j in got[i]}) / 10)
    assert len(recall[False]) >= 5 and np.mean(recall[True] + recall[False]) >= 0.95
    assert np.mean(recall[False]) >= 0.9


@pytest.mark.parametrize("n", [3, 11, 400])
def test_small_tables_are_exact_with_the_parameters_of_the_query(spark, n):
    random = np.random.default_rng(n)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(random.standard_normal((n, 16)).astype(np.float32))]
    got, want = found(table(spark, rows), "vec_id % 2 = 0"), plain(rows, lambda i: i % 2 == 0)
    assert {q: [j for _, j in b] for q, b in got.items()} == {q: [j for _, j in b] for q, b in want.items()}


def test_comparison_in_blocks_is_exact(spark, monkeypatch):
    monkeypatch.setattr(A, "PIECE_ROWS", 40)
    monkeypatch.setattr(A, "ASKED_ROWS", 7)
    random = np.random.default_rng(9)
    x = np.round(random.standard_normal((300, 6)), 1)
    x[50:120] = x[50]
    rows = [(i % 280, v.tolist(), 0) for i, v in enumerate(x)]
    frame = A.usable(table(spark, rows, "double"), "vec_id", "embedding")
    best = A._best(A._compare_all(frame, frame.filter("id % 10 = 0"), 10), 10).collect()
    got = {}
    for r in sorted(best, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.id)
    assert got == {q: [j for _, j in b] for q, b in plain(rows, lambda i: i % 10 == 0).items()}


def test_awkward_rows(spark):
    rows = [
        (0, [1.0, 0.0], 0),
        (1, [1.0, 0.0], 0),
        (2, [0.0, 1.0], 0),
        (2, [1.0, 0.5], 0),
        (3, None, 0),
        (4, [], 0),
        (5, [0.0, 0.0], 0),
        (6, [float("nan"), 1.0], 0),
        (7, [float("inf"), 1.0], 0),
        (8, [None, 1.0], 0),
        (9, [1.0, 2.0, 3.0], 0),
        (None, [1.0, 0.0], 0),
    ]
    got = found(table(spark, rows), "true", chance=0.99999)
    assert got == {q: [(pytest.approx(d), j) for d, j in b] for q, b in plain(rows, lambda i: True).items() if b}
    assert 9 not in got and [j for _, j in got[0]] == [1, 2]


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0], 0)], [(0, None, 0)]])
def test_nothing_to_find(spark, rows):
    assert found(table(spark, rows), "true") == {}


def test_probes_come_in_order_of_chance():
    hashes = A.Projections(8, 5, 1, 2.0)
    place = hashes.places(0, np.full((1, 8), 0.3))[0]
    cells = hashes.probes(place, 1.0, 0.9)
    assert (cells[0] == hashes.cells(place[None])[0]).all() and len({tuple(c) for c in cells}) == len(cells)
    moved = place + np.random.default_rng(3).standard_normal((20000, 5))
    seen = {tuple(c) for c in cells}
    assert np.mean([tuple(c) in seen for c in hashes.cells(moved)]) == pytest.approx(0.9, abs=0.02)
