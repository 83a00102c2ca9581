import json
import subprocess
import sys

import pytest
from helpers import AWKWARD, SCHEMA, docs, words
from test_near_dup import plain
from test_wu_manber import plain as search

import corpus_pipeline as P
from tidemark.llm.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
BAD = ["vile", "wretch", "idiotic"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with planted cases: toxic, copies, benchmark passages, secrets, awkward rows."""
    path = tmp_path_factory.mktemp("tables")
    text = lambda i, n=60: " ".join(f"{w}{(i * 13 + k * 7) % 97}{w[::-1]}" for k, w in zip(range(n), ["ba", "ke", "li", "mo"] * n))
    item = "the quick brown fox jumps over the lazy dog near the old river bank"
    rows = [(i, text(i)) for i in range(100, 500)]
    rows += [(i, f"{text(i)} {BAD[i % 3]} {text(i + 1, 9)} {BAD[i // 3 % 3]}") for i in range(500, 600)]
    rows += [(700 + i, text(100)) for i in range(3)] + [(710, text(101) + " end")]
    rows += [(720, f"{text(720)} {item.upper()} {text(721)}")]
    rows += [(730 + i, f'{text(730 + i)} token = "{"0123456789abcdef" * 2}{i:08x}" {text(731)}') for i in range(9)]
    rows += [(800 + i, f"{text(800 + i)} {'123456789' * 2}{i} {text(801 + i)}") for i in range(9)]
    docs(spark, rows + AWKWARD).write.parquet(str(path / "documents.parquet"))
    labels = [(i, 1, int(500 <= i < 600)) for i in range(100, 600)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path)


def stages(spark, folder, tmp_path):
    frames, current = [], spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in P.STAGES:
        stage(spark, current, folder).write.parquet(str(tmp_path / name))
        current = spark.read.parquet(str(tmp_path / name))
        frames.append(current)
    return frames


def test_each_stage(spark, folder, tmp_path):
    start = spark.read.parquet(f"{folder}/documents.parquet").collect()
    frames = stages(spark, folder, tmp_path)
    assert all(f.columns == [c.split()[0] for c in SCHEMA.split(", ")] for f in frames[:-1])
    calm, unique, clean, masked, coded = [f.collect() for f in frames]
    assert {r.doc_id for r in start} - {r.doc_id for r in calm} == set(range(500, 600))

    single = [(r.doc_id, r.text) for r in calm if r.doc_id is not None]
    kept = sorted(k for k, (_, _, first) in plain(single, 5).items() if first)
    assert sorted(r.doc_id for r in unique if r.doc_id is not None) == kept
    assert sum(r.doc_id is None for r in unique) == 1
    assert not {700, 701, 702, 710, 7, 8} & set(kept)

    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert [r.doc_id for r in unique if search(r.text, benchmark)[2]] == [720]
    assert sorted(map(str, clean)) == sorted(str(r) for r in unique if r.doc_id != 720)

    before = {r.doc_id: r for r in clean}
    for r in masked:
        old = before[r.doc_id]
        if r.doc_id in range(730, 739):
            assert "[SECRET]" in r.text and "0123456789abcdef" not in r.text and r.n_chars == len(r.text)
        else:
            assert r == old
    assert len(masked) == len(clean) == len(coded) and all(r.round_trip for r in coded if "▁" not in (before[r.doc_id].text or ""))
    assert sorted(map(str, P.run(spark, folder).collect())) == sorted(map(str, coded))


def test_an_id_on_several_texts_is_judged_text_by_text(spark):
    line = " ".join(f"w{i}" for i in range(40))
    rows = [(1, line), (2, line), (2, "a text of its own that nothing else resembles at all"), (2, None), (3, line + " end")]
    rows += [(4, "twice the same row"), (4, "twice the same row"), (None, line), (5, "twice the same row")]
    found = P.drop_near_copies(spark, docs(spark, rows), "").collect()
    key = lambda r: (str(r[0]), str(r[1]))
    expected = [rows[0], rows[2], rows[3], rows[5], rows[7]]
    assert sorted(((r.doc_id, r.text) for r in found), key=key) == sorted(expected, key=key)


def test_empty_tables(spark, tmp_path):
    docs(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert P.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("name", QUERIES)
def test_queries_cover_their_tables(spark, name):
    df = QUERIES[name](spark, FOLDER)
    of = {"op1": "embeddings", "op2": "pages", "op7": "pages", "op12": "embeddings", "op13": "embeddings"}.get(name.split("_")[0], "documents")
    table = spark.read.parquet(f"{FOLDER}/{of}.parquet")
    if name.startswith("op1_"):
        assert df.count() == 10 * table.filter("vec_id % 100 = 0").count()
    elif name.startswith("op12_"):
        anchors = {r.vec_id for r in table.filter("vec_id % 100 = 0").collect()}
        assert {r.anchor_id for r in df.collect()} == anchors
    else:
        key = table.columns[0]
        assert sorted(r[0] for r in df.select(key).collect()) == sorted(r[0] for r in table.select(key).collect())


def test_entry_works_without_the_package():
    code = """
import sys, json
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "tidemark.llm" or name.startswith("tidemark.llm.") or name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=P.__file__.rsplit("/", 1)[0])
    queries, sql = json.loads(out.stdout)
    assert queries and not any(q.startswith("op") or q == "pipeline" for q in queries) and set(sql) <= set(queries)


def test_words_of_helper_agree():
    assert words("A b c\x0bd") == [b"a", "b c".encode(), b"d"]


def test_texts_are_not_shuffled_to_drop_copies(spark):
    """Not even where the dropped keys are too many to be broadcast."""
    key, rows = "spark.sql.autoBroadcastJoinThreshold", [(i, f"text {i}") for i in range(50)] + [(None, "no key")]
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        df = docs(spark, rows).withColumn("_key", P.F.col("doc_id"))
        left = P._without(df, df.filter("doc_id % 2 = 0").select("_key"))
        assert "Exchange" not in left._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.text for r in left.collect()) == sorted([f"text {i}" for i in range(1, 50, 2)] + ["no key"])
    finally:
        spark.conf.set(key, before)


def test_pieces_keep_one_worker_a_task(spark):
    """Encoding and decoding chained would keep two, each with a model."""
    frames = [P.encode_pieces(spark, docs(spark, [(1, "a text")]), ""), QUERIES["op9_pieces"](spark, FOLDER)]
    plans = [f._jdf.queryExecution().executedPlan().toString() for f in frames]
    assert [p.count("ArrowEvalPython") for p in plans] == [1, 1]
