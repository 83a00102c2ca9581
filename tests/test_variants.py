import json

import pytest

from tidemark import plans, sources

DOCUMENTS = [
    {"kind": "k", "items": [{"id": "1", "snippet": {"title": "Film", "more": [1, 2]}}, {"id": 2, "extra": True}]},
    {"items": []},
    {"items": None},
    {"other": {"a": 1.5}},
    {"items": {"first": {"id": "3"}}},
]


@pytest.fixture
def folder(tmp_path):
    for i, document in enumerate(DOCUMENTS):
        (tmp_path / f"{i}.json").write_text(json.dumps(document, indent=2))
    return str(tmp_path)


def test_fields_are_found_by_reading(spark, folder):
    row = sources.found_schema(sources.read_documents(spark, folder)).first()
    assert row.n_documents == 5
    for part in ("kind: STRING", "other: OBJECT<a: DECIMAL(2,1)>", "items: VARIANT"):
        assert part in row.schema


def test_items_and_typed_fields(spark, folder):
    items = sources.explode_items(sources.read_documents(spark, folder), keep=["file"])
    fields = {"id": ("$.id", "string"), "number": ("$.id", "int"), "title": ("$.snippet.title", "string"), "extra": ("$.extra", "boolean")}
    rows = sources.item_fields(items, fields, keep=["position", "key"]).collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(
        map(str, [(0, None, "1", 1, "Film", None), (1, None, "2", 2, None, True), (0, "first", "3", 3, None, None)])
    )


def test_category_items_match_the_declared_schema(spark, tmp_path):
    for i in range(3):
        item = {"kind": "k", "etag": "e", "id": str(i), "snippet": {"channelId": "c", "title": f"t{i}", "assignable": True}}
        (tmp_path / f"{i}.json").write_text(json.dumps({"kind": "k", "etag": "e", "items": [item]}, indent=1))
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(sources.read_category_items(spark, str(tmp_path))) == key(sources.read_categories(spark, str(tmp_path)))


def test_texts_that_are_no_json(spark):
    frame = spark.createDataFrame([('{"a": 1}',), ("no json",), (None,), ("[1, 2]",)], "value string")
    found = sources.parse_documents(frame).selectExpr("document IS NULL AS bad").collect()
    assert [r.bad for r in found] == [False, True, True, False]
    assert sources.found_schema(sources.parse_documents(frame.limit(0))).first().n_documents == 0


def test_profile_is_taken_in_the_pass_that_writes(spark, tmp_path):
    rows = [(1, "b", 1.5, {"k": 1}), (None, "a", None, None), (3, None, -2.0, None)]
    frame = spark.createDataFrame(rows, "`a b` int, `x.y` string, z double, m map<string, int>")
    path = str(tmp_path / "t")
    found = {r.column: r for r in plans.write_profiled(frame, path).collect()}
    assert tuple(found["a b"]) == (0, "a b", "int", 3, 1, "1", "3")
    assert tuple(found["x.y"]) == (1, "x.y", "string", 3, 1, "a", "b")
    assert tuple(found["z"]) == (2, "z", "double", 3, 1, "-2.0", "1.5")
    assert tuple(found["m"]) == (3, "m", "map<string,int>", 3, 2, None, None)
    assert spark.read.parquet(path).count() == 3
    observed, _ = plans.observed(frame)
    assert "CollectMetrics" in observed._jdf.queryExecution().toString()
    assert "Exchange" not in observed._jdf.queryExecution().executedPlan().toString()


def test_profile_of_an_empty_frame(spark, tmp_path):
    found = plans.write_profiled(spark.createDataFrame([], "a int"), str(tmp_path / "t")).collect()
    assert [tuple(r) for r in found] == [(0, "a", "int", 0, 0, None, None)]
