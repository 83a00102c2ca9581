from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark import operators as O


def rows(frame):
    return Counter(tuple(r) for r in frame.collect())


def test_top_n_per_group(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", 9)], "k string, v int")
    got = O.top_n_per_group(frame, ["k"], [F.desc("v")], 2, rank="rank")
    assert rows(got) == Counter([("a", 3, 1), ("a", 2, 2), ("b", 9, 1)])
    assert dict(got.dtypes)["rank"] == "bigint"
    assert O.first_per_key(frame, ["k"], [F.desc("v")]).columns == ["k", "v"]


def test_top_n_hot_group_is_cut_before_the_shuffle(spark):
    frame = spark.range(3000).select((F.col("id") % 3 % 2).alias("k"), "id")
    top = O.top_n_per_group(frame, ["k"], [F.desc("id")], 5)
    assert {r.id for r in top.where("k = 0").collect()} == {2994, 2996, 2997, 2999, 2993}
    assert top._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


@pytest.mark.parametrize("k", [None, 0])
def test_top_k_without_limit(spark, k):
    assert O.top_k(spark.range(7), [F.desc("id")], k).count() == 7


def test_top_k_sorts_by_nested_and_dropped_columns(spark):
    frame = spark.range(10).select(F.struct("id").alias("doc"), (10 - F.col("id")).alias("w"))
    assert [r[0].id for r in O.top_k(frame, [F.desc("doc.id")], 2).select("doc").collect()] == [9, 8]
    assert [r[0].id for r in frame.select("doc").orderBy(F.desc("w")).limit(1).collect()] == [0]


def test_null_safe_join(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("z", 3)], "k string, v int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, w int")
    assert rows(O.null_safe_join(left, right, ["k"])) == Counter([("a", 1, 10), (None, 2, 20)])
    assert rows(O.null_safe_join(left, right, ["k"], "left"))[("z", 3, None)] == 1


def test_join_small_broadcasts_only_a_bounded_side(spark):
    def plan(n):
        joined = O.join_small(spark.range(100), spark.range(10).select("id", F.lit(1).alias("w")), ["id"], n)
        return joined._jdf.queryExecution().optimizedPlan().toString()

    assert "broadcast" in plan(10)
    assert "broadcast" not in plan(10**6)
    assert "broadcast" not in plan(None)


def test_with_name_keeps_unknown_and_null_keys(spark, titles):
    frame = spark.createDataFrame([("1",), ("29",), (None,)], "category_id string")
    got = O.with_name(frame, titles, "category_id")
    assert rows(got) == Counter([("1", "Film"), ("29", None), (None, None)])


def test_cumulative_gain(spark):
    frame = spark.createDataFrame(
        [("a", 100), ("a", 250), ("a", 400), ("b", 7), ("c", None), ("c", None), (None, 1), (None, 5)],
        "k string, v long",
    )
    assert rows(O.cumulative_gain(frame, ["k"], "v", "k")) == Counter([("a", 300), ("c", None)])


def test_explode_tags(spark):
    frame = spark.createDataFrame([(1, '"a"|"b"|"a"'), (2, ""), (3, None), (4, "[none]")], "i int, tags string")
    assert Counter(O.explode_tags(frame).select("i", "tag").collect()) == Counter(
        [(1, "a"), (1, "b"), (1, "a"), (2, ""), (4, "[none]")]
    )
    assert O.explode_tags(frame, distinct=True).where("i = 1").count() == 2


def test_explode_periods_and_weeks(spark):
    frame = spark.sql("SELECT date'2017-11-14' AS d UNION ALL SELECT CAST(NULL AS DATE)")
    got = sorted((str(r.start_date), str(r.end_date)) for r in O.explode_periods(frame, "d").collect())
    assert len(got) == 30
    assert got[0] == ("2017-10-15", "2017-11-14") and got[-1] == ("2017-11-13", "2017-12-13")
    week = O.with_week_bounds(frame.where("d IS NOT NULL"), "d").first()
    assert (str(week.start_date), str(week.end_date)) == ("2017-11-13", "2017-11-19")


def test_nest_small_groups_are_single_documents(spark):
    frame = spark.createDataFrame([("a", 2), ("a", 1), ("a", 2), ("b", None), (None, 5)], "k string, v int")
    got = {(r.k, r.part): r.vs for r in O.nest(frame, ["k"], F.col("v"), "vs").collect()}
    assert got == {("a", 0): [1, 2, 2], ("b", 0): [], (None, 0): [5]}


def test_nest_splits_a_hot_group_and_loses_nothing(spark):
    # One key holds most rows; within it one value holds a third of all rows as copies.
    hot = [("hot", 7)] * 1000 + [("hot", i) for i in range(1500)]
    cold = [(f"k{i % 100}", i) for i in range(500)]
    frame = spark.createDataFrame(hot + cold, "k string, v int")
    parts = O.nest(frame, ["k"], F.col("v"), "vs", max_items=100).collect()
    for key in {k for k, _ in hot + cold}:
        whole = sorted(v for k, v in hot + cold if k == key)
        pages = {r.part: r.vs for r in parts if r.k == key}
        assert pages == {p: whole[p * 100 : p * 100 + 100] for p in range(-(-len(whole) // 100))}


@pytest.mark.parametrize("n", [9, 10, 11, 20, 21])
def test_nest_pages_around_the_limit(spark, n):
    frame = spark.createDataFrame([("a", i) for i in range(n)] + [("a", None)], "k string, v int").repartition(5)
    pages = {r.part: r.vs for r in O.nest(frame, ["k"], F.col("v"), "vs", max_items=10).collect()}
    assert pages == {p: list(range(n))[p * 10 : p * 10 + 10] for p in range(-(-n // 10))}


def test_nest_pages_of_one_repeated_value(spark):
    frame = spark.createDataFrame([("a", 5, 400), ("a", 4, 3), ("a", 6, 2)], "k string, v int, n long")
    pages = {r.part: r.vs for r in O.nest(frame, ["k"], F.col("v"), "vs", copies="n", max_items=10).collect()}
    whole = [4] * 3 + [5] * 400 + [6] * 2
    assert pages == {p: whole[p * 10 : p * 10 + 10] for p in range(41)}


def test_nest_counts_copies(spark):
    frame = spark.createDataFrame([("a", "x", 250), ("a", "y", 1)], "k string, v string, n long")
    parts = O.nest(frame, ["k"], F.col("v"), "vs", copies="n", max_items=100).collect()
    assert Counter(v for r in parts for v in r.vs) == Counter({"x": 250, "y": 1})


def test_as_document(spark):
    frame = spark.createDataFrame([("a", 1, 0)], "k string, v int, part int")
    assert O.as_document(frame, "doc").dtypes == [("doc", "struct<k:string,v:int>"), ("part", "int")]
    assert O.as_document(frame.drop("part"), "doc", key="k").dtypes == [("doc", "struct<key:string>")]
