"""What the plans must look like to hold on large tables."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark import plans
from tidemark.operators import top_n_per_group
from tidemark.registry import operators, pipelines
from tidemark.sources import videos, write_table

FOLDER = "/root/testdata/sf0.001"


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    return write_table(plans.normalize_videos(videos(spark, FOLDER)), str(tmp_path_factory.mktemp("t") / "videos"))


@pytest.mark.parametrize("name", pipelines.QUERIES)
def test_no_python_and_no_pair_joins(spark, name):
    plan = physical(entry.queries()[name](spark, FOLDER))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "SinglePartition"):
        assert node not in plan, node


def schemas_read(plan):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<(.*?)>", plan)]


def test_scans_are_pruned(table):
    trending = schemas_read(physical(plans.top_trending_videos(table)))
    assert {"video_id", "date"} in trending
    assert {"video_id", "title", "description"} in trending
    assert schemas_read(physical(plans.top_trending_channels(table)))[0] == {"video_id", "channel_title"}
    assert schemas_read(physical(plans.top_tags_monthly(table)))[0] == {"video_id", "tags", "date"}
    assert schemas_read(physical(plans.row_count(table))) == [set()]


def test_leading_videos_are_found_once(spark, table):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = physical(plans.top_trending_videos(table))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("partial_count(date") == 1
    assert len(schemas_read(plan)) == 3


def test_view_filter_reaches_the_scan(table, titles):
    assert "GreaterThan(views,100000)" in physical(plans.top_category_videos(table, titles))


def test_rankings_are_cut_before_the_shuffle(table, titles):
    for frame in (plans.top_tags_monthly(table), plans.top_week_categories(table, titles)):
        assert "WindowGroupLimit" in physical(frame)
    assert physical(plans.top_category_videos(table, titles)).count("WindowGroupLimit") == 4


def test_periods_spread_without_another_shuffle_of_the_spread_rows(table):
    plan = physical(plans.period_tag_counts(table))
    above = plan[: plan.index("Generate explode(sequence")]
    assert "Exchange" not in above


def test_sizes_decide_on_the_dimension_join(spark, table, titles):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")
        assert "SortMergeJoin" in physical(plans.top_week_categories(table, titles))
    finally:
        spark.conf.set(key, before)


def test_best_snapshots_are_hash_aggregated(table):
    plan = physical(plans.top_channels(table))
    assert "HashAggregate" in plan and "Sort" not in plan.replace("orderBy", "")


def test_texts_of_other_videos_are_not_aggregated(spark, table):
    plan = physical(plans.top_trending_channel_videos(table))
    texts = re.search(r"keys=\[video_id#\d+, title#\d+, description#\d+, channels#\d+\], functions=\[partial_count", plan)
    assert texts.start() < plan.index("Join")
    totals = physical(plans.top_trending_channels(table))
    assert len(schemas_read(totals)) == 1


def test_members_of_trending_channels_are_found_and_joined_once(table):
    plan = physical(plans.top_trending_channel_videos(table))
    assert plan.count("Generate explode(channels") == 1 and "LeftSemi" not in plan
    reads = [columns for columns in schemas_read(plan) if "title" in columns]
    assert reads == [{"video_id", "title", "description"}] and len(schemas_read(plan)) == 3


def test_large_rankings_are_cut_before_the_shuffle(spark, table):
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "1000000")
    try:
        assert "WindowGroupLimit" in physical(plans.top_tags_monthly(table, n=5000))
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("n", [10, 1000, 5000])
def test_rankings_need_no_session_setting(spark, n):
    """Few rows are cut before the shuffle; more are ranked within slices of a group first."""
    rows = spark.range(1000).selectExpr("id % 3 AS key", "id AS value")
    plan = physical(top_n_per_group(rows, ["key"], ["value"], n, rank="rank"))
    assert ("WindowGroupLimit" in plan) == (n < 1000)
    assert plan.count("Exchange hashpartitioning(key") == (1 if n < 1000 else 2)
    assert ("_slice" in plan) == (n >= 1000)


def test_best_snapshots_of_categories_are_hash_aggregated(table, titles):
    """Nothing is sorted below the aggregate, and there is no aggregate by sort."""
    plan = physical(plans.top_category_videos(table, titles))
    below = plan[plan.rindex("HashAggregate(keys=[category_id") :].split("FileScan")[0]
    assert "SortAggregate" not in plan and "Sort [" not in below and "partial_max" in below


def test_hot_group_of_a_large_ranking_is_ranked_in_several_tasks(spark):
    rows = spark.range(0, 40_000, 1, 8).selectExpr("if(id % 10 < 9, 'hot', 'cold') AS key", "id AS value")
    hot = rows.where("key = 'hot'")
    part = F.pmod(F.xxhash64(F.spark_partition_id(), "key", "value"), F.lit(256))
    sizes = [r["count"] for r in hot.groupBy(part).count().collect()]
    assert len(sizes) == 256 and max(sizes) < 4 * 36_000 / 256
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = top_n_per_group(rows, ["key"], ["value"], 2000, rank="rank").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    expected = [("hot", r.value, i) for i, r in enumerate(hot.orderBy("value").limit(2000).collect(), 1)]
    assert sorted(tuple(r) for r in got if r.key == "hot") == expected
    assert sum(r.key == "cold" for r in got) == 2000


@pytest.mark.parametrize("dedupe", ["day", "period"])
def test_periods_are_spread_above_the_sums_only(table, dedupe):
    plan = physical(plans.period_tag_counts(table, dedupe))
    spread = plan.index("Generate explode(sequence")
    assert "HashAggregate" not in plan[:spread] and plan.count("explode(sequence") == 1
    assert "functions=[sum(change" in plan[spread:]


def test_rows_of_tags_that_never_win_are_not_shuffled_for_members(table):
    plan = physical(plans.top_tag_videos(table))
    semi = plan.index("LeftSemi")
    distinct = re.search(r"HashAggregate\(keys=\[video_id#\d+, tag#\d+, date#\d+\], functions=\[\]", plan)
    assert distinct.start() < semi and "BroadcastHashJoin" in plan[semi - 200 : semi + 20]


@pytest.mark.parametrize("dedupe", ["day", "period"])
def test_members_of_winning_tags_are_not_shuffled(table, dedupe):
    """The rows of the result are many times those of the table; they leave the join as they are."""
    plan = physical(plans.top_tag_videos(table, dedupe))
    above = plan[: plan.index("Join")]
    assert "Exchange" not in above and "Aggregate" not in above
    assert plan.index("Generate explode(sequence") > plan.index("Join")


def test_plain_numbers_meet_no_pattern(spark):
    """The plain cast comes first, and the patterns only run where it gives null."""
    plan = physical(plans.normalize_videos(videos(spark, FOLDER)).select("likes"))
    assert re.search(r"coalesce\((try_)?cast\([^()]+ as bigint\), (try_)?cast\(regexp_replace", plan)


def test_hot_key_of_the_chained_join_is_split(spark, monkeypatch):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    rows = spark.range(40000).selectExpr("if(id % 10 < 9, 'hot', cast(id as string)) AS video_id", "id AS views", "id % 97 AS likes")
    monkeypatch.setattr(operators, "typed_videos", lambda *_: rows.repartition(8))
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        frame = operators.join_using_left(spark, FOLDER)
        frame.collect()
        assert "skew=true" in physical(frame)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
