"""Random tables with one hot video, channel and tag, against plain Python."""

import random
from datetime import date, timedelta

import brute
import pytest
from pyspark.sql import functions as F

from tidemark import plans

SCHEMA = """video_id string, title string, description string, channel_title string, category_id string,
    tags string, date date, views long, likes long, dislikes long"""


def make(seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(700):
        hot = rng.random() < 1 / 3
        video = "hot" if hot else f"v{rng.randrange(40):02d}"
        rows.append(
            {
                "video_id": video,
                "title": f"title {video} {rng.randrange(2)}",
                "description": rng.choice(["one", "two"]),
                "channel_title": "big" if hot else f"c{rng.randrange(25):02d}",
                "category_id": rng.choice("123"),
                "tags": "|".join(f'"{t}"' for t in ["common"] + rng.choices([f"t{i}" for i in range(30)], k=3)),
                "date": date(2018, 1, 1) + timedelta(days=rng.randrange(75)),
                "views": rng.randrange(50000, 200000),
                "likes": rng.randrange(50),
                "dislikes": rng.randrange(4),
            }
        )
    # A third again as exact copies of one row.
    return rows + [rows[0]] * 350


@pytest.fixture(scope="module", params=[1, 2])
def tables(request, spark):
    rows = make(request.param)
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).repartition(6)
    return rows, frame


def ordered(frame):
    return [tuple(r) for r in frame.collect()]


def test_top_trending_videos(tables):
    rows, frame = tables
    assert ordered(plans.top_trending_videos(frame)) == brute.top_trending(rows, 10)
    assert set(ordered(plans.top_trending_videos(frame, None))) == set(brute.top_trending(rows, None))
    top = {r[:3] for r in brute.top_trending(rows, 10)}
    expected = sum((r["video_id"], r["title"], r["description"]) in top for r in rows)
    assert plans.trending_days(frame).count() == expected


def test_top_week_categories(tables, titles):
    rows, frame = tables
    got = plans.top_week_categories(frame, titles)
    got = {(r.start_date, r.category_id, r.number_of_videos, r.total_views) for r in got.collect()}
    assert got == brute.week_categories(rows)
    videos = plans.top_week_category_videos(frame, titles)
    sums = videos.groupBy("start_date", "number_of_videos", "total_views").agg(
        F.count("*").alias("n"), F.sum("views_gained").alias("gain")
    )
    assert all(r.n == r.number_of_videos and r.gain == r.total_views for r in sums.collect())


@pytest.mark.parametrize("dedupe", ["day", "period"])
def test_top_tags_monthly(tables, dedupe):
    rows, frame = tables
    assert set(ordered(plans.top_tags_monthly(frame, dedupe))) == brute.tags(rows, dedupe)
    videos = plans.top_tag_videos(frame, dedupe).groupBy("end_date", "tag", "number_of_videos")
    sums = videos.agg(F.sum("days").alias("day"), F.count("*").alias("period"))
    assert all(r[dedupe] == r.number_of_videos for r in sums.collect())


def test_period_counts_never_exceed_day_counts(tables):
    _, frame = tables
    by_day = plans.period_tag_counts(frame, "day").withColumnRenamed("number_of_videos", "by_day")
    once = plans.period_tag_counts(frame, "period")
    both = by_day.join(once, ["tag", "end_date"], "full")
    assert both.where("by_day IS NULL OR number_of_videos IS NULL OR number_of_videos > by_day").count() == 0


def test_top_channels(tables):
    rows, frame = tables
    assert ordered(plans.top_channels(frame)) == brute.channels(rows, 20)
    sums = plans.top_channel_videos(frame).groupBy("channel_title", "total_views").agg(F.sum("views").alias("s"))
    assert sums.count() == 20 and all(r.s == r.total_views for r in sums.collect())


def test_top_trending_channels(tables):
    rows, frame = tables
    assert ordered(plans.top_trending_channels(frame)) == brute.trending_channels(rows, 10)
    videos = plans.top_trending_channel_videos(frame).groupBy("channel_name", "total_trending_days")
    assert all(r.s == r.total_trending_days for r in videos.agg(F.sum("trending_days").alias("s")).collect())


def test_top_category_videos(tables, titles):
    rows, frame = tables
    got = set(ordered(plans.top_category_videos(frame, titles).drop("category_name")))
    assert got == brute.category_videos(rows)
