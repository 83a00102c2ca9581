from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.plans import documents


@pytest.fixture
def frame(typed):
    return typed(
        *[
            {
                "video_id": f"v{i % 3}",
                "tags": '"a"|"b"' if i % 2 else '"a"',
                "trending_date": f"17.{13 + i % 5}.11",
                "views": str(100001 + i),
                "likes": str(i),
                "channel_title": f"c{i % 2}",
            }
            for i in range(12)
        ]
    )


def test_shapes(frame, titles):
    day = "struct<date:date,views:bigint,likes:bigint,dislikes:bigint>"
    tag = "struct<tag:string,number_of_videos:bigint,video_ids:array<string>>"
    video = "struct<video_id:string,video_title:string,ratio_likes_dislikes:double,views:bigint>"
    expected = {
        "video": (
            documents.video_documents(frame),
            "id:string,title:string,description:string,latestViews:bigint,latestLikes:bigint,"
            f"latestDislikes:bigint,trendingDays:array<{day}>",
        ),
        "weeks": (
            documents.week_documents(frame, titles),
            "start_date:date,end_date:date,category_id:string,category_name:string,"
            "number_of_videos:bigint,total_views:bigint,video_ids:array<string>",
        ),
        "month": (
            documents.month_documents(frame),
            f"start_date:date,end_date:date,tags:array<{tag}>",
        ),
        "channel": (
            documents.channel_documents(frame),
            "channel_title:string,start_date:date,end_date:date,total_views:bigint,"
            "video_views:array<struct<video_id:string,views:bigint>>",
        ),
        "category": (
            documents.category_documents(frame, titles),
            f"category_id:string,category_name:string,videos:array<{video}>",
        ),
    }
    for name, (docs, fields) in expected.items():
        assert dict(docs.dtypes)[name] == f"struct<{fields}>", name
    trending = documents.trending_channel_documents(frame)
    assert dict(trending.dtypes)["channel"] == (
        "struct<channel_name:string,total_trending_days:bigint,"
        "videos_days:array<struct<video_id:string,video_title:string,trending_days:bigint>>>"
    )


def test_video_document_holds_every_snapshot_in_order(frame):
    docs = [r.video for r in documents.video_documents(frame).collect()]
    assert sorted(d.id for d in docs) == ["v0", "v1", "v2"]
    for d in docs:
        assert len(d.trendingDays) == 4
        assert [t.date for t in d.trendingDays] == sorted(t.date for t in d.trendingDays)
    assert documents.video_documents(frame, limit=1).count() == 1


def test_month_document_repeats_ids_per_day_only(frame):
    wanted = F.col("month.end_date") == date(2017, 11, 17)
    for dedupe in ("day", "period"):
        (row,) = documents.month_documents(frame, dedupe).where(wanted).collect()
        for tag in row.month.tags:
            assert len(tag.video_ids) == tag.number_of_videos
    assert [t.tag for t in row.month.tags] == ["a", "b"]
    assert row.month.tags[0].video_ids == ["v0", "v1", "v2"]


def test_large_documents_continue_in_parts(frame):
    whole = documents.video_documents(frame)
    parts = documents.video_documents(frame, max_items=2)
    assert parts.count() > whole.count()

    def days(docs):
        rows = docs.select("video.id", F.explode("video.trendingDays").alias("t")).select("id", "t.*")
        return Counter(tuple(r) for r in rows.collect())

    assert days(parts) == days(whole)
    months = documents.month_documents(frame, max_items=2)
    ids = months.select("month.end_date", F.explode("month.tags").alias("t")).select(
        "end_date", "t.tag", F.explode("t.video_ids").alias("id")
    )
    plain = documents.month_documents(frame).select("month.end_date", F.explode("month.tags").alias("t"))
    plain = plain.select("end_date", "t.tag", F.explode("t.video_ids").alias("id"))
    assert Counter(map(tuple, ids.collect())) == Counter(map(tuple, plain.collect()))


def test_category_document_keeps_rank_order(frame, titles):
    (row,) = documents.category_documents(frame, titles).collect()
    ratios = [v.ratio_likes_dislikes for v in row.category.videos]
    assert ratios == sorted(ratios, reverse=True) and len(ratios) == 3
