"""Nested forms of the analyses: one struct column per row, holding arrays of structs.

An array has at most `max_items` values; longer ones are continued in further rows, numbered by `part`.
"""

from pyspark.sql import functions as F

from tidemark.fixed import TOP_CHANNELS, TOP_TRENDING_CHANNELS, TOP_VIDEOS
from tidemark.operators import as_document, nest
from tidemark.operators.nesting import MAX_ITEMS, nest_pairs, repeated
from tidemark.plans.categories import top_category_videos, top_week_category_videos
from tidemark.plans.channels import top_channel_videos, top_trending_channel_videos
from tidemark.plans.tags import top_tag_videos
from tidemark.plans.videos import trending_days


def _ranked(limit):
    """Key of ranked documents; all documents together have no ranks."""
    return ["rank"] if limit else []


def _in_order(documents):
    """Documents in the order of their rank and part."""
    return documents.orderBy(*[c for c in ("rank", "part") if c in documents.columns])


def video_documents(videos, limit=TOP_VIDEOS, max_items=MAX_ITEMS):
    """Column `video`, with its `rank`; rows come in the order of rank and part."""
    keys = [
        *_ranked(limit),
        "video_id",
        "title",
        "description",
        "latest_views",
        "latest_likes",
        "latest_dislikes",
        "total_trending_days",
    ]
    day = F.struct("date", "views", "likes", "dislikes")
    rows = nest(trending_days(videos, limit, "rank"), keys, day, "trending_days", max_items=max_items)
    document = as_document(
        rows,
        "video",
        id="video_id",
        title="title",
        description="description",
        latestViews="latest_views",
        latestLikes="latest_likes",
        latestDislikes="latest_dislikes",
        trendingDays="trending_days",
    )
    return _in_order(document)


def week_documents(videos, categories, max_items=MAX_ITEMS):
    """Column `weeks`."""
    keys = [
        "start_date",
        "end_date",
        "category_id",
        "category_name",
        "number_of_videos",
        "total_views",
    ]
    rows = top_week_category_videos(videos, categories)
    return as_document(nest(rows, keys, F.col("video_id"), "video_ids", max_items=max_items), "weeks")


def month_documents(videos, dedupe="day", max_items=MAX_ITEMS):
    """Column `month`. Counted per day, a video's id is repeated for each of its days."""
    keys = ["start_date", "end_date", "rank", "tag", "number_of_videos"]
    rows = nest_pairs(
        top_tag_videos(videos, dedupe),
        keys,
        F.col("video_id"),
        "video_ids",
        copies="days" if dedupe == "day" else None,
        max_items=max_items,
    )
    # At most ten tags per period and part, each with a bounded array; ids are repeated after the last shuffle.
    tag = F.struct("rank", "tag", "number_of_videos", "video_ids")
    months = rows.groupBy("start_date", "end_date", "part").agg(F.sort_array(F.collect_list(tag)).alias("ranked"))
    tags = F.transform(
        "ranked",
        lambda t: F.struct(
            t["tag"].alias("tag"),
            t["number_of_videos"].alias("number_of_videos"),
            repeated(t["video_ids"]).alias("video_ids"),
        ),
    )
    return as_document(
        months.select("start_date", "end_date", "part", tags.alias("tags")),
        "month",
        start_date="start_date",
        end_date="end_date",
        tags="tags",
    )


def channel_documents(videos, limit=TOP_CHANNELS, max_items=MAX_ITEMS):
    """Column `channel`, with the views of each video; rows come in the order of rank and part."""
    keys = [*_ranked(limit), "channel_title", "start_date", "end_date", "total_views"]
    rows = top_channel_videos(videos, limit, "rank")
    rows = nest(rows, keys, F.struct("video_id", "views"), "video_views", max_items=max_items)
    return _in_order(as_document(rows, "channel"))


def trending_channel_documents(videos, limit=TOP_TRENDING_CHANNELS, max_items=MAX_ITEMS):
    """Column `channel`, with the trending days of each video; rows come in the order of rank and part."""
    keys = [*_ranked(limit), "channel_name", "total_trending_days"]
    item = F.struct("video_id", "video_title", "trending_days")
    rows = top_trending_channel_videos(videos, limit, "rank")
    return _in_order(as_document(nest(rows, keys, item, "videos_days", max_items=max_items), "channel"))


def category_documents(videos, categories):
    """Column `category`. Each holds at most ten videos, so one row is always enough."""
    video = F.struct("rank", "video_id", "video_title", "ratio_likes_dislikes", "views")
    rows = (
        top_category_videos(videos, categories)
        .groupBy("category_id", "category_name")
        .agg(F.sort_array(F.collect_list(video)).alias("ranked"))
    )
    bare = F.transform("ranked", lambda v: v.dropFields("rank"))
    return as_document(rows.select("category_id", "category_name", bare.alias("videos")), "category")
