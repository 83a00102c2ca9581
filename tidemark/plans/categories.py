"""Leading category of each week, and best-rated videos of each category."""

from pyspark.sql import functions as F

from tidemark.fixed import MIN_VIEWS, TOP_CATEGORY_VIDEOS, WEEK_MIN_APPEARANCES
from tidemark.functions import number_of_pair, pair_order, ratio, week_end, week_start
from tidemark.operators import cumulative_gain, first_per_key, join_small, top_n_per_group, with_name

# Snapshot dates have two-digit years: 100 years hold at most this many weeks.
MAX_WEEKS = 5_219


def weekly_gains(videos, min_appearances=WEEK_MIN_APPEARANCES):
    """Views gained per (week, video, category), for videos seen at least twice that week."""
    # Rows without a date gather in one group, which counts zero and so does not pass.
    return cumulative_gain(
        videos.select("video_id", "category_id", "views", week_start("date").alias("start_date")),
        ["start_date", "video_id", "category_id"],
        measure="views",
        counted=F.when(F.col("start_date").isNotNull(), F.col("video_id")),
        min_rows=min_appearances,
        gain="views_gained",
    )


def weekly_category_views(videos):
    """Number of videos and views gained per (week, category)."""
    return _category_totals(weekly_gains(videos)).withColumn("end_date", week_end("start_date"))


def _category_totals(gains):
    return gains.groupBy("start_date", "category_id").agg(
        F.count("video_id").alias("number_of_videos"),
        F.sum("views_gained").alias("total_views"),
    )


def _winners(gains):
    order = [F.desc_nulls_last("total_views"), F.asc_nulls_last("category_id")]
    return first_per_key(_category_totals(gains), ["start_date"], order)


def top_week_categories(videos, categories):
    """The category with the most views gained in each week; on a tie the lower id."""
    return with_name(_winners(weekly_gains(videos)), categories, "category_id").select(
        "start_date",
        week_end("start_date").alias("end_date"),
        "category_id",
        "category_name",
        "number_of_videos",
        "total_views",
    )


def top_week_category_videos(videos, categories):
    """The videos counted in `top_week_categories`, one row each, with the views gained."""
    gains = weekly_gains(videos)
    winners = with_name(_winners(gains), categories, "category_id")
    return join_small(gains, winners, ["start_date", "category_id"], rows=MAX_WEEKS).select(
        "start_date",
        week_end("start_date").alias("end_date"),
        "category_id",
        "category_name",
        "number_of_videos",
        "total_views",
        "video_id",
        "views_gained",
    )


def top_category_videos(videos, categories, min_views=MIN_VIEWS, n=TOP_CATEGORY_VIDEOS):
    """The `n` videos with the best like/dislike ratio of each category.

    Only snapshots above `min_views` count. The best snapshot of a video decides its
    category. Without dislikes there is no ratio, and the video ranks last.

    Ratio and views of a snapshot are ordered by one decimal, so the best snapshot of each version of a video is a
    hash aggregate that combines map-side; only these few rows are sorted, and titles with them.
    """
    rated = videos.where(F.col("views") > min_views).select(
        "category_id",
        "video_id",
        F.col("title").alias("video_title"),
        "views",
        ratio("likes", "dislikes").alias("ratio_likes_dislikes"),
    )
    versions = rated.groupBy("category_id", "video_id", "video_title").agg(
        F.max(pair_order("ratio_likes_dislikes", "views")).alias("_order"),
        F.max("ratio_likes_dislikes").alias("ratio_likes_dislikes"),
    )
    best = first_per_key(
        versions.withColumn("views", number_of_pair("_order")),
        ["video_id"],
        [F.desc("_order"), F.asc_nulls_last("category_id"), F.asc_nulls_last("video_title")],
    )
    by_ratio = F.desc_nulls_last("ratio_likes_dislikes")
    top = top_n_per_group(best, ["category_id"], [by_ratio, F.asc_nulls_last("video_id")], n, rank="rank")
    return with_name(top, categories, "category_id").select(
        "category_id",
        "category_name",
        "rank",
        "video_id",
        "video_title",
        "ratio_likes_dislikes",
        "views",
    )
