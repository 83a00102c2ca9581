"""Videos that trend longest."""

from pyspark.sql import functions as F

from tidemark.fixed import TOP_VIDEOS
from tidemark.operators import join_small, top_k

VERSION = ["video_id", "title", "description"]
STATS = ["latest_views", "latest_likes", "latest_dislikes", "total_trending_days"]


def _leading_videos(videos, limit):
    """Id, total and newest date of the `limit` leading videos.

    They are sure to hold the `limit` leading versions. Only ids and dates are read and
    shuffled for them. Rows without an id belong to no video: no total, last in order.
    """
    totals = videos.groupBy("video_id").agg(
        F.when(F.col("video_id").isNotNull(), F.count("date")).alias("total_trending_days"),
        F.max("date").alias("date"),
    )
    return top_k(totals, [F.desc_nulls_last("total_trending_days"), "video_id"], limit)


def _latest_figures(snapshots, keys, **more):
    """Figures of the newest snapshot per video; on a tie the higher ones."""
    latest = F.max(F.struct("date", "views", "likes", "dislikes")).alias("latest")
    rows = snapshots.where(F.col("video_id").isNotNull()).groupBy(*keys)
    return rows.agg(latest, *[c.alias(name) for name, c in more.items()]).select(
        *keys,
        F.col("latest.views").alias("latest_views"),
        F.col("latest.likes").alias("latest_likes"),
        F.col("latest.dislikes").alias("latest_dislikes"),
        *more,
    )


def top_trending_videos(videos, limit=TOP_VIDEOS, rank=None):
    """One row per video version (id, title, description), by appearances of the video.

    A retitled video gives several rows; each has the total and the latest figures of the
    whole video. `limit` None or 0 gives all versions, unsorted and without `rank`, which
    otherwise names a column for the position.
    """
    versions = videos.select(*VERSION)
    if limit:
        # Two more scans, over texts and over figures; both keep few rows right away. Both
        # use all columns of `leading`, so that Spark computes it once.
        leading = _leading_videos(videos, limit)
        keys = ["video_id", "date"]
        newest = join_small(videos, leading.select(*keys), keys, rows=limit)
        versions = join_small(versions, leading, ["video_id"], rows=limit).distinct()
        result = join_small(versions, _latest_figures(newest, keys), keys, rows=limit, how="left")
    else:
        stats = _latest_figures(videos, ["video_id"], total_trending_days=F.count("date"))
        result = join_small(versions.distinct(), stats, ["video_id"], how="left")
    order = [F.desc_nulls_last("total_trending_days"), *VERSION]
    return top_k(result.select(*VERSION, *STATS), order, limit, rank)


def trending_days(videos, limit=TOP_VIDEOS, rank=None):
    """The snapshots behind `top_trending_videos`: its columns, plus one row per snapshot.

    Rows, not arrays: the figures of one video may be any share of the table.
    """
    snapshots = videos.select(*VERSION, "date", "views", "likes", "dislikes")
    result = join_small(snapshots, top_trending_videos(videos, limit, rank), VERSION, rows=limit)
    named = [rank] if rank and limit else []
    return result.select(*named, *VERSION, *STATS, "date", "views", "likes", "dislikes")
