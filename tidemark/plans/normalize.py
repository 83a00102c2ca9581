"""Text snapshots to typed snapshots."""

from pyspark.sql import functions as F

from tidemark.functions import parse_snapshot_date, to_long

TYPED = {
    "video_id": F.col,
    "title": F.col,
    "description": F.col,
    "channel_title": F.col,
    "category_id": F.col,
    "tags": F.col,
    "trending_date": parse_snapshot_date,
    "views": to_long,
    "likes": to_long,
    "dislikes": to_long,
}


def normalize_videos(videos):
    """Cast the measures and parse the date, which is then called `date`.

    Columns that the frame does not have are left out. Write the result once with
    `write_table` when several analyses follow.
    """
    return videos.select(
        *[
            cast(name).alias("date" if name == "trending_date" else name)
            for name, cast in TYPED.items()
            if name in videos.columns
        ]
    )
