"""The analyses and their nested forms. The SQL follows the definitions, not the plans."""

from pyspark.sql import functions as F

from tidemark import plans
from tidemark.operators.nesting import MAX_ITEMS
from tidemark.plans import documents
from tidemark.registry.base import VIDEOS_SQL, typed_videos
from tidemark.sources import categories

# ---------------------------------------------------------------- longest trending videos

_TRENDING_SQL = f"""{VIDEOS_SQL}
, totals AS (
    SELECT video_id, count(date) AS total_trending_days FROM videos GROUP BY video_id
), latest AS (
    SELECT video_id, views, likes, dislikes,
           row_number() OVER (PARTITION BY video_id ORDER BY date DESC NULLS LAST,
               views DESC NULLS LAST, likes DESC NULLS LAST, dislikes DESC NULLS LAST) AS rn
    FROM videos
), versions AS (
    SELECT DISTINCT video_id, title, description FROM videos
), trending AS (
    SELECT v.video_id, v.title, v.description, l.views AS latest_views, l.likes AS latest_likes,
           l.dislikes AS latest_dislikes, t.total_trending_days
    FROM versions v
    LEFT JOIN totals t ON v.video_id = t.video_id
    LEFT JOIN latest l ON v.video_id = l.video_id AND l.rn = 1
), top_trending AS (
    SELECT * FROM trending
    ORDER BY total_trending_days DESC NULLS LAST, video_id, title, description LIMIT 10
)"""

TOP_TRENDING_VIDEOS_SQL = f"{_TRENDING_SQL} SELECT * FROM top_trending"
ALL_TRENDING_VIDEOS_SQL = f"{_TRENDING_SQL} SELECT * FROM trending"
TRENDING_DAYS_SQL = f"""{_TRENDING_SQL}
SELECT t.*, CAST(v.date AS VARCHAR) AS date, v.views, v.likes, v.dislikes
FROM top_trending t
JOIN videos v ON v.video_id IS NOT DISTINCT FROM t.video_id
             AND v.title IS NOT DISTINCT FROM t.title
             AND v.description IS NOT DISTINCT FROM t.description"""


_TRENDING_INPUT = ("video_id", "title", "description", "trending_date", "views", "likes", "dislikes")


def top_trending_videos(spark, folder):
    return plans.top_trending_videos(typed_videos(spark, folder, *_TRENDING_INPUT))


def all_trending_videos(spark, folder):
    return plans.top_trending_videos(typed_videos(spark, folder, *_TRENDING_INPUT), limit=None)


def trending_days(spark, folder):
    return plans.trending_days(typed_videos(spark, folder, *_TRENDING_INPUT))


def video_documents(spark, folder):
    docs = documents.video_documents(typed_videos(spark, folder, *_TRENDING_INPUT))
    days = docs.select("rank", "part", "video.*", F.posexplode("video.trendingDays").alias("position", "day"))
    return days.select(
        "rank",
        (F.col("part") * MAX_ITEMS + F.col("position")).alias("position"),
        F.col("id").alias("video_id"),
        "title",
        "description",
        F.col("latestViews").alias("latest_views"),
        F.col("latestLikes").alias("latest_likes"),
        F.col("latestDislikes").alias("latest_dislikes"),
        "day.*",
    )


VIDEO_DOCUMENTS_SQL = f"""{_TRENDING_SQL}
, numbered AS (
    SELECT *, row_number() OVER (ORDER BY total_trending_days DESC NULLS LAST, video_id, title, description) AS rank
    FROM top_trending
)
SELECT t.rank, row_number() OVER (PARTITION BY t.rank ORDER BY v.date NULLS FIRST, v.views NULLS FIRST,
           v.likes NULLS FIRST, v.dislikes NULLS FIRST) - 1 AS position,
       t.video_id, t.title, t.description, t.latest_views, t.latest_likes, t.latest_dislikes,
       CAST(v.date AS VARCHAR) AS date, v.views, v.likes, v.dislikes
FROM numbered t
JOIN videos v ON v.video_id IS NOT DISTINCT FROM t.video_id
             AND v.title IS NOT DISTINCT FROM t.title
             AND v.description IS NOT DISTINCT FROM t.description"""

# ---------------------------------------------------------------- leading category per week

_WEEKS_SQL = f"""{VIDEOS_SQL}
, gains AS (
    SELECT CAST(date_trunc('week', date) AS DATE) AS start_date, video_id, category_id,
           max(views) - min(views) AS views_gained
    FROM videos WHERE date IS NOT NULL
    GROUP BY 1, 2, 3 HAVING count(video_id) >= 2
), totals AS (
    SELECT start_date, category_id, count(video_id) AS number_of_videos,
           CAST(sum(views_gained) AS BIGINT) AS total_views
    FROM gains GROUP BY 1, 2
), winners AS (
    SELECT t.*, c.title AS category_name,
           row_number() OVER (PARTITION BY start_date
               ORDER BY total_views DESC NULLS LAST, category_id NULLS LAST) AS rn
    FROM totals t LEFT JOIN categories c ON t.category_id = c.id
)"""
_WEEK_COLUMNS = """CAST(w.start_date AS VARCHAR) AS start_date,
    CAST(w.start_date + 6 AS VARCHAR) AS end_date, w.category_id, w.category_name,
    w.number_of_videos, w.total_views"""

TOP_WEEK_CATEGORIES_SQL = f"{_WEEKS_SQL} SELECT {_WEEK_COLUMNS} FROM winners w WHERE rn = 1"
WEEKLY_CATEGORY_VIEWS_SQL = f"""{_WEEKS_SQL}
SELECT CAST(start_date AS VARCHAR) AS start_date, CAST(start_date + 6 AS VARCHAR) AS end_date,
       category_id, number_of_videos, total_views FROM totals"""
TOP_WEEK_CATEGORY_VIDEOS_SQL = f"""{_WEEKS_SQL}
SELECT {_WEEK_COLUMNS}, g.video_id, g.views_gained
FROM winners w JOIN gains g ON g.start_date = w.start_date
    AND g.category_id IS NOT DISTINCT FROM w.category_id
WHERE w.rn = 1"""

_WEEK_INPUT = ("video_id", "trending_date", "views", "category_id")


def top_week_categories(spark, folder):
    return plans.top_week_categories(typed_videos(spark, folder, *_WEEK_INPUT), categories(spark, folder))


def weekly_category_views(spark, folder):
    return plans.weekly_category_views(typed_videos(spark, folder, *_WEEK_INPUT))


def top_week_category_videos(spark, folder):
    return plans.top_week_category_videos(typed_videos(spark, folder, *_WEEK_INPUT), categories(spark, folder))


def week_documents(spark, folder):
    docs = documents.week_documents(typed_videos(spark, folder, *_WEEK_INPUT), categories(spark, folder))
    return docs.select("weeks.*").withColumn("video_id", F.explode("video_ids")).drop("video_ids")


WEEK_DOCUMENTS_SQL = f"SELECT * EXCLUDE (views_gained) FROM ({TOP_WEEK_CATEGORY_VIDEOS_SQL})"

# ---------------------------------------------------------------- top tags per period


def _tags_sql(counted):
    return f"""{VIDEOS_SQL}
, tag_days AS (
    SELECT DISTINCT video_id, unnest(string_split(replace(tags, '"', ''), '|')) AS tag, date
    FROM videos WHERE date IS NOT NULL
), period_rows AS (
    SELECT t.video_id, t.tag, t.date, t.date + CAST(r.i AS INTEGER) AS end_date
    FROM tag_days t, range(0, 30) r(i)
), counts AS (
    SELECT end_date - 30 AS start_date, end_date, tag, {counted} AS number_of_videos
    FROM period_rows GROUP BY end_date, tag
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY end_date ORDER BY number_of_videos DESC, tag) AS rank
    FROM counts
)"""


_TAG_COLUMNS = """CAST(k.start_date AS VARCHAR) AS start_date,
    CAST(k.end_date AS VARCHAR) AS end_date, k.rank, k.tag, k.number_of_videos"""
_BY_DAY, _BY_PERIOD = _tags_sql("count(video_id)"), _tags_sql("count(DISTINCT video_id)")

TOP_TAGS_MONTHLY_SQL = f"{_BY_DAY} SELECT {_TAG_COLUMNS} FROM ranked k WHERE rank <= 10"
TOP_TAGS_MONTHLY_ONCE_SQL = f"{_BY_PERIOD} SELECT {_TAG_COLUMNS} FROM ranked k WHERE rank <= 10"
TOP_TAG_VIDEOS_SQL = f"""{_BY_DAY}
SELECT {_TAG_COLUMNS}, p.video_id, count(*) AS days
FROM ranked k JOIN period_rows p ON p.tag = k.tag AND p.end_date = k.end_date
WHERE k.rank <= 10
GROUP BY k.start_date, k.end_date, k.rank, k.tag, k.number_of_videos, p.video_id"""

_TAG_INPUT = ("video_id", "trending_date", "tags")


def top_tags_monthly(spark, folder):
    return plans.top_tags_monthly(typed_videos(spark, folder, *_TAG_INPUT))


def top_tags_monthly_once(spark, folder):
    return plans.top_tags_monthly(typed_videos(spark, folder, *_TAG_INPUT), dedupe="period")


def top_tag_videos(spark, folder):
    return plans.top_tag_videos(typed_videos(spark, folder, *_TAG_INPUT))


def top_tag_videos_once(spark, folder):
    return plans.top_tag_videos(typed_videos(spark, folder, *_TAG_INPUT), dedupe="period")


TOP_TAG_VIDEOS_ONCE_SQL = f"""{_BY_PERIOD}
SELECT {_TAG_COLUMNS}, p.video_id, count(*) AS days
FROM ranked k JOIN period_rows p ON p.tag = k.tag AND p.end_date = k.end_date
WHERE k.rank <= 10
GROUP BY k.start_date, k.end_date, k.rank, k.tag, k.number_of_videos, p.video_id"""


def month_documents(spark, folder):
    docs = documents.month_documents(typed_videos(spark, folder, *_TAG_INPUT))
    tags = docs.select("month.start_date", "month.end_date", F.explode("month.tags").alias("t"))
    ids = tags.select("start_date", "end_date", "t.tag", "t.number_of_videos", F.explode("t.video_ids").alias("video_id"))
    return ids.groupBy("start_date", "end_date", "tag", "number_of_videos", "video_id").agg(
        F.count("*").alias("days")
    )


MONTH_DOCUMENTS_SQL = f"SELECT * EXCLUDE (rank) FROM ({TOP_TAG_VIDEOS_SQL})"

# ---------------------------------------------------------------- channels by views

_CHANNELS_SQL = f"""{VIDEOS_SQL}
, ranked AS (
    SELECT channel_title, video_id, date, views,
           row_number() OVER (PARTITION BY channel_title, video_id
               ORDER BY views DESC NULLS LAST, date DESC NULLS LAST) AS rn
    FROM videos
), best AS (
    SELECT * FROM ranked WHERE rn = 1
), channels AS (
    SELECT channel_title, min(date) AS start_date, max(date) AS end_date,
           CAST(sum(views) AS BIGINT) AS total_views, count(*) AS number_of_videos
    FROM best GROUP BY channel_title
    ORDER BY total_views DESC NULLS LAST, channel_title NULLS LAST LIMIT 20
)"""
_CHANNEL_COLUMNS = """c.channel_title, CAST(c.start_date AS VARCHAR) AS start_date,
    CAST(c.end_date AS VARCHAR) AS end_date, c.total_views"""

TOP_CHANNELS_SQL = f"{_CHANNELS_SQL} SELECT {_CHANNEL_COLUMNS}, c.number_of_videos FROM channels c"
TOP_CHANNEL_VIDEOS_SQL = f"""{_CHANNELS_SQL}
SELECT {_CHANNEL_COLUMNS}, b.video_id, b.views
FROM channels c JOIN best b ON b.channel_title IS NOT DISTINCT FROM c.channel_title"""

CHANNEL_DOCUMENTS_SQL = f"""{_CHANNELS_SQL}
SELECT r.rank, row_number() OVER (PARTITION BY r.rank ORDER BY b.video_id NULLS FIRST, b.views NULLS FIRST) - 1 AS position,
       {_CHANNEL_COLUMNS}, b.video_id, b.views
FROM (SELECT *, row_number() OVER (ORDER BY total_views DESC NULLS LAST, channel_title NULLS LAST) AS rank FROM channels) r
JOIN channels c ON c.channel_title IS NOT DISTINCT FROM r.channel_title
JOIN best b ON b.channel_title IS NOT DISTINCT FROM c.channel_title"""

_CHANNEL_INPUT = ("channel_title", "video_id", "trending_date", "views")


def top_channels(spark, folder):
    return plans.top_channels(typed_videos(spark, folder, *_CHANNEL_INPUT))


def top_channel_videos(spark, folder):
    return plans.top_channel_videos(typed_videos(spark, folder, *_CHANNEL_INPUT))


def channel_documents(spark, folder):
    docs = documents.channel_documents(typed_videos(spark, folder, *_CHANNEL_INPUT))
    rows = docs.select("rank", "part", "channel.*", F.posexplode("channel.video_views").alias("position", "video"))
    return rows.select(
        "rank", (F.col("part") * MAX_ITEMS + F.col("position")).alias("position"), "channel_title", "start_date", "end_date", "total_views", "video.*"
    )


# ---------------------------------------------------------------- channels by trending days

_TRENDING_CHANNELS_SQL = f"""{VIDEOS_SQL}
, versions AS (
    SELECT video_id, title, description, count(*) AS trending_days FROM videos GROUP BY 1, 2, 3
), mapping AS (
    SELECT DISTINCT video_id, channel_title FROM videos
), joined AS (
    SELECT m.channel_title AS channel_name, v.video_id, v.title AS video_title, v.trending_days
    FROM versions v LEFT JOIN mapping m ON v.video_id = m.video_id
), channels AS (
    SELECT channel_name, CAST(sum(trending_days) AS BIGINT) AS total_trending_days
    FROM joined GROUP BY channel_name
    ORDER BY total_trending_days DESC, channel_name NULLS LAST LIMIT 10
)"""

TOP_TRENDING_CHANNELS_SQL = f"{_TRENDING_CHANNELS_SQL} SELECT * FROM channels"
TOP_TRENDING_CHANNEL_VIDEOS_SQL = f"""{_TRENDING_CHANNELS_SQL}
SELECT c.channel_name, c.total_trending_days, j.video_id, j.video_title, j.trending_days
FROM channels c JOIN joined j ON j.channel_name IS NOT DISTINCT FROM c.channel_name"""


TRENDING_CHANNEL_DOCUMENTS_SQL = f"""{_TRENDING_CHANNELS_SQL}
SELECT c.rank, c.channel_name, c.total_trending_days, j.video_id, j.video_title, j.trending_days
FROM (SELECT *, row_number() OVER (ORDER BY total_trending_days DESC, channel_name NULLS LAST) AS rank FROM channels) c
JOIN joined j ON j.channel_name IS NOT DISTINCT FROM c.channel_name"""


def top_trending_channels(spark, folder):
    return plans.top_trending_channels(typed_videos(spark, folder, "video_id", "channel_title"))


def _trending_channel_input(spark, folder):
    return typed_videos(spark, folder, "video_id", "title", "description", "channel_title")


def top_trending_channel_videos(spark, folder):
    return plans.top_trending_channel_videos(_trending_channel_input(spark, folder))


def trending_channel_documents(spark, folder):
    docs = documents.trending_channel_documents(_trending_channel_input(spark, folder))
    return docs.select("rank", "channel.*", F.explode("channel.videos_days").alias("video")).select(
        "rank", "channel_name", "total_trending_days", "video.*"
    )


# ---------------------------------------------------------------- best-rated per category

TOP_CATEGORY_VIDEOS_SQL = f"""{VIDEOS_SQL}
, rated AS (
    SELECT category_id, video_id, title AS video_title, views,
           CASE WHEN dislikes = 0 THEN NULL ELSE CAST(likes AS DOUBLE) / dislikes END AS ratio
    FROM videos WHERE views > 100000
), best AS (
    SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY ratio DESC NULLS LAST,
        views DESC, category_id NULLS LAST, video_title NULLS LAST) AS video_rank
    FROM rated
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY category_id
        ORDER BY ratio DESC NULLS LAST, video_id NULLS LAST) AS rank
    FROM best WHERE video_rank = 1
)
SELECT k.category_id, c.title AS category_name, k.rank, k.video_id, k.video_title,
       k.ratio AS ratio_likes_dislikes, k.views
FROM ranked k LEFT JOIN categories c ON k.category_id = c.id
WHERE k.rank <= 10"""
CATEGORY_DOCUMENTS_SQL = f"SELECT * EXCLUDE (rank) FROM ({TOP_CATEGORY_VIDEOS_SQL})"

_RATED_INPUT = ("video_id", "title", "views", "likes", "dislikes", "category_id")


def top_category_videos(spark, folder):
    return plans.top_category_videos(typed_videos(spark, folder, *_RATED_INPUT), categories(spark, folder))


def category_documents(spark, folder):
    docs = documents.category_documents(typed_videos(spark, folder, *_RATED_INPUT), categories(spark, folder))
    return docs.select("category.*", F.explode("category.videos").alias("video")).select(
        "category_id", "category_name", "video.*"
    )


QUERIES = {
    "top_trending_videos": (top_trending_videos, TOP_TRENDING_VIDEOS_SQL),
    "all_trending_videos": (all_trending_videos, ALL_TRENDING_VIDEOS_SQL),
    "trending_days": (trending_days, TRENDING_DAYS_SQL),
    "video_documents": (video_documents, VIDEO_DOCUMENTS_SQL),
    "top_week_categories": (top_week_categories, TOP_WEEK_CATEGORIES_SQL),
    "weekly_category_views": (weekly_category_views, WEEKLY_CATEGORY_VIEWS_SQL),
    "top_week_category_videos": (top_week_category_videos, TOP_WEEK_CATEGORY_VIDEOS_SQL),
    "week_documents": (week_documents, WEEK_DOCUMENTS_SQL),
    "top_tags_monthly": (top_tags_monthly, TOP_TAGS_MONTHLY_SQL),
    "top_tags_monthly_once": (top_tags_monthly_once, TOP_TAGS_MONTHLY_ONCE_SQL),
    "top_tag_videos": (top_tag_videos, TOP_TAG_VIDEOS_SQL),
    "top_tag_videos_once": (top_tag_videos_once, TOP_TAG_VIDEOS_ONCE_SQL),
    "month_documents": (month_documents, MONTH_DOCUMENTS_SQL),
    "top_channels": (top_channels, TOP_CHANNELS_SQL),
    "top_channel_videos": (top_channel_videos, TOP_CHANNEL_VIDEOS_SQL),
    "channel_documents": (channel_documents, CHANNEL_DOCUMENTS_SQL),
    "top_trending_channels": (top_trending_channels, TOP_TRENDING_CHANNELS_SQL),
    "top_trending_channel_videos": (top_trending_channel_videos, TOP_TRENDING_CHANNEL_VIDEOS_SQL),
    "trending_channel_documents": (trending_channel_documents, TRENDING_CHANNEL_DOCUMENTS_SQL),
    "top_category_videos": (top_category_videos, TOP_CATEGORY_VIDEOS_SQL),
    "category_documents": (category_documents, CATEGORY_DOCUMENTS_SQL),
}
