"""Shared parts of the registered queries."""

from functools import wraps

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import normalize_videos
from tidemark.sources import videos


def in_utc(query):
    """Run a query with the session zone set to UTC, and dates as text in its result."""

    @wraps(query)
    def run(spark, folder):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return dates_as_text(query(spark, folder))

    return run


def dates_as_text(df):
    """Dates cast to text: date values reach Python as different types in different engines."""
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.DateType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def typed_videos(spark, folder, *columns):
    """Typed snapshots from the given tables."""
    return normalize_videos(videos(spark, folder, *columns))


# Table `raw`: text snapshots. Table `videos`: typed snapshots. Table `categories`: dimension.
VIDEOS_SQL = """
WITH raw AS (
    SELECT CAST(e.user_id AS VARCHAR) AS video_id,
           c.c_name AS title,
           c.c_mktsegment || CASE WHEN e.event_id % 11 = 0 THEN ' v2' ELSE '' END AS description,
           CASE WHEN e.event_id % 50 = 0 THEN 'REUPLOAD' ELSE n.n_name END AS channel_title,
           CAST(n.n_regionkey AS VARCHAR) AS category_id,
           '"' || e.event_type || '"|"k' || CAST(e.event_id % 20 AS VARCHAR) || '"|"'
               || e.event_type || '"' AS tags,
           strftime(e.ts, '%y.%d.%m') AS trending_date,
           CAST(CAST(round(e.value * 100) AS BIGINT) * 100 AS VARCHAR) AS views,
           CAST(e.event_id % 97 AS VARCHAR) AS likes,
           CAST(e.event_id % 7 AS VARCHAR) AS dislikes
    FROM events e
    LEFT JOIN customer c ON e.user_id = c.c_custkey
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
), videos AS (
    SELECT video_id, title, description, channel_title, category_id, tags,
           CAST(try_strptime(trending_date, '%y.%d.%m') AS DATE) AS date,
           TRY_CAST(views AS BIGINT) AS views,
           TRY_CAST(likes AS BIGINT) AS likes,
           TRY_CAST(dislikes AS BIGINT) AS dislikes
    FROM raw
), categories AS (
    SELECT CAST(r_regionkey AS VARCHAR) AS id, r_name AS title FROM region
)"""
