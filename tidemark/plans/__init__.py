"""The analyses. Each takes frames and returns a flat frame; `documents` has the nested forms.

Input frames are those of `normalize_videos`, and dimensions are frames of (id, title).
"""

from tidemark.plans.categories import (
    top_category_videos,
    top_week_categories,
    top_week_category_videos,
    weekly_category_views,
    weekly_gains,
)
from tidemark.plans.channels import (
    top_channel_videos,
    top_channels,
    top_trending_channel_videos,
    top_trending_channels,
)
from tidemark.plans.normalize import normalize_videos
from tidemark.plans.profile import observed, preview, profile_of, row_count, write_profiled
from tidemark.plans.tags import period_tag_counts, tag_days, top_tag_videos, top_tags_monthly
from tidemark.plans.videos import top_trending_videos, trending_days

__all__ = [
    "normalize_videos",
    "observed",
    "period_tag_counts",
    "preview",
    "profile_of",
    "row_count",
    "tag_days",
    "top_category_videos",
    "top_channel_videos",
    "top_channels",
    "top_tag_videos",
    "top_tags_monthly",
    "top_trending_channel_videos",
    "top_trending_channels",
    "top_trending_videos",
    "top_week_categories",
    "top_week_category_videos",
    "trending_days",
    "weekly_category_views",
    "weekly_gains",
    "write_profiled",
]
