"""Most used tags of every sliding period."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.fixed import PERIOD_DAYS, TOP_TAGS
from tidemark.functions import period_ends, period_start
from tidemark.operators import explode_tags, top_n_per_group
from tidemark.session import work_folder

DEDUPE = ("day", "period")
# Snapshot dates have two-digit years: 100 years and one period hold at most this many end dates.
MAX_PERIODS = 36_600
# 8 bytes each.
MOST_HASHES = 1_000_000


def tag_days(videos):
    """Distinct (video, tag, date).

    A missing date stays in, and later falls in no period; filtering it here would parse
    every date twice when the frame comes straight from text.
    """
    return explode_tags(videos, distinct=True).select("video_id", "tag", "date").distinct()


def _covers(days, dedupe, period):
    """First and last period end that each (video, tag, date) newly counts for.

    Counted per day, a date counts for every period that holds it. Counted per period, it
    counts only for those that the same video's previous date has not reached.
    """
    last = F.date_add("date", period - 1)
    if dedupe == "day":
        first = F.col("date")
    else:
        previous = F.lag("date").over(Window.partitionBy("video_id", "tag").orderBy("date"))
        first = F.greatest(F.col("date"), F.date_add(previous, period))
    return days.select("video_id", "tag", first.alias("first_end"), last.alias("last_end"))


def period_tag_counts(videos, dedupe="day", days=PERIOD_DAYS):
    """Number of videos per (tag, period), by differences.

    A row counts for all periods between two end dates, so it adds one at the first of them and takes one away
    after the last. The changes are summed per (tag, date), which combines map-side; their running sum
    over the dates of a tag is the number of videos from one change to the next. Only the sums are spread over the
    dates in between, one row per (tag, period) that exists. A tag has at most one change per date.
    """
    if dedupe not in DEDUPE:
        raise ValueError(f"dedupe must be one of {DEDUPE}")
    covers = _covers(tag_days(videos), dedupe, days).where(F.col("first_end").isNotNull() & (F.col("first_end") <= F.col("last_end")))
    enters = F.struct(F.col("first_end").alias("date"), F.lit(1).alias("change"))
    leaves = F.struct(F.date_add("last_end", 1).alias("date"), F.lit(-1).alias("change"))
    changes = (
        covers.select("tag", F.inline(F.array(enters, leaves)))
        .groupBy("tag", "date")
        .agg(F.sum("change").alias("change"))
    )
    dates = Window.partitionBy("tag").orderBy("date")
    running = F.sum("change").over(dates.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    spans = changes.select("tag", "date", running.alias("number_of_videos"), F.lead("date").over(dates).alias("until"))
    ends = F.explode(period_ends(F.col("date"), F.date_sub("until", 1))).alias("end_date")
    return (
        spans.where("number_of_videos > 0")
        .select("tag", ends, "number_of_videos")
        .withColumn("start_date", period_start("end_date", days))
    )


def top_tags_monthly(videos, dedupe="day", n=TOP_TAGS, days=PERIOD_DAYS):
    """The `n` most used tags of each period of `days` days, one period per end date.

    `dedupe="day"` counts a video once per day, `dedupe="period"` once per period.
    """
    order = [F.desc("number_of_videos"), F.asc("tag")]
    counts = period_tag_counts(videos, dedupe, days)
    return top_n_per_group(counts, ["end_date"], order, n, rank="rank").select(
        "start_date", "end_date", "rank", "tag", "number_of_videos"
    )


def _days_per_end(rows, period):
    """Days of each (video, tag) in the period of each end date, from its distinct dates, by differences.

    A date adds one to the periods from its own end date on, and takes it away after the last that holds it. The running
    sum over the changes of a (video, tag), at most two per date, is its number of days from one change to the
    next, and only these spans are spread over their end dates.
    """
    enters = F.struct(F.col("date").alias("at"), F.lit(1).alias("change"))
    leaves = F.struct(F.date_add("date", period).alias("at"), F.lit(-1).alias("change"))
    # Dealt before each date becomes two changes.
    rows = rows.where("date IS NOT NULL").repartition("video_id", "tag")
    changes = rows.select("video_id", "tag", F.inline(F.array(enters, leaves)))
    dates = Window.partitionBy("video_id", "tag").orderBy("at")
    spans = changes.select(
        "video_id",
        "tag",
        "at",
        # Changes of one date are peers: each of them has the sum after all.
        F.sum("change").over(dates.rangeBetween(Window.unboundedPreceding, Window.currentRow)).alias("days"),
        F.lead("at").over(dates).alias("until"),
    )
    ends = F.explode(period_ends(F.col("at"), F.date_sub("until", 1))).alias("end_date")
    return spans.where("days > 0 AND until > at").select("video_id", "tag", ends, "days")


def top_tag_videos(videos, dedupe="day", n=TOP_TAGS, days=PERIOD_DAYS):
    """The videos counted in `top_tags_monthly`, one row each, with their days in the period.

    The winning tags are written to the shared folder first, so they are found once, and Spark knows how few they are.
    The dates of a (video, tag) are brought together, and its days per end date counted there: the rows of the
    result, many times those of the table, are joined to the winners by equality on (tag, end date) and
    never shuffled. Rows of tags that win no period are dropped before anything is shuffled: hashes of the
    winning tags are broadcast, at most `n` per period, and so few that a chance match of hashes only costs
    a row that the join drops.
    """
    path = work_folder(videos.sparkSession, "top-tags")
    top_tags_monthly(videos, dedupe, n, days).write.parquet(path)
    top = videos.sparkSession.read.parquet(path)
    rows = explode_tags(videos, distinct=True).select("video_id", "tag", "date")
    winners = top.select(F.xxhash64("tag").alias("_tag")).distinct()
    winners = F.broadcast(winners) if n * MAX_PERIODS <= MOST_HASHES else winners
    rows = rows.withColumn("_tag", F.xxhash64("tag")).join(winners, "_tag", "left_semi").drop("_tag").distinct()
    # Neither side has null tags, and rows without a date are in no period.
    found = _days_per_end(rows, days).join(top, ["tag", "end_date"])
    return found.select("start_date", "end_date", "rank", "tag", "number_of_videos", "video_id", "days")
