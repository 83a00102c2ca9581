"""Grouping helpers: gains of cumulative measures, weeks, periods, tags."""

from pyspark.sql import functions as F

from tidemark.fixed import PERIOD_DAYS, WEEK_MIN_APPEARANCES
from tidemark.functions import period_ends, period_start, split_tags, week_end, week_start


def cumulative_gain(df, keys, measure, counted, min_rows=WEEK_MIN_APPEARANCES, gain="gain"):
    """Growth of a cumulative measure per key, for keys with at least `min_rows` rows.

    Max, min and count all combine map-side, so a hot key sends one row per map task.
    """
    return (
        df.groupBy(*keys)
        .agg(
            F.count(counted).alias("_rows"),
            (F.max(measure) - F.min(measure)).alias(gain),
        )
        .where(F.col("_rows") >= min_rows)
        .drop("_rows")
    )


def with_week_bounds(df, date):
    """Add `start_date` (Monday) and `end_date` (Sunday) of the week of `date`."""
    return df.withColumns({"start_date": week_start(date), "end_date": week_end(date)})


def explode_periods(df, date, days=PERIOD_DAYS):
    """One row per sliding period that holds `date`; rows without a date give none."""
    first, last = F.col(date), F.date_add(date, days - 1)
    return df.withColumn("end_date", F.explode(period_ends(first, last))).withColumn(
        "start_date", period_start("end_date", days)
    )


def explode_tags(df, tags="tags", distinct=False):
    """One row per tag in column `tag`; null tags give no row.

    `distinct` removes repeats inside one text before the rows multiply.
    """
    parts = split_tags(tags)
    return df.withColumn("tag", F.explode(F.array_distinct(parts) if distinct else parts))
