"""Dates, weeks and sliding periods."""

from pyspark.sql import functions as F

from tidemark.fixed import PERIOD_DAYS, SNAPSHOT_DATE_FORMAT


def parse_snapshot_date(text):
    """Text `yy.dd.MM` to a date; null for anything else."""
    return F.try_to_date(text, SNAPSHOT_DATE_FORMAT)


def week_start(date):
    """Monday of the date's week. `trunc` works on dates, so no time zone is involved."""
    return F.trunc(date, "week")


def week_end(date):
    """Sunday of the date's week."""
    return F.date_add(week_start(date), 6)


def period_ends(first_end, last_end):
    """Array of all period end dates from `first_end` to `last_end`."""
    return F.sequence(first_end, last_end)


def period_start(end, days=PERIOD_DAYS):
    """Printed start of the period. It lies one day before the first counted day."""
    return F.date_sub(end, days)
