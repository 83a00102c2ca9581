"""Minute keys for messages."""

from pyspark.sql import functions as F

from tidemark.fixed import MESSAGE_TIME_FORMAT, MINUTE_KEY_SUFFIX


def minute_text(created_at):
    """`yyyy-MM-dd HH:mm:ss` text without its seconds. Text in, text out: no time zone."""
    created_at = F.col(created_at) if isinstance(created_at, str) else created_at
    return F.left(created_at, F.length(created_at) - F.lit(3))


def minute_key(created_at):
    """File-safe minute name, for example `2024_01_31_23_59_00`."""
    return F.concat(F.translate(minute_text(created_at), "- :", "___"), F.lit(MINUTE_KEY_SUFFIX))


def minute_of(timestamp):
    """Timestamp cut to its minute."""
    return F.date_trunc("minute", timestamp)


def utc_now_text():
    """Current UTC time in message format, whatever the session time zone is."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(now, MESSAGE_TIME_FORMAT)
