"""Messages by minute."""

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.fixed import MESSAGE_TIME_FORMAT
from tidemark.functions import minute_key, minute_text
from tidemark.sources.files import CSV_OPTIONS


def minute_counts(messages, delay=None):
    """Number of messages per minute; messages whose time cannot be parsed count under a null minute.

    On a stream this suits the complete and update modes, which lose no late message; state
    is one number per minute. With `delay` it suits append mode: state is kept for open minutes
    only, a minute appears once it is `delay` older than the newest message, and later
    messages and those without a time are dropped. Use `write_minute_files` where every message
    has to be kept.
    """
    event_time = F.try_to_timestamp("created_at", F.lit(MESSAGE_TIME_FORMAT))
    if not delay:
        minute = F.date_trunc("minute", event_time).alias("minute")
        return messages.groupBy(minute).agg(F.count("*").alias("n_messages"))
    return (
        messages.select(event_time.alias("event_time"))
        .withWatermark("event_time", delay)
        .groupBy(F.window("event_time", "1 minute"))
        .agg(F.count("*").alias("n_messages"))
        .select(F.col("window.start").alias("minute"), "n_messages")
    )


def write_minute_files(messages, folder, checkpoint, name=None, **trigger):
    """Start a stream that writes headerless CSV (tweet_id, minute, text) below `minute=<key>/`.

    No state is kept, so late messages join their minute and the last minute is written
    too. The checkpoint and the sink's own log make every row appear once. Rebalancing by
    minute keeps the number of files low, and splits a minute that outgrows one task.
    """
    rows = messages.select(
        "tweet_id",
        minute_text("created_at").alias("created_at"),
        "text",
        minute_key("created_at").alias("minute"),
    )
    writer = rows.hint("rebalance", "minute").writeStream
    return (
        (writer.queryName(name) if name else writer)
        .format("csv")
        .options(header=False, **CSV_OPTIONS)
        .partitionBy("minute")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start(folder)
    )


def read_minute_files(spark, folder):
    """The written messages, with `minute` for pruning."""
    return (
        spark.read.schema(f"{schemas.MINUTE_FILE}, minute string")
        .options(header=False, multiLine=True, **CSV_OPTIONS)
        .csv(folder)
    )
