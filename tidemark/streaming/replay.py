"""Paced replay of tweet files as messages."""

import os

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.fixed import SECONDS_BETWEEN_MESSAGES
from tidemark.session import exists
from tidemark.sources.files import CSV_OPTIONS
from tidemark.streaming.messages import encode_messages

ROWS_PER_STEP = 1000


def split_for_replay(tweets, folder, rows_per_file):
    """Write tweets as CSV files of at most `rows_per_file` rows: the steps of a replay.

    Rows keep the order of their files and lines. A finished folder is left as it is, so a
    restarted replay goes on with the same steps; an unfinished one is written anew.
    """
    if exists(tweets.sparkSession, os.path.join(folder, "_SUCCESS")):
        return
    order = {"_file": F.input_file_name(), "_line": F.monotonically_increasing_id()}
    ordered = tweets.withColumns(order).orderBy("_file", "_line").drop("_file", "_line")
    writer = ordered.write.mode("overwrite").options(header=True, maxRecordsPerFile=rows_per_file, **CSV_OPTIONS)
    writer.csv(folder)


def read_tweet_stream(spark, folder, files_per_trigger=1):
    """Stream of tweet CSV files, a few files at a time."""
    return (
        spark.readStream.schema(schemas.TWEETS_CSV)
        .options(header=True, multiLine=True, maxFilesPerTrigger=files_per_trigger, **CSV_OPTIONS)
        .csv(folder)
    )


def start_replay(writer, checkpoint, rows_per_trigger=None):
    """Start a stream writer from `message_writer`, or any other sink.

    `rows_per_trigger` (rows per file times files per trigger) sets the pause that keeps the
    fixed pace of one message per 0.09 s on average. Without it the backlog is sent at once.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    if rows_per_trigger:
        seconds = rows_per_trigger * SECONDS_BETWEEN_MESSAGES
        return writer.trigger(processingTime=f"{round(seconds * 1000)} milliseconds").start()
    return writer.trigger(availableNow=True).start()


def text_sink(folder):
    """Writer of messages as text lines, in place of a topic."""
    return lambda messages: messages.writeStream.format("text").option("path", folder)


def replay(spark, tweets, progress, sink, rows_per_step=ROWS_PER_STEP, paced=True):
    """Start the replay of a tweet frame into a sink (a function from messages to a stream writer).

    Steps and checkpoint both live below `progress`: started again with the same folder, the
    replay goes on where it stopped.
    """
    steps = os.path.join(progress, "steps")
    split_for_replay(tweets, steps, rows_per_step)
    writer = sink(encode_messages(read_tweet_stream(spark, steps)))
    return start_replay(writer, os.path.join(progress, "stream"), rows_per_step if paced else None)
