"""Messages. The stream queries run a real stream over all events until it has caught up."""

import uuid
from datetime import datetime, timezone

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark import streaming
from tidemark.session import work_folder
from tidemark.sources import messages, read_tweets, tweets, write_csv

# Steps that a replay without waiting sends together.
STEPS_PER_BATCH = 2000

MESSAGES_SQL = """
WITH messages AS (
    SELECT CAST(event_id AS VARCHAR) AS tweet_id,
           TIMESTAMP '2024-01-01' + to_seconds(event_id * 90 // 1000) AS sent,
           ' said "' || event_type || '",' || chr(10) || props || ' ' AS text
    FROM events
)"""


def encode_json(spark, folder):
    return streaming.encode_messages(messages(spark, folder), created_at="created_at")


def utc_stamps(spark, folder):
    """Messages stamped while they are sent; the stamp lies inside the run."""
    sent, now = work_folder(spark, "stamped"), lambda: datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    before = now()
    streaming.encode_messages(messages(spark, folder)).write.text(sent)
    inside = F.col("created_at").between(before, now())
    return streaming.decode_messages(spark.read.text(sent)).select("tweet_id", inside.alias("stamped_in_run"))


def _message_stream(spark, folder):
    """All messages written as text files, read back as a stream and decoded."""
    topic = work_folder(spark, "topic")
    streaming.encode_messages(messages(spark, folder), created_at="created_at").write.text(topic)
    return streaming.decode_messages(streaming.read_message_files(spark, topic))


def stream_decode(spark, folder):
    out = work_folder(spark, "decoded")
    stream = _message_stream(spark, folder).writeStream.format("parquet")
    stream = stream.option("checkpointLocation", work_folder(spark, "decoded-progress"))
    stream.trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.parquet(out)


def minute_files(spark, folder):
    out = work_folder(spark, "minutes")
    streaming.write_minute_files(
        _message_stream(spark, folder), out, work_folder(spark, "minutes-progress"), availableNow=True
    ).awaitTermination()
    return streaming.read_minute_files(spark, out)


def minute_counts(spark, folder):
    counts = streaming.minute_counts(messages(spark, folder))
    return counts.select(F.date_format("minute", "yyyy-MM-dd HH:mm").alias("minute"), "n_messages")


def _broken_times(rows):
    """Every seventh message with a time that cannot be parsed."""
    broken = F.when(F.col("tweet_id").cast("long") % 7 == 0, "soon").otherwise(F.col("created_at"))
    return rows.withColumn("created_at", broken)


def minute_counts_stream(spark, folder):
    """Minutes of a live stream, a few files a batch; every seventh message has a time that cannot be parsed."""
    topic, out = work_folder(spark, "topic"), work_folder(spark, "minute-counts")
    rows = _broken_times(messages(spark, folder)).repartition(4)
    streaming.encode_messages(rows, created_at="created_at").write.text(topic)
    stream = streaming.decode_messages(streaming.read_message_files(spark, topic, files_per_trigger=1))
    query = streaming.write_minute_counts(stream, out, work_folder(spark, "minute-counts-progress"), merge_every=2, availableNow=True)
    query.awaitTermination()
    counts = streaming.read_minute_counts(spark, out)
    return counts.select(F.date_format("minute", "yyyy-MM-dd HH:mm").alias("minute"), "n_messages")


def minute_files_compacted(spark, folder):
    """Minute files of several triggers, merged to one file per minute before they are read."""
    topic, out, progress = (work_folder(spark, name) for name in ("topic", "minutes", "minutes-progress"))
    rows = messages(spark, folder).repartition(3)
    streaming.encode_messages(rows, created_at="created_at").write.text(topic)
    stream = streaming.decode_messages(streaming.read_message_files(spark, topic, files_per_trigger=1))
    streaming.write_minute_files(stream, f"{out}/raw", progress, availableNow=True).awaitTermination()
    streaming.compact_minutes(spark, out, closed_before="9999")
    return streaming.read_compacted_minutes(spark, out)


def consumer_progress(spark, folder):
    """All messages through a consumer that fails in its third batch and starts again, against its committed positions."""
    topic, out, progress, positions = (work_folder(spark, name) for name in ("topic", "consumed", "progress", "positions"))
    group = f"consumer_{uuid.uuid4().hex}"
    streaming.encode_messages(messages(spark, folder).repartition(5), created_at="created_at").write.text(topic)
    fails = [True]

    def consume(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        if batch_id == 2 and fails:
            fails.clear()
            raise RuntimeError("stopped after writing, before the commit")

    def run():
        stream = streaming.decode_messages(streaming.read_message_files(spark, topic, files_per_trigger=1))
        writer = stream.writeStream.foreachBatch(consume).queryName(group).option("checkpointLocation", progress)
        return writer.trigger(availableNow=True).start()

    listener = streaming.PositionLog(spark, positions, group)
    spark.streams.addListener(listener)
    try:
        first = run()
        while first.isActive:
            try:
                first.awaitTermination(1)
            except StreamingQueryException:
                break
        run().awaitTermination()
        consumed = spark.read.parquet(out)
        streaming.await_positions(spark, positions, group, consumed.count())
    finally:
        spark.streams.removeListener(listener)
    written = consumed.groupBy("batch").agg(F.count("*").alias("n_written"))
    committed = streaming.read_positions(spark, positions, group).select(F.col("batch").cast("int").alias("batch"), "n_rows")
    same = written.join(committed, "batch", "left").select("batch", F.coalesce(F.col("n_written") == F.col("n_rows"), F.lit(False)).alias("committed"))
    return consumed.join(F.broadcast(same), "batch").select("tweet_id", "created_at", "text", "committed")


def replay_paced(spark, folder):
    """Conversation turns in order as a tweet file, replayed evenly; each message carries its number and planned step."""
    source, topic, progress = (work_folder(spark, name) for name in ("tweets", "topic", "paced"))
    rows = tweets(spark, folder).withColumn("parts", F.split("tweet_id", "-"))
    order = [F.element_at("parts", i).cast("long") for i in (1, 2)]
    write_csv(rows.orderBy(*order).drop("parts"), source)
    send = streaming.acknowledged(streaming.folder_sender(topic), f"{progress}/delivery")
    streaming.replay_paced(spark, read_tweets(spark, source), progress, send, steps_per_batch=STEPS_PER_BATCH).wait()
    sent = spark.read.parquet(topic)
    decoded = streaming.decode_messages(sent, keep=["number", "step"])
    return decoded.select("number", "step", "tweet_id", "text")


def acknowledged_delivery(spark, folder):
    """Messages sent in acknowledged batches by a sender that fails once; records without a value are set aside."""
    topic, out, log = (work_folder(spark, name) for name in ("topic", "sent", "delivery"))
    rows = messages(spark, folder)
    value = F.when(F.col("tweet_id").cast("long") % 13 != 0, F.to_json(F.struct("tweet_id", "text")))
    rows.select("tweet_id", value.alias("value")).repartition(3).write.parquet(topic)
    stream = spark.readStream.schema("tweet_id string, value string").option("maxFilesPerTrigger", 1).parquet(topic)
    fails = [True]

    def send(records, batch_id):
        streaming.folder_sender(out)(records, batch_id)
        if batch_id == 1 and fails:
            fails.clear()
            raise RuntimeError("no acknowledgement")

    streaming.start_acknowledged(stream, work_folder(spark, "progress"), send, log).awaitTermination()
    sent = spark.read.parquet(out).select("tweet_id", F.lit("sent").alias("state"))
    rejected = streaming.rejected_records(spark, log, "tweet_id string, value string")
    return sent.union(rejected.select("tweet_id", F.lit("rejected").alias("state")))


def replay_messages(spark, folder):
    """Conversation turns as a tweet file, replayed step by step as messages and decoded."""
    source, topic = work_folder(spark, "tweets"), work_folder(spark, "topic")
    write_csv(tweets(spark, folder), source)
    progress = work_folder(spark, "replay")
    query = streaming.replay(spark, read_tweets(spark, source), progress, streaming.text_sink(topic), rows_per_step=5000, paced=False)
    query.awaitTermination()
    return streaming.decode_messages(spark.read.text(topic)).select("tweet_id", "text")


QUERIES = {
    "encode_json": (
        encode_json,
        f"""{MESSAGES_SQL} SELECT CAST(json_object('tweet_id', tweet_id, 'created_at',
            strftime(sent, '%Y-%m-%d %H:%M:%S'), 'text', text) AS VARCHAR) AS value FROM messages""",
    ),
    "utc_stamps": (utc_stamps, f"{MESSAGES_SQL} SELECT tweet_id, true AS stamped_in_run FROM messages"),
    "stream_decode": (
        stream_decode,
        f"""{MESSAGES_SQL} SELECT tweet_id, strftime(sent, '%Y-%m-%d %H:%M:%S') AS created_at, text
            FROM messages""",
    ),
    "minute_files": (
        minute_files,
        f"""{MESSAGES_SQL} SELECT tweet_id, strftime(sent, '%Y-%m-%d %H:%M') AS created_at, text,
            strftime(sent, '%Y_%m_%d_%H_%M') || '_00' AS minute FROM messages""",
    ),
    "minute_counts_stream": (
        minute_counts_stream,
        f"""{MESSAGES_SQL} SELECT CASE WHEN CAST(tweet_id AS BIGINT) % 7 <> 0
                THEN strftime(sent, '%Y-%m-%d %H:%M') END AS minute, count(*) AS n_messages
            FROM messages GROUP BY 1""",
    ),
    "minute_files_compacted": (
        minute_files_compacted,
        f"""{MESSAGES_SQL} SELECT tweet_id, strftime(sent, '%Y-%m-%d %H:%M') AS created_at, text,
            strftime(sent, '%Y_%m_%d_%H_%M') || '_00' AS minute FROM messages""",
    ),
    "consumer_progress": (
        consumer_progress,
        f"""{MESSAGES_SQL} SELECT tweet_id, strftime(sent, '%Y-%m-%d %H:%M:%S') AS created_at, text,
            true AS committed FROM messages""",
    ),
    "replay_paced": (
        replay_paced,
        """SELECT number, number // 11 AS step, tweet_id, text FROM (
               SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS number,
                      CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS tweet_id, text
               FROM conversations)""",
    ),
    "acknowledged_delivery": (
        acknowledged_delivery,
        f"""{MESSAGES_SQL} SELECT tweet_id,
                CASE WHEN CAST(tweet_id AS BIGINT) % 13 = 0 THEN 'rejected' ELSE 'sent' END AS state
            FROM messages""",
    ),
    "replay_messages": (
        replay_messages,
        """SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS tweet_id, text FROM conversations""",
    ),
    "minute_counts": (
        minute_counts,
        f"""{MESSAGES_SQL} SELECT strftime(sent, '%Y-%m-%d %H:%M') AS minute, count(*) AS n_messages
            FROM messages GROUP BY 1""",
    ),
}
