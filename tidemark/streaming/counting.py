"""Counts per minute of a live stream, kept in a table that grows by batches."""

import json
import os

from pyspark.sql import functions as F

from tidemark.fixed import MESSAGE_TIME_FORMAT
from tidemark.session import exists, file_names, read_text, write_text_once

COUNTS = "minute timestamp, n_messages long, n_late long"
MERGE_EVERY = 100


def _state(spark, folder, batch_id=None):
    """Newest state file before a batch: {"batch", "base", "newest"}; later ones are of a run cut short."""
    names = [name for name in file_names(spark, os.path.join(folder, "state"), ".json")]
    if batch_id is not None:
        names = [name for name in names if int(name.split(".")[0]) < batch_id]
    return json.loads(read_text(spark, os.path.join(folder, "state", names[-1]))) if names else {"batch": -1, "base": -1, "newest": None}


def _batch_counts(messages, newest):
    """Messages per minute of one batch, and how many of them are older than the newest minute known before."""
    minute = F.date_trunc("minute", F.try_to_timestamp("created_at", F.lit(MESSAGE_TIME_FORMAT)))
    late = F.lit(False) if newest is None else F.coalesce(F.col("minute") < F.timestamp_seconds(F.lit(newest)), F.lit(False))
    counts = messages.select(minute.alias("minute")).groupBy("minute").agg(F.count("*").alias("n_messages"))
    return counts.withColumn("n_late", F.when(late, F.col("n_messages")).otherwise(0).cast("long"))


def add_minute_counts(folder, merge_every=MERGE_EVERY):
    """Function for `foreachBatch` that adds a batch's counts per minute to the table in `folder`.

    The rows of a batch lie in a folder of its id, which a batch that comes again replaces, so a replay changes
    nothing. A state file per batch, written whole or not at all, names the newest minute, which tells late messages,
    and the base: all batches up to it, merged. Readers follow the newest state file only.
    """

    def add(messages, batch_id):
        spark = messages.sparkSession
        before = _state(spark, folder, batch_id)
        path = os.path.join(folder, f"batch={batch_id}")
        _batch_counts(messages, before["newest"]).write.mode("overwrite").parquet(path)
        newest = spark.read.schema(COUNTS).parquet(path).agg(F.max(F.unix_timestamp("minute"))).first()[0]
        newest = max((n for n in (newest, before["newest"]) if n is not None), default=None)
        base = before["base"]
        if batch_id - base >= merge_every:
            merged = _sums(_rows(spark, folder, {"batch": batch_id, "base": base}))
            merged.write.mode("overwrite").parquet(os.path.join(folder, f"base={batch_id}"))
            base = batch_id
        state = os.path.join(folder, "state", f"{batch_id:012}.json")
        write_text_once(spark, state, json.dumps({"batch": batch_id, "base": base, "newest": newest}))

    return add


def _rows(spark, folder, state):
    """Rows of the base and of all batches after it."""
    names = [f"batch={i}" for i in range(state["base"] + 1, state["batch"] + 1)]
    names += [f"base={state['base']}"] if state["base"] >= 0 else []
    paths = [os.path.join(folder, name) for name in names]
    paths = [path for path in paths if exists(spark, path)]
    return spark.read.schema(COUNTS).parquet(*paths) if paths else spark.createDataFrame([], COUNTS)


def _sums(rows):
    return rows.groupBy("minute").agg(F.sum("n_messages").alias("n_messages"), F.sum("n_late").alias("n_late"))


def write_minute_counts(messages, folder, checkpoint, merge_every=MERGE_EVERY, **trigger):
    """Start a stream that keeps the table; minutes that are still open are in it after every batch, so a stop loses none."""
    writer = messages.writeStream.foreachBatch(add_minute_counts(folder, merge_every)).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 minute"})).start()


def read_minute_counts(spark, folder):
    """Rows (minute, n_messages, n_late); messages whose time cannot be parsed count under a null minute."""
    return _sums(_rows(spark, folder, _state(spark, folder)))
