"""Acknowledged delivery: a log of sent batches, and a folder for records that cannot be sent."""

import json
import os

from pyspark.sql import functions as F

from tidemark.session import exists, file_names, write_text_once

# Largest record that brokers take by default.
MOST_BYTES = 1_000_000


def acknowledged(send, folder, attempts=2, most_bytes=MOST_BYTES):
    """Function for `foreachBatch` (and for `replay_paced`) that sends the `value` records of a batch and logs it.

    A batch whose log entry is there has been acknowledged and is not sent again. Records without a value or beyond
    `most_bytes` cannot be sent: they are set aside in `folder/rejected/batch=<id>` before the others leave. If the
    sender fails, the batch is sent again up to `attempts` times in all; then the query stops with the error, and a
    restart sends the batch anew. A crash between sending and logging also sends it again, with the same id:
    senders that replace a batch by its id then keep every record exactly once.
    """

    def deliver(messages, batch_id):
        spark = messages.sparkSession
        entry = os.path.join(folder, "log", f"{batch_id:012}.json")
        if exists(spark, entry):
            return
        sendable = F.coalesce(F.octet_length("value") <= most_bytes, F.lit(False))
        counts = messages.agg(F.count_if(sendable).alias("sent"), F.count_if(~sendable).alias("rejected")).first()
        if counts.rejected:
            path = os.path.join(folder, "rejected", f"batch={batch_id}")
            messages.where(~sendable).write.mode("overwrite").parquet(path)
        tried = 0
        while counts.sent:
            tried += 1
            try:
                send(messages.where(sendable), batch_id)
                break
            except Exception:
                if tried >= attempts:
                    raise
        write_text_once(spark, entry, json.dumps({"batch": batch_id, "sent": counts.sent, "rejected": counts.rejected, "attempts": tried}))

    return deliver


def start_acknowledged(messages, checkpoint, send, folder, attempts=2, most_bytes=MOST_BYTES, **trigger):
    """Start a stream of `value` records into a sender with `acknowledged` delivery."""
    writer = messages.writeStream.foreachBatch(acknowledged(send, folder, attempts, most_bytes))
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def sent_batches(spark, folder):
    """The log: one row (batch, sent, rejected, attempts) per acknowledged batch."""
    schema = "batch long, sent long, rejected long, attempts long"
    names = file_names(spark, os.path.join(folder, "log"), ".json")
    return spark.read.schema(schema).json(os.path.join(folder, "log")) if names else spark.createDataFrame([], schema)


def rejected_records(spark, folder, schema="value string"):
    """The records set aside, with their batch."""
    path = os.path.join(folder, "rejected")
    if not exists(spark, path):
        return spark.createDataFrame([], f"{schema}, batch long")
    return spark.read.schema(f"{schema}, batch long").parquet(path)
