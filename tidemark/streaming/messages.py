"""JSON messages in a `value` column. Everything here works on batch and stream frames."""

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import utc_now_text


def encode_messages(df, created_at=None, keep=()):
    """One JSON text per row from `tweet_id` and `text`, beside the columns to `keep`.

    `created_at` names a column with the time text; without it the time of sending is used.
    """
    stamp = F.col(created_at) if created_at else utc_now_text()
    message = F.struct("tweet_id", stamp.alias("created_at"), "text")
    return df.select(*keep, F.to_json(message, {"ignoreNullFields": "false"}).alias("value"))


def decode_messages(df, schema=schemas.MESSAGE, mode="PERMISSIVE", keep=()):
    """Message fields of each record, beside the columns to `keep`. Text that is no JSON gives a row of nulls, or stops the
    job with `mode="FAILFAST"`."""
    message = F.from_json(F.col("value").cast("string"), schema, {"mode": mode})
    return df.select(*keep, message.alias("message")).select(*keep, "message.*")


def read_message_files(spark, folder, files_per_trigger=None):
    """Stream of text files with one message per line, in place of a topic."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)
