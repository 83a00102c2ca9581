"""Views of the given parquet tables in the shape of the input files.

`videos` reads each event as one snapshot of the video that belongs to the event's user.
The values are text, as in a CSV file, so that the plans parse and cast them themselves.
"""

import os

from pyspark.sql import functions as F

from tidemark.fixed import MESSAGE_TIME_FORMAT, SECONDS_BETWEEN_MESSAGES, SNAPSHOT_DATE_FORMAT

# Columns of `videos` that need the join to customer, and on to nation.
FROM_CUSTOMER = {"title", "description", "channel_title", "category_id"}
FROM_NATION = {"channel_title", "category_id"}


def table(spark, folder, name):
    """One of the given tables."""
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def videos(spark, folder, *columns):
    """Text snapshot rows. Name the needed columns to skip joins that they do not need.

    The joins are left joins, so leaving them out changes no row. Neither side is hinted:
    Spark broadcasts by size, and splits a hot user if it has to shuffle.
    """
    rows = table(spark, folder, "events")
    wanted = set(columns) or FROM_CUSTOMER
    if wanted & FROM_CUSTOMER:
        customer = table(spark, folder, "customer")
        rows = rows.join(customer, F.col("user_id") == F.col("c_custkey"), "left")
    if wanted & FROM_NATION:
        nation = table(spark, folder, "nation")
        rows = rows.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    event_id = F.col("event_id")
    kind = F.concat(F.lit('"'), "event_type", F.lit('"'))
    shape = {
        "video_id": F.col("user_id").cast("string"),
        "trending_date": F.date_format("ts", SNAPSHOT_DATE_FORMAT),
        "views": (F.round(F.col("value") * 100).cast("long") * 100).cast("string"),
        "likes": (event_id % 97).cast("string"),
        "dislikes": (event_id % 7).cast("string"),
        "tags": F.concat(kind, F.lit('|"k'), (event_id % 20).cast("string"), F.lit('"|'), kind),
        "title": F.col("c_name"),
        "description": F.concat(
            "c_mktsegment", F.when(event_id % 11 == 0, F.lit(" v2")).otherwise(F.lit(""))
        ),
        "channel_title": F.when(event_id % 50 == 0, F.lit("REUPLOAD")).otherwise(F.col("n_name")),
        "category_id": F.col("n_regionkey").cast("string"),
    }
    return rows.select(*[shape[c].alias(c) for c in columns or shape])


def categories(spark, folder):
    """Dimension (id, title)."""
    return table(spark, folder, "region").select(
        F.col("r_regionkey").cast("string").alias("id"), F.col("r_name").alias("title")
    )


def transactions(spark, folder):
    """Orders in the shape of transaction records."""
    price = F.col("o_totalprice")
    return table(spark, folder, "orders").select(
        (F.col("o_orderkey") % 744).cast("int").alias("step"),
        F.col("o_orderpriority").alias("type"),
        price.alias("amount"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("nameOrig"),
        price.alias("oldbalanceOrg"),
        F.lit(0.0).alias("newbalanceOrig"),
        F.concat(F.lit("M"), F.col("o_orderkey").cast("string")).alias("nameDest"),
        F.lit(0.0).alias("oldbalanceDest"),
        price.alias("newbalanceDest"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("isFraud"),
        F.lit(0).alias("isFlaggedFraud"),
    )


def tweets(spark, folder):
    """Conversation turns in the shape of tweet records; the texts hold line breaks."""
    name = F.concat_ws("-", "conv_id", "turn")
    return table(spark, folder, "conversations").select(
        name.alias("tweet_id"),
        F.col("role").alias("author_id"),
        F.when(F.col("role") == "user", "True").otherwise("False").alias("inbound"),
        F.lit(None).cast("string").alias("created_at"),
        F.col("text"),
        F.lit(None).cast("string").alias("response_tweet_id"),
        F.lit(None).cast("string").alias("in_response_to_tweet_id"),
    )


def messages(spark, folder):
    """Events as messages, stamped as a replay from 2024-01-01 at the fixed pace would do.

    The text holds commas, quotes and a line break.
    """
    millis = F.col("event_id") * int(SECONDS_BETWEEN_MESSAGES * 1000)
    sent = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.floor(millis / 1000))
    return table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("tweet_id"),
        F.date_format(sent, MESSAGE_TIME_FORMAT).alias("created_at"),
        F.concat(F.lit(' said "'), "event_type", F.lit('",\n'), "props", F.lit(" ")).alias("text"),
    )
