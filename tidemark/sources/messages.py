"""Message topics. The connector is named here only; the rest works on a `value` column.

The Kafka connector is a separate package for `spark-submit --packages`; it is not part of
the PySpark distribution.
"""

from tidemark.fixed import TOPIC


def message_reader(
    spark,
    servers,
    topic=TOPIC,
    group=None,
    starting_offsets="latest",
    max_offsets_per_trigger=None,
):
    """Stream of a topic's records. Progress lives in the query's checkpoint.

    `max_offsets_per_trigger` bounds a micro-batch when there is a backlog. Name a consumer
    `group` only if the brokers ask for one: queries that share it may each read a part.
    """
    reader = spark.readStream.format("kafka").options(
        **{
            "kafka.bootstrap.servers": servers,
            "subscribe": topic,
            "startingOffsets": starting_offsets,
        }
    )
    if group:
        reader = reader.option("kafka.group.id", group)
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def message_writer(df, servers, topic=TOPIC):
    """Batch or stream writer of unkeyed records; every record waits for full acknowledgement."""
    writer = df.writeStream if df.isStreaming else df.write
    return writer.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all"}
    )
