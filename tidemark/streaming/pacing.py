"""Messages at an even pace: a numbered table that a counting clock reads step by step."""

import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.fixed import SECONDS_BETWEEN_MESSAGES
from tidemark.session import exists, work_folder
from tidemark.streaming.messages import encode_messages

BLOCK_ROWS = 100_000
# Bits of `monotonically_increasing_id` that count within a partition.
ROW_BITS = (1 << 33) - 1
ROWS, SIZES = "rows", "sizes"


def number_rows(rows, folder, block_rows=BLOCK_ROWS):
    """Write rows with a gapless `number` from 0, in the order of their files and lines.

    The table is partitioned by `block`, `block_rows` numbers each, so a step reads a bounded part of it.
    Positions within the ordered partitions are written first; one count per partition then gives the
    offsets, so nothing is numbered in one task. A finished folder is left as it is: a restarted replay
    goes on with the same numbers. The sizes (rows in all, rows per block) lie beside it and are written last. An empty
    frame gives an empty table.
    """
    spark = rows.sparkSession
    if exists(spark, os.path.join(folder, SIZES, "_SUCCESS")):
        return
    order = {"_file": F.input_file_name(), "_line": F.monotonically_increasing_id()}
    placed = rows.withColumns(order).orderBy("_file", "_line").drop("_file", "_line")
    at = F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS))
    path = work_folder(spark, "placed")
    placed.withColumns({"_part": F.spark_partition_id(), "_at": at}).write.parquet(path)
    placed = spark.read.parquet(path)
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the ordered frame.
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_first"))
    numbered = placed.join(F.broadcast(offsets), "_part").withColumn("number", F.col("_first") + F.col("_at"))
    numbered = numbered.withColumn("block", F.expr(f"number div {block_rows}")).drop("_part", "_at", "_first")
    numbered.write.mode("overwrite").partitionBy("block").parquet(os.path.join(folder, ROWS))
    sizes = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total")).withColumn("block_rows", F.lit(block_rows))
    sizes.write.mode("overwrite").parquet(os.path.join(folder, SIZES))


def messages_per_step(seconds=SECONDS_BETWEEN_MESSAGES):
    """Messages that leave together: as many as are due in one second at most, one at least."""
    return max(1, int(1 / seconds + 1e-9))


class PacedReplay:
    """A running replay of a numbered table.

    `send` is a function of a frame (number, step, value) in order of the numbers and of the batch id; a batch that was
    cut short comes again with the same id and the same numbers.
    """

    def __init__(self, spark, table, checkpoint, send, seconds=SECONDS_BETWEEN_MESSAGES, steps_per_batch=None, created_at=None):
        self.table, self.send, self.created_at = table, send, created_at
        self.per_step = messages_per_step(seconds)
        self.rows = self.per_step * (steps_per_batch or 1)
        self.total, self.block_rows = spark.read.parquet(os.path.join(table, SIZES)).first()
        self.done = False
        clock = spark.readStream.format("rate-micro-batch").options(rowsPerBatch=self.rows, numPartitions=1).load()
        writer = clock.select(F.col("value").alias("number")).writeStream.foreachBatch(self._deliver)
        self.writer = writer.option("checkpointLocation", checkpoint)
        # Without steps per batch the clock ticks at the pace; with them one batch follows the other.
        self.paced = not steps_per_batch
        pause = round(self.per_step * seconds * 1000)
        self.trigger = {"processingTime": f"{pause} milliseconds"} if self.paced else {"availableNow": True}
        self.query = self.writer.trigger(**self.trigger).start()

    def _deliver(self, numbers, batch_id):
        low, high = numbers.agg(F.min("number"), F.max("number")).first()
        if low is None or low >= self.total:
            # The batch before this one is committed, so everything has been sent.
            self.done = True
            return
        first_block, last_block = low // self.block_rows, high // self.block_rows
        table = numbers.sparkSession.read.parquet(os.path.join(self.table, ROWS))
        due = table.where(F.col("block").between(first_block, last_block) & F.col("number").between(low, high))
        # The clock's side has `rows` rows; the table's side is pruned by block and number before the join.
        rows = due.join(F.broadcast(numbers), "number")
        message = encode_messages(rows, self.created_at, keep=["number"])
        step = F.expr(f"number div {self.per_step}").alias("step")
        self.send(message.select("number", step, "value").orderBy("number"), batch_id)

    def wait(self):
        """Until all messages have been sent, or the query fails."""
        try:
            while not self.done:
                if not self.query.isActive:
                    if self.query.exception():
                        raise self.query.exception()
                    if self.paced:
                        return
                    # A run without pauses ends after each batch; the next one goes on from its commit.
                    self.query = self.writer.trigger(**self.trigger).start()
                self.query.awaitTermination(0.2 if self.paced else None)
        finally:
            self.query.stop()


def replay_paced(spark, tweets, progress, send, seconds=SECONDS_BETWEEN_MESSAGES, steps_per_batch=None, created_at=None):
    """Start an even replay of a tweet frame.

    One message leaves every `seconds` on average, and never more together than are due in one second. The numbered
    table and the checkpoint live below `progress`: started again with the same folder, the replay goes on at the
    next number. `steps_per_batch` sends that many steps at once without waiting, for a replay that need not be paced.
    """
    table = os.path.join(progress, "numbered")
    number_rows(tweets, table)
    return PacedReplay(spark, table, os.path.join(progress, "clock"), send, seconds, steps_per_batch, created_at)


def folder_sender(folder):
    """Sender into one folder per batch, in place of a topic; a batch that comes again replaces its own folder."""
    return lambda messages, batch_id: messages.write.mode("overwrite").parquet(os.path.join(folder, f"batch={batch_id}"))


def topic_sender(writer):
    """Sender through a batch writer, a function from a `value` frame to a `DataFrameWriter`, as `message_writer` is."""
    return lambda messages, batch_id: writer(messages.select("value")).save()
