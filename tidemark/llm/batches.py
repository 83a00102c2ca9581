"""Bound of the Arrow batches between Spark and Python."""

BATCH_BYTES = 4 << 20


def small_batches(spark):
    """Let no batch hold more than `BATCH_BYTES` (or one row that is longer).

    Spark's own bound is on rows, which says nothing about memory where texts may be long.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
