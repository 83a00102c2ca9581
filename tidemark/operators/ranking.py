"""Rankings: first or best rows per key, and global top k."""

from pyspark.sql import Window
from pyspark.sql import functions as F


# Slices of a group that is ranked in two steps.
SLICES = 256
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def _first_rows(df, keys, order, n, name):
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)


def top_n_per_group(df, keys, order, n, rank=None, slices=SLICES):
    """Keep the `n` first rows of every group, in `order`.

    The rank filter sits directly on `row_number`, so for small `n` Spark keeps at most `n` rows per group and map
    task before the shuffle (`WindowGroupLimit`). From the session's threshold for that on, groups are ranked in two
    steps instead: first within slices of a group, by a hash of the row and its task, then over the first `n` rows
    of each of at most `slices` slices. Either way a hot group is spread over tasks and never reaches one
    whole, whatever the session's settings are. End `order` in a unique key, or ties fall at random.

    `rank` names an output column for the position; without it the position is dropped.
    """
    name = rank or "_position"
    if n >= int(df.sparkSession.conf.get(GROUP_LIMIT)):
        # Maps and variants have no hash.
        parts = [F.col(f.name) for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
        piece = F.pmod(F.xxhash64(F.spark_partition_id(), *parts), F.lit(slices))
        df = _first_rows(df.withColumn("_slice", piece), [*keys, "_slice"], order, n, name).drop("_slice", name)
    ranked = _first_rows(df, keys, order, n, name)
    return ranked.withColumn(rank, F.col(rank).cast("long")) if rank else ranked.drop(name)


def first_per_key(df, keys, order):
    """Keep one row per key: the first in `order`."""
    return top_n_per_group(df, keys, order, 1)


def top_k(df, order, k=None, rank=None):
    """The first `k` rows in `order`; with `k` None or 0 all rows, unsorted.

    `rank` names an output column for the position among the `k` rows, which are in one
    place already.
    """
    if not k:
        return df
    top = df.orderBy(*order).limit(k)
    return top.withColumn(rank, F.row_number().over(Window.orderBy(*order)).cast("long")) if rank else top
