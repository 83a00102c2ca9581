"""Equi-joins. Which side may be broadcast is decided by a known row bound or by Spark."""

from functools import reduce

from pyspark.sql import functions as F

# A side is hinted for broadcast only when its row count is bounded by the plan itself
# (a top-k, or one row per calendar week) and that bound is no larger than this.
BROADCAST_ROWS = 10_000


def null_safe_join(left, right, keys, how="inner"):
    """Join on equally named keys, where null matches null. Keys come from the left."""
    renamed = right.select(
        *[F.col(k).alias(f"_right_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    condition = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    )
    joined = left.join(renamed, condition, how)
    return joined if how == "left_semi" else joined.drop(*[f"_right_{k}" for k in keys])


def join_small(df, small, keys, rows=None, how="inner"):
    """Null-safe join to a frame that holds at most `rows` rows.

    Up to `BROADCAST_ROWS` the small side is broadcast and `df` is not shuffled. With a
    larger bound, or none, Spark picks the join by size, and adaptive execution splits
    skewed keys.
    """
    bounded = bool(rows) and rows <= BROADCAST_ROWS
    return null_safe_join(df, F.broadcast(small) if bounded else small, keys, how)


def with_name(df, dimension, key, name="category_name"):
    """Left join to a dimension (id, title). An unknown key keeps its row, with a null name.

    There is no hint: Spark broadcasts the dimension if its size is below
    `spark.sql.autoBroadcastJoinThreshold` and shuffles both sides otherwise.
    """
    titles = dimension.select(F.col("id").alias("_id"), F.col("title").alias(name))
    return df.join(titles, F.col(key) == F.col("_id"), "left").drop("_id")
