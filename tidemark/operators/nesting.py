"""Nested documents whose arrays stay bounded."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.joins import null_safe_join
from tidemark.session import work_folder

# Array length of a full page.
MAX_ITEMS = 100_000


def repeated(pairs):
    """Array of the items of sorted (item, times) pairs, each as often as it counts."""
    return F.flatten(F.transform(pairs, lambda p: F.array_repeat(p["item"], p["times"])))


def nest(df, keys, item, name, copies=None, max_items=MAX_ITEMS):
    """Gather `item` values per key into pages: rows with `part` and a sorted array `name`.

    One rule for every group size: page p holds the values at positions p * `max_items` to
    p * `max_items` + `max_items` - 1 in item order, copies included. Nulls are left out, as
    in `collect_list`; a group of nulls has one empty page. `copies` names a column that says
    how often a row counts.

    Equal values are counted before the shuffle and repeated only in their page, after all shuffles. Positions come
    from a sort by range: running counts within each range of a group, and the counts of
    the ranges before it, of which there are as many as partitions. The sorted counts are
    written to the shared folder, so both are taken of the same ranges; no task sees more of a hot
    group than one range of it.
    """
    return nest_pairs(df, keys, item, name, copies, max_items).withColumn(name, repeated(name))


def nest_pairs(df, keys, item, name, copies=None, max_items=MAX_ITEMS):
    """The pages of `nest` with (item, times) pairs in place of the items: shorter, if more shuffles follow."""
    spark = df.sparkSession
    count = F.when(F.col("_item").isNotNull(), F.col(copies) if copies else F.lit(1)).otherwise(0)
    packed = (
        df.withColumn("_item", item)
        .select(*keys, "_item", count.cast("long").alias("_n"))
        .groupBy(*keys, "_item")
        .agg(F.sum("_n").alias("_n"))
        # By hash of the keys: keys may be long texts, and ranges are found from a sample in the driver.
        .repartitionByRange(F.xxhash64(*keys), "_item")
        .withColumn("_range", F.spark_partition_id())
    )
    path = work_folder(spark, "pages")
    packed.write.parquet(path)
    packed = spark.read.parquet(path)
    ahead = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = packed.groupBy(*keys, "_range").agg(F.sum("_n").alias("_sum"))
    ranges = ranges.withColumn("_offset", F.coalesce(F.sum("_sum").over(ahead), F.lit(0))).drop("_sum")
    before = Window.partitionBy(*keys, "_range").orderBy("_item").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("_offset") + F.coalesce(F.sum("_n").over(before), F.lit(0))
    last_page = F.floor((F.col("_first") + F.greatest(F.col("_n"), F.lit(1)) - 1) / max_items)
    pages = (
        null_safe_join(packed, ranges, [*keys, "_range"])
        .withColumn("_first", first)
        .withColumn("part", F.explode(F.sequence(F.floor(F.col("_first") / max_items), last_page)))
        .withColumn(
            "_n",
            F.least(F.col("_first") + F.col("_n"), (F.col("part") + 1) * max_items)
            - F.greatest(F.col("_first"), F.col("part") * max_items),
        )
    )
    # A value stands once in a page.
    pair = F.struct(F.col("_item").alias("item"), F.col("_n").cast("int").alias("times"))
    return pages.groupBy(*keys, "part").agg(F.sort_array(F.collect_list(pair)).alias(name))


# Columns that stay beside a document: its position among the documents, and its page.
BESIDE = ("rank", "part")


def as_document(df, name, **fields):
    """Wrap the row into one struct column `name`; `fields` maps field names to columns.

    `rank` and `part` stay beside the document where the frame has them.
    """
    fields = fields or {c: c for c in df.columns if c not in BESIDE}
    document = F.struct(*[F.col(c).alias(f) for f, c in fields.items()]).alias(name)
    return df.select(document, *[c for c in BESIDE if c in df.columns])
