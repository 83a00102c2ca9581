"""Table profile."""

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

PROFILE = "position int, column string, type string, n_rows long, n_nulls long, least string, greatest string"
# Types without an order.
UNORDERED = (T.MapType, T.VariantType)


def row_count(df):
    """Number of rows as a frame; the scan reads no columns."""
    return df.agg(F.count("*").alias("n_rows"))


def observed(df):
    """The frame with an observation of its rows, and of nulls and extremes of each column.

    Whatever action runs the frame takes the figures on the way: no second scan and no shuffle. Names of metrics are
    positions, so any column name will do.
    """
    found = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    for i, field in enumerate(df.schema.fields):
        column = F.col(f"`{field.name.replace('`', '``')}`")
        metrics.append(F.count_if(column.isNull()).alias(f"nulls_{i}"))
        if not isinstance(field.dataType, UNORDERED):
            extremes = F.min(column).cast("string"), F.max(column).cast("string")
            metrics += [value.alias(f"{name}_{i}") for name, value in zip(("least", "greatest"), extremes)]
    return df.observe(found, *metrics), found


def profile_of(spark, schema, found):
    """Frame with one row per column of an observation whose action has run."""
    seen = found.get
    rows = [
        (i, field.name, field.dataType.simpleString(), seen["rows"], seen[f"nulls_{i}"], seen.get(f"least_{i}"), seen.get(f"greatest_{i}"))
        for i, field in enumerate(schema.fields)
    ]
    return spark.createDataFrame(rows, PROFILE)


def write_profiled(df, path, mode="error"):
    """Write a frame as parquet and return its profile, both in one pass over it.

    An empty frame has zero rows and null extremes. Extremes are text; maps and variants have none.
    """
    rows, found = observed(df)
    rows.write.mode(mode).parquet(path)
    return profile_of(df.sparkSession, df.schema, found)


def preview(df, n=20, truncate=False):
    """Print schema, first rows and row count; return the count."""
    df.printSchema()
    df.show(n, truncate)
    count = df.count()
    print(f"{count:,} rows in total")
    return count
