"""CSV, JSON and parquet files."""

from pyspark.sql import functions as F

from tidemark import schemas

# Quotes inside a field are doubled, and spaces at its ends belong to it (the writer would
# trim them otherwise).
CSV_OPTIONS = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def _read_csv(spark, path, schema, multiline):
    return spark.read.options(header=True, multiLine=multiline, **CSV_OPTIONS).schema(schema).csv(path)


def read_videos(spark, path, schema=None):
    """Snapshot CSV with every column as text; columns are found by header name.

    Files with line breaks inside fields cannot be split, so each file is one task: give a
    folder of many files, and convert it once with `write_table`. Without `schema` the
    header of the first file decides the columns, which suits files with extra columns.
    """
    reader = spark.read.options(header=True, multiLine=True, **CSV_OPTIONS)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_tweets(spark, path):
    """Quoted tweet CSV; text may hold commas, quotes and line breaks."""
    return _read_csv(spark, path, schemas.TWEETS_CSV, multiline=True)


def read_transactions(spark, path):
    """Transaction CSV with its fixed schema. One record per line, so files split."""
    return _read_csv(spark, path, schemas.TRANSACTIONS_CSV, multiline=False)


def read_categories(spark, path):
    """Category JSON (one document per file) as rows of (id, title)."""
    documents = spark.read.schema(schemas.CATEGORIES_JSON).json(path, multiLine=True)
    return flatten_categories(documents)


def flatten_categories(documents):
    """Parallel id and title arrays of each document, zipped to rows."""
    pairs = F.arrays_zip(F.col("items.id").alias("id"), F.col("items.snippet.title").alias("title"))
    return documents.select(F.explode(pairs).alias("pair")).select("pair.id", "pair.title")


def write_csv(df, path, header=True, mode="error"):
    """CSV that `read_*` gives back unchanged."""
    df.write.mode(mode).options(header=header, **CSV_OPTIONS).csv(path)


def write_table(df, path, mode="error"):
    """Write a normalised frame once as parquet, so later scans prune columns and split."""
    df.write.mode(mode).parquet(path)
    return read_table(df.sparkSession, path)


def read_table(spark, path):
    """Parquet table."""
    return spark.read.parquet(path)
