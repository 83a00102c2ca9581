"""JSON documents whose fields are found by reading, held as variants."""

from pyspark.sql import functions as F


def read_documents(spark, path, multiline=True):
    """One row (document, file) per JSON document; no schema is declared, and no field is lost.

    With `multiline` a file is one document over any number of lines, or an array of documents; without it every line is one.
    Text that is no JSON gives a row with a null document.
    """
    reader = spark.read.option("singleVariantColumn", "document").option("multiLine", multiline)
    return reader.json(path).withColumn("file", F.col("_metadata.file_path"))


def parse_documents(df, text="value"):
    """The rows with a variant `document` of a JSON text column; null where the text is null or no JSON."""
    return df.withColumn("document", F.try_parse_json(text))


def found_schema(df, document="document"):
    """One row (n_documents, schema): the fields of all documents and their types, as text.

    Combines map-side, so only schemas are shuffled. Fields that some documents lack are part of it; those of different types
    widen, at worst to `VARIANT`. Null where there is no document.
    """
    return df.agg(F.count(document).alias("n_documents"), F.schema_of_variant_agg(document).alias("schema"))


def explode_items(df, path="$.items", document="document", keep=()):
    """One row (position, item) per element of the array, or (key, item) per field of the object, at `path`.

    Documents without it, or with another kind of value there, give no row. Columns to `keep` stay beside.
    """
    inner = df.select(*keep, F.try_variant_get(document, path, "variant").alias("_items"))
    items = inner.sparkSession.tvf.variant_explode(F.col("_items").outer())
    return inner.lateralJoin(items).select(*keep, F.col("pos").alias("position"), "key", F.col("value").alias("item"))


def item_fields(df, fields, item="item", keep=()):
    """Typed columns of variants: `fields` maps names to (path, type). Null where a path is missing or does not convert."""
    return df.select(*keep, *[F.try_variant_get(item, path, kind).alias(name) for name, (path, kind) in fields.items()])


def read_category_items(spark, path):
    """Category documents as rows (id, title), like `read_categories`, without a declared schema."""
    items = explode_items(read_documents(spark, path))
    return item_fields(items, {"id": ("$.id", "string"), "title": ("$.snippet.title", "string")})
