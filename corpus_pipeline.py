"""A training corpus from `documents` in five stages, each over all that the one before it kept."""

import os
from functools import wraps

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import near_dup, pieces, secrets, toxicity, wu_manber
from tidemark.llm.arrays import HashSet
from tidemark.llm.batches import small_batches
from tidemark.session import work_folder
from tidemark.sources import table

PIECE_MODEL = "piece_bpe_32k.model"
SHINGLE_WORDS = 5


def _kept(df, name):
    """The rows, written to the shared folder and read back."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_toxic(spark, docs, sf_dir):
    """Documents whose toxicity score is below one half. Learns from labelled rows of `docs`.

    Every row is judged by its own text, null and empty ones like texts without words, very long ones whole; repeated ids
    and rows without id are no special case.
    """
    learned = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0
    model = toxicity.fit(*toxicity.labelled_sample(docs, table(spark, sf_dir, "labels").filter(learned)))
    return docs.filter(toxicity.scorer(model)("text") < 0.5)


def _with_keys(docs):
    """The documents with a column `_key` that tells different texts apart: the id, or a number of its own beyond all
    usual ids for the further texts of an id that stands on several."""
    mark = F.coalesce(F.xxhash64("text"), F.lit(0))
    marks = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.min(mark).alias("_first"), F.max(mark).alias("_last"))
    marks = _kept(marks.filter("_first <> _last").select("doc_id", "_first"), "shared-ids")
    if marks.isEmpty():
        return docs.withColumn("_key", F.col("doc_id"))
    further = F.xxhash64("doc_id", mark).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    key = F.when(F.col("_first").isNull() | (F.col("_first") == mark), F.col("doc_id")).otherwise(further)
    return docs.join(marks, "doc_id", "left").withColumn("_key", key).select(*docs.columns, "_key")


def _without(docs, keys):
    """The rows whose `_key` is not among `keys`, or null. The keys go to files that tasks map, so no text is shuffled.

    xxhash64 takes different longs to different longs, so the test is exact, and spreads them over the files.
    """
    marks = HashSet(_kept(keys.select(F.xxhash64("_key").alias("mark")).distinct(), "dropped-keys"), "mark")

    @F.arrow_udf("boolean")
    def dropped(values: pa.Array) -> pa.Array:
        return pa.array(marks.contains(values.to_numpy(zero_copy_only=False).view(np.uint64)))

    return docs.filter(F.col("_key").isNull() | ~dropped(F.xxhash64("_key")))


def drop_near_copies(spark, docs, sf_dir):
    """One document of each group of near copies, that with the smallest id.

    Decisions are taken and applied per text: where an id stands on different texts, each is judged by itself, and
    those after the first (by hash) come last among copies. Of rows with equal id and text one stays. Rows without id stay, and so do
    texts that are null or have no words.
    """
    keyed = _with_keys(docs)
    found = _kept(near_dup.near_duplicates(keyed, size=SHINGLE_WORDS, id_col="_key"), "near-copies")
    copies = found.filter("not kept").select("_key")
    repeated = found.filter("kept and _key is not null").groupBy("_key").count().filter("count > 1").select("_key")
    repeated = _kept(repeated, "repeated-ids")
    keyed = _without(keyed, copies)
    if repeated.isEmpty():
        return keyed.select(docs.columns)
    first = F.min(F.struct("text", *[c for c in docs.columns if c != "text"])).alias("row")
    one = keyed.join(repeated, "_key", "left_semi").groupBy("_key").agg(first)
    one = one.select(*[F.col(f"row.{c}") for c in docs.columns])
    return keyed.join(repeated, "_key", "left_anti").select(docs.columns).union(one)


def drop_contaminated(spark, docs, sf_dir):
    """Documents without any window of a benchmark item.

    Texts that are null or have no words hold none and stay; very long texts are searched whole. Every row is judged
    by its own text, whatever its id. Items without words match nothing.
    """
    find = wu_manber.finder(table(spark, sf_dir, "benchmark"))
    return docs.filter(F.size(find("text").getField("items")) == 0)


def mask_secrets(spark, docs, sf_dir):
    """All documents, with secrets masked and `n_chars` counted again where a text changed.

    Null texts stay null, very long ones are scanned whole, and every row is masked by itself, whatever its id.
    """
    model = secrets.train(docs, secrets.silver_findings(docs))
    masked = secrets.masker(model)(docs["text"]).alias("masked")
    rows = docs.select(F.struct(*docs.columns).alias("row"), masked)
    length = F.when(F.col("masked") != F.col("row.text"), F.length("masked")).otherwise(F.col("row.n_chars"))
    new = {"text": F.col("masked"), "n_chars": length.cast(docs.schema["n_chars"].dataType)}
    return rows.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def encode_pieces(spark, docs, sf_dir):
    """Ids of every text, their number, and whether decoding gives the text back.

    Null texts are encoded like empty ones, very long ones whole; rows with equal ids are encoded one by one.
    """
    model = pieces.read_model(public_tokenizers.path(PIECE_MODEL))
    coded = docs.withColumn("coded", pieces.round_tripper(model)("text"))
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.size("coded.ids").cast("long").alias("n_tokens"),
        "coded.ids",
        (F.col("coded.decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def bounded(stage):
    """The stage with bounded Arrow batches."""

    @wraps(stage)
    def run_stage(spark, docs, sf_dir):
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("toxicity", bounded(drop_toxic)),
    ("near_dedup", bounded(drop_near_copies)),
    ("decontamination", bounded(drop_contaminated)),
    ("secrets", bounded(mask_secrets)),
    ("pieces", bounded(encode_pieces)),
]

# Scores of compression lengths and a trained forest have no counterpart in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply all stages to `documents`; each result is written and read back."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES:
        path = work_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
