"""Registered queries of the operators with their production parameters."""

from functools import wraps

import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import (
    cross_polytope,
    hard_negatives,
    kneser_ney,
    multiprobe,
    near_dup,
    periodic_runs,
    pieces,
    secrets,
    sharding,
    sql,
    toxicity,
    url_filter,
    warc,
    wu_manber,
)
from tidemark.llm.batches import small_batches
from tidemark.session import work_folder
from tidemark.sources import table

PIECE_MODEL = "piece_bpe_32k.model"

URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def op1_multiprobe(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return multiprobe.search(vectors, vectors.filter("vec_id % 100 = 0"))


def op2_warc_zstd(spark, folder):
    files = warc.write_archives(table(spark, folder, "pages"), work_folder(spark, "warc"))
    return warc.read_archives(files).select(
        warc.page_of("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of("refers_to").alias("refers_to"),
        "problem",
    )


def op3_forest_secrets(spark, folder):
    docs = table(spark, folder, "documents")
    bucket = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    learned = docs.filter(bucket != 0)
    model = secrets.train(learned, secrets.silver_findings(learned))
    rows = docs.select("doc_id", secrets.scanner(model)("text").alias("found"))
    found = F.filter("found", lambda x: x["probability"] >= 0.5)
    return rows.select(
        "doc_id",
        F.size("found").cast("long").alias("n_candidates"),
        F.size(found).cast("long").alias("n_secrets"),
        found.alias("secrets"),
    )


def op4_wu_manber(spark, folder):
    find = wu_manber.finder(table(spark, folder, "benchmark"))
    hits = F.aggregate("found.spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["first"]))
    rows = table(spark, folder, "documents").select("doc_id", find("text").alias("found"))
    return rows.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        hits.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


def op5_bottom_k(spark, folder):
    return near_dup.near_duplicates(table(spark, folder, "documents"), size=2)


def op6_zstd_distance(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    bucket = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    model = toxicity.fit(*toxicity.labelled_sample(docs, labels.filter(bucket != 0)))
    rows = docs.select("doc_id", (bucket == 0).alias("held_out"), toxicity.scorer(model)("text").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_url_ratio(spark, folder):
    return url_filter.judge_urls(table(spark, folder, "pages"), URL_RULES)


def op8_hash_ring(spark, folder):
    rows = sharding.assign_shards(table(spark, folder, "documents"), shards=16)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op9_pieces(spark, folder):
    model = pieces.read_model(public_tokenizers.path(PIECE_MODEL))
    rows = table(spark, folder, "documents").select("doc_id", pieces.round_tripper(model)("text").alias("coded"))
    rows = rows.select("doc_id", "coded.ids", "coded.decoded")
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op10_kneser_ney(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10)) == 0
    model = kneser_ney.train(docs.filter(F.coalesce(~held_out, F.lit(True))))
    rows = docs.select("doc_id", held_out.alias("held_out"), kneser_ney.scorer(model)("text").alias("s"))
    return rows.select(
        "doc_id",
        "held_out",
        "s.n_tokens",
        "s.n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "s.base_score",
        "s.score",
    )


def op11_run_seeds(spark, folder):
    find = periodic_runs.run_finder(rewrite=periodic_runs.looped)
    key = F.col("doc_id").cast("string")
    rows = table(spark, folder, "documents").select("doc_id", find("text", key).alias("r"))
    rows = rows.select("doc_id", "r", periodic_runs.strongest("r.runs").alias("best"))
    line = lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))
    listed = F.array_join(F.transform("r.runs", line), "")
    return rows.select(
        "doc_id",
        F.size("r.runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("r.collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_bit_planes(spark, folder):
    vectors = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.select("vec_id", "embedding", label.alias("label")), "vec_id % 100 = 0")


def op13_cross_polytope(spark, folder):
    return cross_polytope.near_duplicates(table(spark, folder, "embeddings"))


def _bounded(query):
    """The query with bounded Arrow batches."""

    @wraps(query)
    def run(spark, folder):
        small_batches(spark)
        return query(spark, folder)

    return run


_QUERIES = {
    "op1_multiprobe": op1_multiprobe,
    "op2_warc_zstd": op2_warc_zstd,
    "op3_forest_secrets": op3_forest_secrets,
    "op4_wu_manber": op4_wu_manber,
    "op5_bottom_k": op5_bottom_k,
    "op6_zstd_distance": op6_zstd_distance,
    "op7_url_ratio": op7_url_ratio,
    "op8_hash_ring": op8_hash_ring,
    "op9_pieces": op9_pieces,
    "op10_kneser_ney": op10_kneser_ney,
    "op11_run_seeds": op11_run_seeds,
    "op12_bit_planes": op12_bit_planes,
    "op13_cross_polytope": op13_cross_polytope,
}
QUERIES = {name: _bounded(query) for name, query in _QUERIES.items()}
# The others search approximately, score with trained models or apply a library.
ORACLE_SQL = {"op2_warc_zstd": sql.OP2, "op4_wu_manber": sql.OP4, "op5_bottom_k": sql.OP5, "op12_bit_planes": sql.OP12}
