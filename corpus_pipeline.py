"""Corpus pipeline: language ID, exact dedup, near-dedup, secret redaction, packing.

Every stage takes tables with any columns besides ``doc_id``, ``text`` and ``lang`` and returns all of
them (packing returns its own), takes an empty table and then returns no rows, and keeps rows whose
doc_id is null. Each stage's table goes once the next is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkforge.llm import exact_dedup, language_id, order_minhash, packing, queries, secret_scan
from linkforge.llm.common import discard, drop_rows, materialise


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; the model learns from those not held out. Null and empty
    texts and those without a letter go; repeated rows stay; the order of rows means nothing."""
    model = language_id.train(docs.where(~queries.held_out()))
    return language_id.keep_identified(docs, model)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the largest doc_id of each group of texts that are equal but for the case of A-Z;
    null counts as empty. Null ids come last. Of rows that repeat both id and text one stays; rows that
    share an id with unlike texts are told apart by their texts."""
    found = exact_dedup.exact_dedup(docs).select(F.col("doc_id").alias("__d"), F.col("kept").alias("__kept"), F.unhex("text_sha256").alias("__digest"))
    found = materialise(found, "exact")
    # ids that several rows have need the digest too
    many = found.groupBy("__d").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("__d").alias("__m"))
    if many.isEmpty():
        return drop_rows(docs, found.where("not __kept").select("__d"), (F.col("doc_id"), "__d"))
    many = materialise(many, "repeated")
    simple = drop_rows(docs, found.where("not __kept").select("__d").dropDuplicates(), (F.col("doc_id"), "__d"))
    simple = drop_rows(simple, many, (F.col("doc_id"), "__m"))
    folded = F.translate(F.coalesce("text", F.lit("")), exact_dedup.UPPER.decode(), exact_dedup.UPPER.lower().decode())
    again = docs.join(many, F.col("doc_id").eqNullSafe(F.col("__m")), "left_semi").withColumn("__sha", F.sha2(folded.cast("binary"), 256))
    again = again.join(found.where("__kept"), F.col("doc_id").eqNullSafe(F.col("__d")) & (F.unhex("__sha") == F.col("__digest")), "left_semi")
    return simple.unionByName(again.dropDuplicates(["doc_id", "__sha"]).drop("__sha"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies. Null texts and those without
    words are near nothing and stay; rows that repeat an id with unlike texts are told by their texts."""
    gone = order_minhash.near_dedup(docs).where("not kept").select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"))
    return drop_rows(docs, materialise(gone, "dropped"), (F.col("doc_id"), "d"), (F.xxhash64("text"), "k"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by their kind and n_chars, where a text changes, by its new
    length. Null texts stay null; repeated rows stay."""
    return secret_scan.redact_docs(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their place in a sequence. Null and empty texts are one
    token; each row is packed, repeated ones too."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identified),
    ("exact_dedup", unique),
    ("minhash_dedup", distinct),
    ("secret_scan", redacted),
    ("packing", packed),
]

#: Language ID has no SQL form; tests hold the pipeline against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        last, docs = docs, materialise(stage(spark, docs, sf_dir), name)
        discard(last)
    return docs
