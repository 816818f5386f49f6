"""The corpus pipeline: each stage takes the documents that its predecessor kept.

All stages but the last return the columns of ``documents``. Every stage takes null
texts, empty and very long ones, repeated rows, and an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.llm import compression, language, mixing, neardup, pieces, queries
from bazaarlake.session import write_and_read

# Documents below this share of the predicted language's probability are of none.
LEAST_SCORE = 0.5
# The mix takes half of the remaining words, each document at most once.
FRACTION, SEED = 0.5, 17
# Near copies share so many percent of their shingles (op3's contract asks for 85).
SIMILAR = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter and those whose language stays unclear."""
    net = language.fit_languages(docs, "text", "lang", "doc_id")
    judged = language.predict_languages(docs, "text", net)
    return judged.filter((F.col("lang_pred") != language.UNKNOWN)
                         & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop short, self-repeating, repetitive and incompressible documents."""
    whole, chunks = compression.learn_bands(docs, "text")
    return compression.compression_rules(docs, "text", whole_bands=whole, chunk_bands=chunks).filter(
        "kept").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each near-duplicate group."""
    found = neardup.near_duplicates(docs, "doc_id", "text", SIMILAR)
    kept = found.filter("kept").select("doc_id").distinct()
    unnamed = docs.filter("doc_id IS NULL")  # not in any group
    return docs.join(kept, "doc_id", "left_semi").unionByName(unnamed).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that fill each source's budget of words, whole."""
    mixed = mixing.mix_documents(
        docs, "doc_id", "text", [queries.source_domain(), "lang", "source"],
        queries.mix_weights(spark), FRACTION, max_epochs=1, seed=SEED)
    taken = write_and_read(mixed.select(F.col("key").alias("doc_id")).distinct(), "mixed")
    return docs.join(taken, docs["doc_id"].eqNullSafe(taken["doc_id"]), "left_semi").select(
        *docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with their count and digests."""
    return pieces.encode_texts(docs, "text", queries.tokenizer_path(), with_ids=True,
                               keep=["doc_id"])


STAGES = [("language_id", language_id), ("quality_rules", quality_rules),
          ("near_dedup", near_dedup), ("mixing", mix), ("sentencepiece", encode)]
# Networks, compression and the tokenizer are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_and_read(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
