"""A corpus pipeline over `documents`: each stage works on what the one before it kept, as Parquet.

All stages but the last return the columns of documents; the last returns the token ids.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from issuelens.llm import mixing, near_dup, quality, repeats, sentencepiece_units
from issuelens.llm.common import WORD, identified, n_words
from issuelens.session import ensure_checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SEED = 11


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality.quality(docs, carry=("text", "lang", "source", "n_chars"))
    return judged.where("kept").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id. Rows without an id stay."""
    kept = near_dup.near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    _, unique = identified(docs)
    rows = docs.join(kept, "doc_id", "left_semi")
    if not unique:
        rows = rows.dropDuplicates(["doc_id", "text"]).unionByName(docs.where("doc_id IS NULL"))
    return rows.select(COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without the passages of 100 bytes that also start earlier; a document with no word left goes."""
    cut = repeats.remove_repeats(docs, carry=("doc_id", "lang", "source"))
    rows = cut.select("carried.*", F.col("kept_text").alias("text")).withColumn("n_chars", F.length("text").cast("long"))
    return rows.where(F.col("text").rlike(WORD)).select(COLUMNS)


def mixed_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each document as often as the mix takes its words: whole passes, and once more by chance for the rest."""
    taken = mixing.mix_sources(docs).groupBy("doc_id", "size").agg(F.max("taken").alias("taken"))
    rows = docs.withColumn("size", n_words(F.col("text")))
    taken = taken.select(F.col("doc_id").alias("mixed_id"), F.col("size").alias("mixed_size"), "taken")
    rows = rows.join(taken, F.col("doc_id").eqNullSafe(F.col("mixed_id")) & (F.col("size") == F.col("mixed_size")))
    rest = F.col("taken") % F.col("size")
    chance = mixing.drawn(SEED, F.col("doc_id"), F.col("size")) % F.col("size") < rest
    passes = F.expr("taken div size") + F.when(chance, 1).otherwise(0)
    rows = rows.where("size > 0").withColumn("passes", passes.cast("int")).where("passes > 0")
    return rows.withColumn("pass", F.explode(F.sequence(F.lit(1), F.col("passes")))).select(COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The SentencePiece ids of each text."""
    return sentencepiece_units.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources", mixed_sources),
    ("SentencePiece ids", token_ids),
]

# Suffix repeats and token ids have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    base = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, folder).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
