"""The registered queries of this subpackage: each takes (spark, folder of the tables) and returns a DataFrame."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from issuelens.llm import archive, chat, knn, language, licenses, mixing, near_dup, quality, repeats, resampling, runs, sentencepiece_units, token_files
from issuelens.llm.common import scratch_folder, table
from issuelens.llm.oracles import ORACLES  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_quality_rules(spark, folder):
    return quality.quality(table(spark, folder, "documents"))


@query
def op1_suffix_dedup(spark, folder):
    """Bytes of each document that lie in no string of 100 bytes that also starts earlier."""
    cut = repeats.remove_repeats(table(spark, folder, "documents"), with_bytes=False)
    doc_id = F.when(F.col("doc") != repeats.NO_ID, F.col("doc"))
    return cut.select(doc_id.alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op1_repeat_groups(spark, folder):
    """Every maximal repeat (within segments) with all its places, as the tree of repeats, places in classes of equal
    segments, and the copies of each class."""
    found = repeats.Repeats(table(spark, folder, "documents")).factored
    return found.withColumn("doc", F.when(F.col("doc") != repeats.NO_ID, F.col("doc"))).withColumnRenamed("doc", "doc_id")


@query
def op10_near_dedup(spark, folder):
    return near_dup.near_duplicates(table(spark, folder, "documents"))


@query
def op8_mix_sources(spark, folder):
    return mixing.mix_sources(table(spark, folder, "documents"))


@query
def op2_sentencepiece(spark, folder):
    return sentencepiece_units.encode(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op6_chat_round_trip(spark, folder):
    """All conversations and one that holds control strings."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.format_and_read_back(turns.unionByName(chat.hostile_conversation(spark)))


@query
def op7_license_scan(spark, folder):
    return licenses.scan(table(spark, folder, "documents"))


@query
def op9_language_id(spark, folder):
    found = language.identify_languages(table(spark, folder, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))


@query
def op5_voronoi_top_k(spark, folder):
    """The five best rows by inner product for every vector whose id is divisible by 50."""
    vectors = table(spark, folder, "embeddings")
    return knn.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


@query
def op4_wavelet_shards(spark, folder):
    """Token ids of all documents, written as shards and read back."""
    shards = scratch_folder(spark, "shards")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_shards(table(spark, folder, "documents"), tokenizer, public_tokenizers.PATTERN, shards)
    return token_files.read_documents(spark, shards)


@query
def op12_content_addressed_warc(spark, folder):
    """All pages, written as WARC records over a payload store and read back."""
    place = scratch_folder(spark, "archive")
    archive.write_archive(table(spark, folder, "pages"), place)
    return archive.read_archive(spark, place).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op13_importance_resampling(spark, folder):
    """A tenth of the documents, drawn by likeness to the benchmark texts."""
    return resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def with_planted_run(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of one document in ten by id, repeated from some word on with some period."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


@query
def op11_periodic_runs(spark, folder):
    return runs.digests(runs.periodic_runs(table(spark, folder, "documents"), with_planted_run))
