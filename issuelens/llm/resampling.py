"""Importance resampling: documents that look like a target corpus are drawn with higher probability.

Features of a text are its runs of 1 to `max_words` consecutive words; a feature's bucket is the CRC-32 of its UTF-8
bytes modulo `buckets`. A bucket's gain compares its shares of the target and of the corpus; the weight of a document
is the mean gain of its features, and a draw without replacement takes the highest sums of weight and a Gumbel number
that depends on the seed and doc_id alone.

1. Head. Each task nominates the words and pairs that make up at least 1 / HEAD of what it has read. Those whose
   nominated counts reach that share of the corpus are the head: at most HEAD words and HEAD pairs, since shares add
   up to one. The CRC-32 states of the words (from which a longer feature's CRC goes on) and of the pairs are
   broadcast. What is not in the head gets its CRC directly, so the choice of the head never changes a result.
2. Buckets. The features of a text are written once as bucket numbers; totals of the corpus and of the target are sums
   over those rows, at most one row per bucket and task.
3. Weights come from the same rows and the gains, one number per bucket. The scores are whole numbers in a
   range that grows with the logarithm of the corpus, so a count per score finds the lowest drawn score, and only
   rows from there on are put in order, by ranges.

Edge cases: a null, empty or wordless text has no feature, weight 0 and is drawn only if `least_words` is 0. Texts of
any length are read whole. A null doc_id stands for the word `null` in the draw and comes last in a tie; rows that
share a doc_id are documents of their own. Equal rows get ranks one after the other. Extra columns are not looked at.
An empty corpus gives no rows; an empty target gives gains that compare with even shares.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from issuelens.llm.common import stored
from issuelens.llm.hashing import column_bytes
from issuelens.operators.ordered import with_global_index

HEAD = 1 << 16
# Different features a task counts before it drops rare ones.
COUNTED = 1 << 20
# Words are runs of digits, letters a-z (A-Z are lower-cased) and code points from U+0080 on; the bytes of the latter
# in UTF-8 are all above 0x7F, so a table over bytes cuts texts in the same places.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Crc(dict):
    """CRC-32 states of the words of the head; of any other word directly."""

    def __missing__(self, word: bytes) -> int:
        return zlib.crc32(word)


class PairCrc(dict):
    """CRC-32 states of the pairs of the head; of any other pair from the state of its first word."""

    def __init__(self, known: dict, words: Crc):
        super().__init__(known)
        self.words = words

    def __missing__(self, pair: tuple[bytes, bytes]) -> int:
        return zlib.crc32(b" " + pair[1], self.words[pair[0]])


def words_of(column: pa.Array) -> Iterator[list[bytes]]:
    """The words of each text."""
    data, offsets = column_bytes(column)
    raw, ends = data.tobytes().translate(LETTERS), offsets.tolist()
    for start, end in zip(ends, ends[1:]):
        yield raw[start:end].split()


def _nominate(batches: Iterator[pa.RecordBatch], max_words: int) -> Iterator[pa.RecordBatch]:
    counts = [Counter() for _ in range(min(max_words, 2))]
    totals = [0] * len(counts)
    for batch in batches:
        for words in words_of(batch.column("text")):
            for k, features in enumerate((words, zip(words, words[1:]))[: len(counts)]):
                counts[k].update(features)
                totals[k] += max(0, len(words) - k)
                if len(counts[k]) > COUNTED:
                    counts[k] = Counter({f: n for f, n in counts[k].items() if n * HEAD >= totals[k]})
    for k, (count, total) in enumerate(zip(counts, totals)):
        found = [(f, n) for f, n in count.items() if n * HEAD >= total]
        names = [b" ".join(f) if k else f for f, _ in found]
        # The row without a name has the total.
        yield pa.RecordBatch.from_arrays(
            [pa.array([k] * (len(found) + 1), pa.int32()), pa.array([*names, None], pa.binary()), pa.array([*(n for _, n in found), total], pa.int64())],
            names=["k", "name", "n"],
        )


def head_of(texts: DataFrame, max_words: int) -> tuple[dict[bytes, int], dict[tuple[bytes, bytes], int]]:
    """CRC-32 states of frequent words and pairs: at most HEAD of each."""
    nominated = texts.select("text").mapInArrow(lambda batches: _nominate(batches, max_words), "k int, name binary, n long")
    # Read twice; written once, since counting reads the corpus.
    counted = stored(nominated.groupBy("k", "name").agg(F.sum("n").alias("n")), "nominated")
    total = F.max(F.when(F.col("name").isNull(), F.col("n")))
    totals = counted.groupBy("k").agg(total.alias("total"))
    frequent = counted.join(F.broadcast(totals), "k").where(F.col("name").isNotNull() & (F.col("n") * HEAD >= F.col("total")))
    states = [{}, {}]
    for row in frequent.select("k", "name").collect():
        name = bytes(row.name)
        states[row.k][tuple(name.split(b" ")) if row.k else name] = zlib.crc32(name)
    return states[0], states[1]


def encoded(docs: DataFrame, head, max_words: int, buckets: int, *carry: str) -> DataFrame:
    """The columns to carry, n_words and n_features of each text and its features as bucket numbers of 4 bytes."""
    known = docs.sparkSession.sparkContext.broadcast(head)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_crc = Crc(known.value[0])
        pairs_crc = PairCrc(known.value[1], words_crc)
        for batch in batches:
            sizes, rows = [], []
            for words in words_of(batch.column("text")):
                states = crcs = list(map(words_crc.__getitem__, words))
                for n in range(2, max_words + 1):
                    if n == 2:
                        states = list(map(pairs_crc.__getitem__, zip(words, words[1:])))
                    else:
                        states = [zlib.crc32(b" " + word, state) for state, word in zip(states, words[n - 1 :])]
                    crcs = crcs + states
                sizes.append((len(words), len(crcs)))
                rows.append((np.array(crcs, dtype=np.uint32) % np.uint32(buckets)).astype("<u4").tobytes())
            made = [pa.array([s[k] for s in sizes], pa.int64()) for k in (0, 1)] + [pa.array(rows, pa.binary())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carry), *made], names=[*carry, "n_words", "n_features", "features"])

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in carry)
    return docs.select(*carry, "text").mapInArrow(apply, f"{kinds}{', ' if carry else ''}n_words long, n_features long, features binary")


def bucket_totals(features: DataFrame, buckets: int) -> DataFrame:
    """bucket and n: the features in each bucket, repeats counted."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            data, _ = column_bytes(batch.column("features"))
            total += np.bincount(np.frombuffer(data.tobytes(), dtype="<u4"), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])

    return features.select("features").mapInArrow(apply, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 ln(share of the target / share of the corpus)) of each bucket, with one added to each count."""
    counts = np.zeros((2, buckets), dtype=np.int64)
    for k, totals in enumerate((corpus, target)):
        # At most one row per bucket.
        for row in totals.collect():
            counts[k, row.bucket] = row.n
    of_corpus, of_target = (float(counts[k].sum() + buckets) for k in (0, 1))
    return np.array(
        [math.floor(1000 * math.log((t + 1) * of_corpus / ((s + 1) * of_target))) for s, t in zip(*counts.tolist())], dtype=np.int64
    )


def weighed(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and the floored mean gain of the features."""
    known = features.sparkSession.sparkContext.broadcast(gain)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column("features"))
            values = known.value[np.frombuffer(data.tobytes(), dtype="<u4")]
            sums = np.concatenate(([0], np.cumsum(values)))[offsets // 4]
            weight = np.diff(sums) // np.maximum(np.diff(offsets) // 4, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), batch.column("n_features"), pa.array(weight)],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return features.mapInArrow(apply, "doc_id long, n_words long, n_features long, weight long")


def gumbel(seed: int) -> Column:
    """floor(1000 x a Gumbel number) drawn by seed and doc_id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, max_words: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: int = 2024) -> DataFrame:
    """doc_id, n_features, weight, score and rank of each document; rank is null for documents not drawn.

    Of the documents with at least `least_words` words, floor(percent / 100) are drawn by score, ties by doc_id.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    head = head_of(rows, max_words)
    features = stored(encoded(rows, head, max_words, buckets, "doc_id"), "features")
    of_target = bucket_totals(encoded(target.select("text"), head, max_words, buckets), buckets)
    gain = gains(bucket_totals(features, buckets), of_target, buckets)
    scored = weighed(features, gain).withColumn("score", F.col("weight") + gumbel(seed))
    scored = stored(scored.withColumn("able", F.col("n_words") >= least_words), "scores")
    # One row per score, however many documents there are.
    per_score = scored.where("able").groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    above = F.sum("n").over(W.orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, -1))
    per_score = per_score.select("score", F.coalesce(above, F.lit(0)).alias("above"), F.sum("n").over(W.partitionBy()).alias("all"))
    per_score = per_score.withColumn("quota", F.expr(f"all * {percent} div 100"))
    least, drawn = per_score.where("above < quota").agg(F.min("score"), F.max("quota")).first()
    out = ["doc_id", "n_features", "weight", "score"]
    if not drawn:
        return scored.select(*out, F.lit(None).cast("long").alias("rank"))
    near = F.col("able") & (F.col("score") >= least)
    ready = scored.where(near).select(*out, (-F.col("score")).alias("_down"), F.col("doc_id").isNull().alias("_nobody"))
    ranked = with_global_index(ready, ["_down", "_nobody", "doc_id", "n_features"], "_index")
    rank = F.when(F.col("_index") < drawn, F.col("_index") + 1).cast("long")
    rest = scored.where(~near).select(*out, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*out, rank.alias("rank")).unionByName(rest)
