import hashlib
import math
import re
import zlib

import pytest
from plain_words import LOWER

from issuelens.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
OUT = ("doc_id", "n_features", "weight", "score", "rank")


def features(text, max_words):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i : i + n]) for n in range(1, max_words + 1) for i in range(len(words) - n + 1)]


def expected(docs, target, max_words=1, buckets=10_000, percent=10, least=20, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    read = [(i, *features(text, max_words)) for i, text in docs]
    s, t = [0] * buckets, [0] * buckets
    for _, _, found in read:
        for f in found:
            s[bucket(f)] += 1
    for text in target:
        for f in features(text, max_words)[1]:
            t[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for i, words, found in read:
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(found), weight, score, None, len(words) >= least])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, row in enumerate(able[: len(able) * percent // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def got(frame):
    assert frame.columns == list(OUT)
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("max_words,head", [(1, 1 << 16), (1, 20), (2, 300), (3, 1)])
def test_agrees_with_plain_python(spark, data, documents, texts, monkeypatch, max_words, head):
    # The head decides what is looked up, never what comes out.
    monkeypatch.setattr(resampling, "HEAD", head)
    monkeypatch.setattr(resampling, "COUNTED", 500)
    target = spark.read.parquet(f"{data}/benchmark.parquet")
    want = expected(sorted(texts.items()), [r.text for r in target.collect()], max_words)
    assert got(resampling.resample(documents, target, max_words)) == want
    assert any(row[4] for row in want)


def test_the_head_is_bounded_and_frequent(spark, documents, monkeypatch):
    monkeypatch.setattr(resampling, "HEAD", 50)
    words, pairs = resampling.head_of(documents, 2)
    assert 0 < len(words) <= 50 and len(pairs) <= 50
    assert all(state == zlib.crc32(word) for word, state in words.items())
    assert all(state == zlib.crc32(b" ".join(pair)) for pair, state in pairs.items())


def test_odd_rows(spark, odd_documents, no_documents):
    target = spark.createDataFrame([("the quick brown fox 1234 日本語",), (None,), ("",)], "text string").selectExpr("*", "'x' AS doc_id")
    docs = [(r.doc_id, r.text) for r in odd_documents.collect()]
    words = [r.text for r in target.collect()]
    assert got(resampling.resample(odd_documents, target, least_words=0, percent=60)) == expected(docs, words, least=0, percent=60)
    assert got(resampling.resample(odd_documents, target, 2, 97, least_words=1, percent=100)) == expected(docs, words, 2, 97, 100, 1)
    assert got(resampling.resample(no_documents, target)) == []
    empty = target.limit(0)
    assert got(resampling.resample(odd_documents, empty)) == expected(docs, [])
    same = spark.createDataFrame([(4, "a b c " * 9)] * 30, "doc_id long, text string")
    assert got(resampling.resample(same, target)) == expected([(4, "a b c " * 9)] * 30, words)
