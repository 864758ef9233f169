import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from issuelens.llm import knn


def brute(rows, k):
    usable = []
    for vec_id, vector in rows:
        if vec_id is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        # As 32-bit floats, which the column holds.
        usable.append((vec_id, [math.floor(Fraction(256) * Fraction(float(np.float32(x)))) for x in vector]))
    lines = {}
    for q, a in usable:
        if q % 50 == 0:
            lines.setdefault(q, []).extend((-sum(x * y for x, y in zip(a, b)), v) for v, b in usable if v != q)
    cut = lambda s: max(-(2**63), min(2**63 - 1, s))
    return Counter((q, rank + 1, v, cut(-s)) for q, line in lines.items() for rank, (s, v) in enumerate(sorted(line)[:k]))


def found(spark, rows, k=5):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return Counter(tuple(r) for r in knn.top_k(frame, frame.where("vec_id % 50 = 0"), k).collect())


@pytest.mark.parametrize("sizes", [(1024, 16384), (3, 40)])
def test_agrees_with_brute_force(spark, data, monkeypatch, sizes):
    monkeypatch.setattr(knn, "GROUP_QUERIES", sizes[0])
    monkeypatch.setattr(knn, "BLOCK_ROWS", sizes[1])
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
    assert found(spark, rows) == brute([r[:2] for r in rows], 5)


def test_ties_nulls_lengths_and_large_components(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.0, 0.0, 1.0]) for _ in range(4)], 0) for i in range(200)]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5], 0) for i in range(50)]
    rows += [(300, None, 0), (350, [float("nan")] * 4, 0), (400, [None, 1.0], 0), (450, [float("inf")] * 4, 0), (None, [1.0] * 4, 0)]
    rows += [(500, [1.0], 0), (550, [], 0), (600, [3e38, 0.0], 0), (650, [2.0, 0.0, 0.0, 0.0, 0.0, 7.0], 0), (150, [0.1] * 4, 0)]
    assert found(spark, rows) == brute([r[:2] for r in rows], 5)


def test_few_and_no_candidates(spark):
    assert found(spark, [(0, [1.0], 0), (1, [2.0], 0)]) == Counter([(0, 1, 1, 131072)])
    assert found(spark, [(0, [1.0], 0)]) == Counter()
    assert found(spark, []) == Counter()


@pytest.mark.parametrize("own", [64, 1])
def test_large_components_and_repeated_ids(spark, monkeypatch, own):
    monkeypatch.setattr(knn, "MOST_OWN", own)
    rows = [(0, [1.0, 1.0], 0), (1, [300_000.0, 0.0], 0), (2, [400_000.0, 0.0], 0), (3, [2.0, 0.0], 0), (3, [5.0, 0.0], 0)]
    assert found(spark, rows) == brute([r[:2] for r in rows], 5)
    # Numbers beyond 2 ** 53, beyond 2 ** 63 and beyond any decimal, and queries that share an id.
    rows += [(4, [3e9, 1.0], 0), (50, [4e9, -3e9], 0), (50, [1.0, 2.0], 0), (5, [3e38, 2.0], 0), (6, [-3e38, 3e38], 0), (100, [2e38, 1e30], 0)]
    rows += [(7, [2.9e38, 0.0], 0), (8, [-1e20, -1e21], 0), (150, [1e10, 1e10], 0)]
    assert found(spark, rows, 4) == brute([r[:2] for r in rows], 4)


def test_clashing_columns(spark):
    frame = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(60)], "vec_id long, embedding array<float>")
    more = frame.selectExpr("*", *(f"'extra' AS {name}" for name in ("v", "cell", "far", "query_cell", "part", "block", "rank", "score")))
    rows = lambda f: Counter(tuple(r) for r in knn.top_k(f, f.where("vec_id % 50 = 0")).collect())
    assert rows(more) == rows(frame)
