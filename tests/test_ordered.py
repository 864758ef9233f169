import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from issuelens.operators import quantile
from issuelens.operators.ordered import (
    every_kth,
    rows_before,
    running_max,
    slice_borders,
    slice_number,
    with_global_index,
    with_group_position,
    with_running_sum,
)
from issuelens.operators.quantile import exact_quantile


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(1)
    # A third of the rows share one group.
    data = [(i, 0 if i % 3 == 0 else draw.randrange(20), draw.random()) for i in range(3000)]
    draw.shuffle(data)
    return spark.createDataFrame(data, "id LONG, grp INT, x DOUBLE").repartition(7), sorted(data)


def test_global_index_counts_all_rows(rows):
    df, data = rows
    got = {r.id: r.row_index for r in with_global_index(df, ["id"]).collect()}
    assert got == {d[0]: i for i, d in enumerate(data)}


def test_group_position_with_a_hot_group(rows):
    df, data = rows
    expected, seen = {}, {}
    for i, g, _ in data:
        expected[i] = seen.get(g, 0)
        seen[g] = expected[i] + 1
    assert {r.id: r.pos for r in with_group_position(df, ["grp"], ["id"]).collect()} == expected


@pytest.mark.parametrize("most", [1, 7, 1000, 2999, 3000, 5000])
def test_every_kth(rows, most):
    df, data = rows
    step = 1 if len(data) <= most else -(-len(data) // most)
    assert sorted(r.id for r in every_kth(df, ["id"], most).collect()) == [d[0] for d in data][::step]


def test_running_max(rows):
    df, data = rows
    best = np.maximum.accumulate([d[2] for d in data])
    got = {r.id: r.best_so_far for r in running_max(df, ["id"], "x").collect()}
    assert all(got[d[0]] == b for d, b in zip(data, best))


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.995, 1.0])
@pytest.mark.parametrize("shape", ["uniform", "ties", "huge", "one", "negative"])
def test_exact_quantile(spark, q, shape):
    draw = random.Random(7)
    values = {
        "uniform": [draw.random() for _ in range(500)],
        "ties": [5.0] * 200 + [draw.randrange(10) * 1.0 for _ in range(300)],
        "huge": [10 ** draw.uniform(-5, 15) for _ in range(500)],
        "one": [3.0],
        "negative": [-draw.random() * 100 for _ in range(300)],
    }[shape]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v DOUBLE")
    assert exact_quantile(df, "v", q) == pytest.approx(float(np.quantile(values, q)), rel=1e-12)


def test_quantile_of_nothing(spark):
    assert exact_quantile(spark.range(0).select(F.col("id").alias("v")), "v", 0.5) is None


def test_quantile_in_a_bracket_inside_many_rows(spark):
    # Far more rows than the sketch keeps, so the bracket leaves most values out.
    values = [(i * 7919 % 100_003) / 7.0 for i in range(100_003)]
    df = spark.range(100_003).select(((F.col("id") * 7919) % 100_003 / 7.0).alias("v"))
    for q in (0.003, 0.25, 0.995, 0.9999):
        assert exact_quantile(df, "v", q) == pytest.approx(float(np.quantile(values, q)), rel=1e-12)


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    for wrong in [(1000, 0.0, 10.0), (1000, 900.0, 950.0)]:
        monkeypatch.setattr(quantile, "_bracket", lambda values, q: wrong)
        assert exact_quantile(df, "v", 0.5) == 499.5


def test_quantile_skips_nan_and_takes_infinite_values(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.0,), (2.0,), (None,)], "v DOUBLE")
    assert exact_quantile(df, "v", 0.5) == 2.0
    assert exact_quantile(df, "v", 1.0) == float("inf")


def test_the_source_is_read_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.range(5000, numPartitions=4).select(F.col("id").cast("double").alias("v")).mapInPandas(count, "v DOUBLE")
    assert exact_quantile(rows, "v", 0.9) == pytest.approx(4499.1)
    assert seen.value == 5000


def test_running_sum(rows):
    df, data = rows
    total = np.cumsum([d[0] for d in data])
    got = {r.id: r.s for r in with_running_sum(df, ["id"], "id", "s").collect()}
    assert all(got[d[0]] == t for d, t in zip(data, total))


def test_rows_before_each_slice(spark):
    rows = [(g, k) for g in (1, 2) for k in [None, *range(0, 40, g)]]
    df = spark.createDataFrame(rows, "g INT, k INT")
    borders = [5, 11, 30]
    numbered = df.withColumn("s", slice_number(F.col("k"), borders))
    assert all(r.s == (-1 if r.k is None else sum(b <= r.k for b in borders)) for r in numbered.collect())
    for r in rows_before(numbered, ["g"], "s").collect():
        of_group = [-1 if k is None else sum(b <= k for b in borders) for g, k in rows if g == r.g]
        assert (r._before, r._rows, r._total) == (sum(s < r.s for s in of_group), of_group.count(r.s), len(of_group))
    assert len(slice_borders(df, "k", 10, 5, 4)) >= 2 and slice_borders(df, "k", 1000, 1000, 4) == []
