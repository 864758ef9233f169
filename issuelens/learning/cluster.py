"""Grouping of videos by their figures."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from issuelens.operators.dedup import first_n

FEATURES = ["view", "like", "coin", "favorite"]
# Names of the clusters from the highest mean view down; fixed values.
TAGS = ["爆款视频", "普通热门", "潜力视频"]
SAMPLES = 20


@dataclass
class Clustering:
    """A fitted clustering; `model` is None if there were fewer videos than clusters, and the reports are then empty."""

    model: PipelineModel | None
    labelled: DataFrame
    k: int


def fit_clusters(
    videos: DataFrame,
    k: int = 3,
    seed: int = 42,
    max_iter: int = 20,
    center: bool = True,
    features: list[str] = FEATURES,
) -> Clustering:
    """k-means on standardised features; without a model if there are fewer than `k` videos."""
    if videos.limit(k).count() < k:
        return Clustering(None, videos.limit(0), k)
    stages = [
        VectorAssembler(inputCols=features, outputCol="features"),
        StandardScaler(inputCol="features", outputCol="scaled", withMean=center, withStd=True),
        KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="scaled", predictionCol="label"),
    ]
    model = Pipeline(stages=stages).fit(videos)
    return Clustering(model, model.transform(videos), k)


def silhouette(found: Clustering) -> float:
    return ClusteringEvaluator(featuresCol="scaled", predictionCol="label").evaluate(found.labelled)


def cluster_profile(found: Clustering, features: list[str] = FEATURES) -> DataFrame:
    """One row per cluster: size, means, tag by rank of mean view, and the first sample ids.

    The tag follows the rank, so it also works when fewer clusters than tags are left. The
    windows and lists here see one row per cluster and at most SAMPLES rows of each.
    """
    if found.model is None:
        figures = ", ".join(f"avg_{f} DOUBLE" for f in features)
        schema = f"label INT, count LONG, {figures}, tag STRING, sample_ids ARRAY<LONG>, silhouette DOUBLE"
        return found.labelled.sparkSession.createDataFrame([], schema)
    means = found.labelled.groupBy("label").agg(
        F.count(F.lit(1)).alias("count"), *[F.round(F.avg(f), 2).alias(f"avg_{f}") for f in features]
    )
    rank = F.row_number().over(Window.orderBy(F.desc("avg_view"), "label"))
    tag = F.element_at(F.array(*[F.lit(t) for t in TAGS]), F.least(rank, F.lit(len(TAGS))))
    samples = (
        first_n(found.labelled.select("label", "aid"), ["label"], ["aid"], SAMPLES)
        .groupBy("label")
        .agg(F.sort_array(F.collect_list("aid")).alias("sample_ids"))
    )
    return means.withColumn("tag", tag).join(samples, "label").withColumn("silhouette", F.lit(round(silhouette(found), 4)))


def feature_spread(found: Clustering, features: list[str] = FEATURES) -> dict[str, float]:
    """Variance of each feature over the scaled cluster centres, as its importance; empty without a model."""
    if found.model is None:
        return {}
    centers = found.model.stages[-1].clusterCenters()
    count = len(centers)
    out = {}
    for i, name in enumerate(features):
        values = [float(c[i]) for c in centers]
        middle = sum(values) / count
        out[name] = round(sum((v - middle) ** 2 for v in values) / max(count - 1, 1), 4)
    return out


def scatter(found: Clustering) -> DataFrame:
    """Rows (aid, label, x, y): each video in the plane of the first two principal components."""
    if found.model is None:
        return found.labelled.sparkSession.createDataFrame([], "aid LONG, label INT, x DOUBLE, y DOUBLE")
    plane = PCA(k=2, inputCol="scaled", outputCol="plane").fit(found.labelled).transform(found.labelled)
    point = vector_to_array("plane")
    return plane.select("aid", "label", F.round(point[0], 4).alias("x"), F.round(point[1], 4).alias("y"))


def gram_moments(rows: DataFrame, features: list[str] = FEATURES) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of rows, means and sample covariances of the features, from one aggregation.

    The covariances are updated from centred values, so large means cost no digits.
    """
    pairs = [(i, j) for i in range(len(features)) for j in range(i, len(features))]
    figures = rows.dropna(subset=features).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(f).alias(f"mean_{i}") for i, f in enumerate(features)],
        *[F.covar_samp(features[i], features[j]).alias(f"cov_{i}_{j}") for i, j in pairs],
    ).first()
    spread = np.zeros((len(features), len(features)))
    for i, j in pairs:
        spread[i, j] = spread[j, i] = figures[f"cov_{i}_{j}"] or 0.0
    return figures.n, np.array([figures[f"mean_{i}"] or 0.0 for i in range(len(features))]), spread


def principal_axes(rows: DataFrame, features: list[str] = FEATURES, axes: int = 2) -> DataFrame:
    """Rows (axis, variance, feature, loading): the directions of the largest variance of the standardised features.

    The largest loading of an axis is positive (ties: the first feature), which fixes its sign. A feature without
    spread has loading 0; fewer than two rows give none.
    """
    n, _, spread = gram_moments(rows, features)
    schema = "axis INT, variance DOUBLE, feature STRING, loading DOUBLE"
    if n < 2:
        return rows.sparkSession.createDataFrame([], schema)
    scale = np.sqrt(np.diag(spread))
    scale[scale == 0] = np.inf
    values, vectors = np.linalg.eigh(spread / np.outer(scale, scale))
    out = []
    for axis, k in enumerate(np.argsort(-values, kind="stable")[:axes], 1):
        vector = vectors[:, k]
        vector = vector * np.sign(vector[np.argmax(np.round(np.abs(vector), 9))])
        out += [(axis, float(values[k]), f, float(v)) for f, v in zip(features, vector)]
    return rows.sparkSession.createDataFrame(out, schema)


def conditions(found: Clustering, features: list[str] = FEATURES) -> DataFrame:
    """One row that says whether the labels are a k-means result: `videos`, `clusters`, how many videos lie nearer to
    the centre of another cluster than to their own, and how many clusters have no video. No rows without a model."""
    schema = "videos LONG, clusters LONG, misplaced LONG, empty LONG"
    if found.model is None:
        return found.labelled.sparkSession.createDataFrame([], schema)
    point = vector_to_array("scaled")
    # One constant per cluster and feature.
    centers = [[float(x) for x in c] for c in found.model.stages[-1].clusterCenters()]
    distances = [
        sum(((point[i] - F.lit(x)) * (point[i] - F.lit(x)) for i, x in enumerate(c)), F.lit(0.0)) for c in centers
    ]
    own = F.element_at(F.array(*distances), F.col("label") + 1)
    return found.labelled.agg(
        F.count(F.lit(1)).alias("videos"),
        F.lit(len(centers)).cast("bigint").alias("clusters"),
        # Two equally near centres may differ in the last digits.
        F.count_if(own > F.array_min(F.array(*distances)) + 1e-9).alias("misplaced"),
        (F.lit(len(centers)) - F.count_distinct("label")).alias("empty"),
    )
