"""Clustering, weekly regression, video features and model comparison on pyspark.ml."""
