"""Saving and loading fitted Spark ML models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import SparkSession

from tagloom.sources import paths


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def _must_exist(spark: SparkSession, path: str) -> None:
    if not paths.exists(spark, path):
        raise FileNotFoundError(f"no saved model at {path}")


def load_kmeans(spark: SparkSession, path: str) -> KMeansModel:
    _must_exist(spark, path)
    return KMeansModel.load(path)


def load_pipeline(spark: SparkSession, path: str) -> PipelineModel:
    _must_exist(spark, path)
    return PipelineModel.load(path)
