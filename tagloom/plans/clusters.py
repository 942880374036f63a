"""Cluster jobs: reduce embeddings, fit and assign clusters, measure purity, derive the label map."""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.checks import require_choice, require_columns, require_names, require_positive
from tagloom.functions.vectors import is_valid_vector, l2_normalize
from tagloom.operators.labels import attach_purity, cluster_purity, majority_labels
from tagloom.operators.neighbors import assign_nearest_centroid, vector_width
from tagloom.operators.sampling import first_n
from tagloom.sources.models import load_kmeans, save_model
from tagloom.sources.tables import centroid_table, prune, write_int_map, write_table


def _unit_vectors(rows: DataFrame, column: str, dim: int) -> DataFrame:
    valid = rows.filter(is_valid_vector(F.col(column), dim))
    return valid.withColumn("_unit", array_to_vector(l2_normalize(F.col(column))))


def fit_pca(rows: DataFrame, column: str = "cls", n_components: int = 50) -> PipelineModel:
    """Centre the length-normalised vectors and fit their principal components."""
    require_positive(n_components=n_components)
    require_columns(rows, [column], "vectors")
    dim = vector_width(rows, column)
    if dim == 0:
        raise ValueError("components need at least one usable vector")
    centre = StandardScaler(withMean=True, withStd=False, inputCol="_unit", outputCol="_centred")
    components = PCA(k=n_components, inputCol="_centred", outputCol="_pca")
    return Pipeline(stages=[centre, components]).fit(_unit_vectors(rows.select(column), column, dim))


def transform_pca(rows: DataFrame, model: PipelineModel, column: str = "cls", out: str = "pca") -> DataFrame:
    """All input columns and ``out``; null for an invalid vector.

    A component is turned so that its largest loading is positive, which makes its sign repeatable.
    """
    loadings = model.stages[-1].pc.toArray()
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(loadings.shape[1])])
    turns = F.array(*[F.lit(float(s) or 1.0) for s in signs])
    valid = is_valid_vector(F.col(column), loadings.shape[0])
    zero = F.array_repeat(F.lit(0.0), loadings.shape[0])
    unit = F.when(valid, l2_normalize(F.col(column))).otherwise(zero)
    reduced = model.transform(rows.withColumn("_unit", array_to_vector(unit)))
    turned = F.zip_with(vector_to_array("_pca"), turns, lambda x, s: x * s)
    return reduced.withColumn(out, F.when(valid, turned)).select(*[c for c in rows.columns if c != out], out)


def fit_clusters(
    rows: DataFrame,
    column: str = "pca",
    *,
    n_clusters: int = 200,
    max_iter: int = 100,
    seed: int = 42,
    sample_limit: int | None = None,
    key: str | None = None,
) -> KMeansModel:
    """k-means over the valid vectors, or over the first ``sample_limit`` of them by ``key``."""
    if n_clusters <= 1:
        raise ValueError("n_clusters is two or more")
    require_positive(max_iter=max_iter, sample_limit=sample_limit)
    require_columns(rows, [column], "vectors")
    dim = vector_width(rows, column)
    valid = rows.filter(is_valid_vector(F.col(column), dim))
    if sample_limit is not None:
        require_names(key=key or "")
        valid = first_n(valid, sample_limit, key)
    points = valid.select(array_to_vector(F.col(column).cast("array<double>")).alias("_point"))
    points.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return KMeans(k=n_clusters, maxIter=max_iter, seed=seed, featuresCol="_point").fit(points)
    finally:
        points.unpersist()


def run_clusters(
    rows: DataFrame,
    model_path: str,
    *,
    run_mode: str = "train",
    centroids_path: str | None = None,
    column: str = "pca",
    cluster: str = "cluster_id",
    **fit_options,
) -> DataFrame:
    """Fit, save and assign (``train``), or assign with a saved model (``predict``)."""
    require_choice(run_mode, ["train", "predict"], "run_mode")
    require_names(model_path=model_path, cluster=cluster)
    spark = rows.sparkSession
    if run_mode == "train":
        model = fit_clusters(rows, column, **fit_options)
        save_model(model, model_path)
    else:
        model = load_kmeans(spark, model_path)
    centroids = centroid_table(spark, model.clusterCenters(), cluster)
    if run_mode == "train" and centroids_path:
        write_table(centroids, centroids_path)
    return assign_nearest_centroid(rows, centroids, vector=column, cluster=cluster)


def purity_job(
    rows: DataFrame, centroids: DataFrame, *, label: str, cluster: str = "cluster_id", output_path: str | None = None
) -> DataFrame:
    """Centroids with the purity of their clusters, optionally written to a new path."""
    require_names(label=label, cluster=cluster)
    rated = attach_purity(centroids, cluster_purity(prune(rows, [cluster, label], "clustered rows"), cluster, label), cluster)
    if output_path:
        write_table(rated, output_path)
    return rated


def label_map_job(
    rows: DataFrame,
    *,
    label: str = "label",
    cluster: str = "cluster_id",
    output_path: str | None = None,
    exclude_invalid: bool = False,
) -> DataFrame:
    """Majority label per cluster, optionally exported as a JSON or YAML map."""
    require_names(label=label, cluster=cluster)
    mapping = majority_labels(
        prune(rows, [cluster, label], "clustered rows"), cluster, label, exclude_invalid=exclude_invalid
    )
    if output_path:
        write_int_map(mapping, cluster, label, output_path)
    return mapping
