"""Evaluation jobs: a scored file against its labels, and embeddings against a bank."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.checks import require_columns
from tagloom.functions.text import MISSING_CELLS, missing_as_nan_text
from tagloom.operators.labels import remap_predictions
from tagloom.operators.metrics import METRICS, classification_metrics, masked_cross_entropy, total_loss
from tagloom.operators.neighbors import contrastive_loss, knn_macro_f1, last_batches, neighbor_labels, recall_at_k
from tagloom.operators.scoring import Scorer, score_texts
from tagloom.operators.sizing import staged
from tagloom.sources.tables import dense_mapping, is_parquet, read_by_extension, write_metrics


def validate_predictions(
    labelled: DataFrame,
    load_model: Callable[[], Scorer],
    *,
    mapping: dict | None = None,
    batch_size: int = 32,
    markers: list[str] | None = None,
) -> DataFrame:
    """Accuracy and macro F1 of a model on labelled texts, its answers optionally sent through a mapping.

    ``markers`` lists cells that stand for a missing text, as a CSV has them.
    """
    require_columns(labelled, ["text", "label"], "Dataset")
    texts = labelled.select(missing_as_nan_text(F.col("text"), markers).alias("text"), F.col("label").alias("truth"))
    scored = score_texts(texts, load_model, batch_size=batch_size)
    failed = F.raise_error(F.concat(F.lit("scoring failed: "), F.col("error")))
    pred = F.when(F.col("error").isNotNull(), failed.cast("bigint")).otherwise(F.col("label"))
    pairs = scored.select("truth", pred.alias("pred"))
    if mapping is not None:
        pairs = remap_predictions(pairs, dense_mapping(mapping), "pred", "pred")
    return classification_metrics(pairs, "truth", "pred").select("accuracy", F.col("f1").alias("macro_f1"))


def run_validation(
    spark: SparkSession,
    data_path: str,
    load_model: Callable[[], Scorer],
    *,
    mapping: dict | None = None,
    batch_size: int = 32,
    output_json: str | None = None,
) -> DataFrame:
    rows = read_by_extension(spark, data_path)
    markers = None if is_parquet(data_path) else MISSING_CELLS
    metrics = validate_predictions(rows, load_model, mapping=mapping, batch_size=batch_size, markers=markers)
    if output_json:
        write_metrics(metrics, output_json)
    return metrics


def evaluate_batches(
    rows: DataFrame,
    *,
    batch: str = "batch_id",
    key: str = "vec_id",
    classification_mask: str = "classification_mask",
    metric_mask: str = "metric_mask",
    temperature: float = 0.1,
    smoothing: float = 0.0,
    classification_weight: float = 1.0,
    metric_weight: float = 1.0,
) -> DataFrame:
    """Validation of a joint model: mean losses over the batches and scores over the masked rows: (name, value).

    ``rows`` carry ``label``, ``pred``, ``probs`` and ``embedding`` next to the two masks.
    """
    cross = masked_cross_entropy(rows, mask=classification_mask, smoothing=smoothing, by=[batch])
    contrast = contrastive_loss(rows, batch=batch, key=key, mask=metric_mask, temperature=temperature)
    names = ["classification_loss", "metric_loss"]
    losses = cross.join(contrast, batch).agg(*[F.coalesce(F.avg(n), F.lit(0.0)).alias(n) for n in names])
    total = total_loss(F.col(names[0]), F.col(names[1]), classification_weight, metric_weight)
    scores = classification_metrics(rows.filter(F.col(classification_mask) > 0), "label", "pred")
    return _long(losses.withColumn("total_loss", total), [*names, "total_loss"]).unionByName(_long(scores, METRICS))


def _long(row: DataFrame, names: list[str]) -> DataFrame:
    """A one-row table turned into (name, value) rows."""
    cells = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in names])
    return row.select(F.inline(cells))


def evaluate_embeddings(
    queries: DataFrame,
    bank: DataFrame,
    *,
    ks: list[int] = (1, 10, 100),
    knn_k: int = 10,
    keep_batches: int | None = 10,
    distance: str = "cos",
    query_id: str = "val_id",
    bank_id: str = "vec_id",
    batch: str = "batch_id",
    mask: str = "metric_mask",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """Recall@K and k-NN macro F1 of masked queries against the last batches of the masked bank: (name, value)."""
    bank = last_batches(bank.filter(F.col(mask) > 0), keep_batches, batch)
    queries = queries.filter(F.col(mask) > 0)
    near = neighbor_labels(
        queries, bank, max(*ks, knn_k), query_id=query_id, bank_id=bank_id, vector=vector, label=label, distance=distance
    )
    near = staged(near.select(query_id, "rank", "bank_label", "query_label"), "neighbors")
    recalls = recall_at_k(near, list(ks), query_id).select(
        F.concat(F.lit("recall_at_"), F.col("k")).alias("name"), F.col("recall").alias("value")
    )
    vote = knn_macro_f1(near, knn_k, query_id).select(F.lit("knn_macro_f1").alias("name"), F.col("knn_macro_f1").alias("value"))
    return recalls.unionByName(vote)
