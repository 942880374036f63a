"""Text-classifier training on a labelled table, judged on an explicit validation table."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.checks import require_choice, require_columns
from tagloom.functions.vectors import argmax
from tagloom.operators.metrics import METRICS, classification_metrics, masked_cross_entropy

SAVE_BEST_BY = ["loss", "accuracy", "precision", "recall", "f1"]


@dataclass(frozen=True)
class Trained:
    """The best model, its settings, and the validation scores of every candidate in order of training."""

    model: PipelineModel
    settings: dict
    log: list[dict]


def _features(num_features: int) -> Pipeline:
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol="text", outputCol="_tokens", pattern=r"(?U)\w+", gaps=False),
            HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features),
            IDF(inputCol="_tf", outputCol="features"),
        ]
    )


def predict_labels(rows: DataFrame, model: PipelineModel) -> DataFrame:
    """``rows`` with ``probs`` and the label id ``pred``."""
    scored = model.transform(rows).withColumn("probs", vector_to_array("probability"))
    return scored.withColumn("pred", argmax(F.col("probs"))).select(*rows.columns, "probs", "pred")


def validation_scores(predicted: DataFrame, label: str = "label_id") -> dict[str, float]:
    """Loss, accuracy and macro scores of predicted rows."""
    masked = predicted.withColumn("mask", F.lit(1.0))
    loss = masked_cross_entropy(masked, "probs", label).first()[0]
    scores = classification_metrics(predicted, label, "pred").select(*METRICS).first()
    return {"loss": loss, **scores.asDict()}


def train_classifier(
    train: DataFrame,
    validation: DataFrame,
    *,
    grid: dict[str, list] | None = None,
    save_best_by: str = "f1",
    num_features: int = 2**16,
    max_iter: int = 50,
) -> Trained:
    """Fit one logistic regression per grid point on hashed word counts and keep the best.

    Tables carry ``text`` and a dense ``label_id``. A later candidate replaces the best only when strictly
    better: a lower loss, or a higher value of any other score.
    """
    require_choice(save_best_by, SAVE_BEST_BY, "save_best_by")
    for name, df in {"train": train, "validation": validation}.items():
        require_columns(df, ["text", "label_id"], f"{name} table")
    features = _features(num_features).fit(train)
    wanted = ["text", "label_id", "features"]
    fitted = features.transform(train).select(*wanted).persist(StorageLevel.MEMORY_AND_DISK)
    judged = features.transform(validation).select(*wanted).persist(StorageLevel.MEMORY_AND_DISK)
    grid = grid or {"regParam": [0.0, 0.01]}
    best, log = None, []
    try:
        for values in product(*grid.values()):
            settings = dict(zip(grid, values))
            learner = LogisticRegression(labelCol="label_id", featuresCol="features", maxIter=max_iter, **settings)
            model = PipelineModel([learner.fit(fitted)])
            scores = validation_scores(predict_labels(judged, model))
            log.append({**settings, **scores})
            score = -scores["loss"] if save_best_by == "loss" else scores[save_best_by]
            if best is None or score > best[0]:
                best = (score, model, settings)
    finally:
        fitted.unpersist()
        judged.unpersist()
    return Trained(PipelineModel([*features.stages, *best[1].stages]), best[2], log)
