"""Scoring of a CSV with ``ID`` and ``text`` into a CSV with ``ID`` and ``label``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.checks import require_classes
from tagloom.functions.text import MISSING_CELLS, missing_as_nan_text
from tagloom.functions.vectors import class_name
from tagloom.operators.scoring import Scorer, score_texts
from tagloom.sources.tables import read_scoring_csv, write_csv


def label_texts(rows: DataFrame, load_model: Callable[[], Scorer], classes: list[str], batch_size: int = 64) -> DataFrame:
    """``ID`` and the predicted class name; a missing text is scored as ``nan``, a failing one stops the job."""
    require_classes(classes)
    texts = rows.select("ID", missing_as_nan_text(F.col("text"), MISSING_CELLS).alias("text"))
    scored = score_texts(texts, load_model, batch_size=batch_size)
    failed = F.raise_error(F.concat(F.lit("a text could not be scored: "), F.col("error"))).cast("string")
    name = class_name(F.col("label"), classes)
    return scored.select("ID", F.when(F.col("error").isNotNull(), failed).otherwise(name).alias("label"))


def score_csv(
    spark: SparkSession,
    path: str,
    load_model: Callable[[], Scorer],
    classes: list[str],
    *,
    batch_size: int = 64,
    output_path: str | None = None,
) -> DataFrame:
    labelled = label_texts(read_scoring_csv(spark, path), load_model, classes, batch_size)
    if output_path:
        write_csv(labelled, output_path)
    return labelled
