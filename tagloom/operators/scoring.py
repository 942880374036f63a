"""Batch scoring of texts with a plugged-in model.

A model enters as a function without arguments that returns a scorer. It is called once per task; the scorer
takes a list of texts and returns their embeddings and logits as two arrays. Probabilities, labels and class
names are column expressions on top.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.checks import require_classes, require_columns, require_positive
from tagloom.functions.vectors import argmax, class_name, softmax

Scorer = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


def score_texts(
    rows: DataFrame, load_model: Callable[[], Scorer], *, text: str = "text", batch_size: int = 32
) -> DataFrame:
    """Add ``cls``, ``probs``, ``label`` and ``error``.

    A batch the scorer fails on is retried text by text; a text that still fails keeps its row, with the
    message in ``error`` and nothing in the other columns.
    """
    require_columns(rows, [text], "texts")
    require_positive(batch_size=batch_size)
    added = [
        T.StructField("cls", T.ArrayType(T.DoubleType())),
        T.StructField("logits", T.ArrayType(T.DoubleType())),
        T.StructField("error", T.StringType()),
    ]
    base = rows.drop(*[f.name for f in added], "probs", "label")
    schema = T.StructType([*base.schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = load_model()

        def attempt(texts):
            vectors, logits = scorer(texts)
            lists = [np.asarray(x, dtype=np.float64).tolist() for x in (vectors, logits)]
            if len(lists[0]) != len(texts) or len(lists[1]) != len(texts):
                raise ValueError("the scorer returned another number of rows")
            return [(v, z, None) for v, z in zip(*lists)]

        def guarded(texts):
            try:
                return attempt(texts)
            except Exception as failure:
                if len(texts) == 1:
                    return [(None, None, f"{type(failure).__name__}: {failure}")]
                return [result for one in texts for result in guarded([one])]

        for batch in batches:
            texts = batch.column(text).to_pylist()
            results = []
            for start in range(0, len(texts), batch_size):
                results.extend(guarded(texts[start : start + batch_size]))
            vectors, logits, errors = zip(*results) if results else ((), (), ())
            numbers = pa.list_(pa.float64())
            extra = [pa.array(vectors, numbers), pa.array(logits, numbers), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *extra], names=[*batch.schema.names, "cls", "logits", "error"]
            )

    scored = base.mapInArrow(run, schema)
    return scored.select(
        *base.columns, "cls", softmax(F.col("logits")).alias("probs"), argmax(F.col("logits")).alias("label"), "error"
    )


def without_failures(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("error").isNull()).drop("error")


def failures(scored: DataFrame, *keep: str) -> DataFrame:
    return scored.filter(F.col("error").isNotNull()).select(*keep, "error")


def predicted_class(probs: Column, classes: list[str]) -> Column:
    return class_name(argmax(probs), require_classes(classes))


def prediction_record(rows: DataFrame, classes: list[str], *, probs: str = "probs", keep: list[str] | None = None) -> DataFrame:
    """The predicted class and one column per class with its probability to 4 places.

    A row whose probabilities do not match the classes in number is an error.
    """
    require_classes(classes)
    p = F.col(probs)
    wrong = F.raise_error(F.concat(F.lit(f"expected {len(classes)} probabilities, got "), F.size(p).cast("string")))
    checked = F.when(F.size(p) == len(classes), p).otherwise(wrong.cast("array<double>"))
    record = rows.withColumn("_p", checked)
    scores = [F.round(F.get("_p", F.lit(i)), 4).alias(name) for i, name in enumerate(classes)]
    return record.select(*(keep or []), predicted_class(F.col("_p"), classes).alias("prediction"), *scores)
