"""Dataset preparation for training: check, balance, encode, shuffle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.checks import require_columns
from tagloom.operators.labels import encode_labels, label_dictionary
from tagloom.operators.sampling import downsample, shuffled, upsample
from tagloom.operators.sizing import staged

PLAIN_COLUMNS = ["text", "label"]
MASKED_COLUMNS = ["text", "label", "metric_mask", "classification_mask"]


@dataclass(frozen=True)
class Prepared:
    train: DataFrame
    validation: DataFrame
    dictionary: DataFrame


def prepare(
    train: DataFrame,
    validation: DataFrame,
    *,
    key: str,
    masked: bool = False,
    balance: str | None = None,
    shuffle: bool = True,
    seed: int = 42,
) -> Prepared:
    """Encode both tables with one dictionary and balance the training rows.

    ``balance`` is None, ``"down"`` or ``"up"``. The dictionary covers the labels of both tables; balancing keeps
    some rows of every label. It is written down once, since every table needs it. Rows are put in random order last,
    so nothing that follows can undo it; up-sampled rows always are.
    """
    columns = MASKED_COLUMNS if masked else PLAIN_COLUMNS
    require_columns(train, [key, *columns], "train table")
    require_columns(validation, columns, "validation table")
    if balance not in (None, "down", "up"):
        raise ValueError(f"Invalid balance '{balance}'. Must be 'down', 'up' or None")
    if masked:
        train = train.withColumn("label", train["label"].cast("bigint"))
        validation = validation.withColumn("label", validation["label"].cast("bigint"))
    known = train.filter(F.col("label").isNotNull()) if balance else train
    dictionary = staged(label_dictionary([known, validation], "label", whole=masked), "label_dictionary")
    if balance == "down":
        train = downsample(train, "label", key, seed)
    elif balance == "up":
        train = known
    train = encode_labels(train, dictionary)
    if balance == "up":
        train = upsample(train, "label", key, seed)
    elif shuffle:
        train = shuffled(train, key, seed)
    return Prepared(train, encode_labels(validation, dictionary), dictionary)
