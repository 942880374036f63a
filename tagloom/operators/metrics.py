"""Classification metrics from (label, prediction) tables.

Everything starts from the counts per (label, prediction), which Spark pre-aggregates before its only
shuffle; what follows works on at most classes x classes rows per group. Macro averages run over the labels
seen as truth or as prediction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.checks import require_in_range, require_non_negative
from tagloom.operators.sizing import small_or_whole

METRICS = ["accuracy", "precision", "recall", "f1"]
LOG_FLOOR = 1e-300


def pair_counts(pairs: DataFrame, label: str = "label", pred: str = "pred", by: list[str] | None = None) -> DataFrame:
    keys = [F.col(c) for c in by or []]
    return pairs.groupBy(*keys, F.col(label).alias("label"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).alias("n")
    )


def per_class_scores(
    pairs: DataFrame, label: str = "label", pred: str = "pred", by: list[str] | None = None
) -> DataFrame:
    """Precision, recall and F1 of every class seen; a zero denominator gives 0."""
    hit = F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(F.lit(0))
    sides = F.array(
        F.struct(F.col("label").alias("class"), hit.alias("tp"), F.col("n").alias("actual"), F.lit(0).alias("predicted")),
        F.struct(F.col("pred").alias("class"), F.lit(0).alias("tp"), F.lit(0).alias("actual"), F.col("n").alias("predicted")),
    )
    keys = by or []
    rows = pair_counts(pairs, label, pred, by).select(*keys, F.explode(sides).alias("s")).select(*keys, "s.*")
    totals = rows.groupBy(*keys, "class").agg(
        F.sum("tp").alias("tp"), F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted")
    )

    def ratio(top: Column, bottom: Column) -> Column:
        return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))

    return totals.withColumns(
        {
            "precision": ratio(F.col("tp"), F.col("predicted")),
            "recall": ratio(F.col("tp"), F.col("actual")),
            "f1": ratio(2 * F.col("tp"), F.col("actual") + F.col("predicted")),
        }
    )


def classification_metrics(
    pairs: DataFrame, label: str = "label", pred: str = "pred", by: list[str] | None = None
) -> DataFrame:
    """Accuracy and macro precision, recall and F1; one row, or one per group of ``by``. 0 for no rows."""
    scores = per_class_scores(pairs, label, pred, by).groupBy(*(by or []))
    measured = scores.agg(
        (F.sum("tp") / F.sum("actual")).alias("accuracy"),
        *[F.avg(m).alias(m) for m in METRICS[1:]],
    )
    return measured.fillna(0.0, subset=METRICS)


def masked_metrics_by_batch(
    pairs: DataFrame, batch: str, mask: str, label: str = "label", pred: str = "pred"
) -> DataFrame:
    """Metrics of each batch over its rows with a positive mask; a batch without any scores 0 throughout."""
    batches = pairs.select(batch).distinct()
    measured = classification_metrics(pairs.filter(F.col(mask) > 0), label, pred, by=[batch])
    return batches.join(measured, batch, "left").fillna(0.0, subset=METRICS)


def confusion_counts(
    pairs: DataFrame, num_classes: int, label: str = "label", pred: str = "pred", check: bool = True
) -> DataFrame:
    """Counts of every (label, prediction) cell of the full grid, empty cells included."""
    if check:
        require_in_range(pairs, [label, pred], num_classes)
    cells = pairs.sparkSession.range(num_classes * num_classes).select(
        F.floor(F.col("id") / num_classes).alias("label"), F.pmod("id", F.lit(num_classes)).alias("pred")
    )
    counts = small_or_whole(pair_counts(pairs, label, pred))
    return cells.join(counts, ["label", "pred"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def confusion_normalized(counts: DataFrame) -> DataFrame:
    """Cells as a share of their row, 0 in an empty row, with the share as shown to a reader."""
    total = F.sum("n").over(Window.partitionBy("label"))
    share = F.when(total > 0, F.col("n") / total).otherwise(F.lit(0.0))
    shown = F.concat(F.format_number(share * 100, 1), F.lit("%"))
    return counts.select("label", "pred", share.alias("share"), shown.alias("shown"))


def cross_entropy(probs: Column, label: Column, smoothing: float = 0.0) -> Column:
    """Loss of one row of class probabilities; ``smoothing`` spreads that weight evenly over all classes.

    A label without a probability, or a missing or undefined probability, is an error raised while the query runs.
    """
    require_non_negative(smoothing=smoothing)

    def surprise(p: Column) -> Column:
        return -F.log(F.greatest(p, F.lit(LOG_FLOOR)))

    index = label.cast("int")
    own = surprise(F.get(probs, index))
    if smoothing != 0:
        spread = F.aggregate(probs, F.lit(0.0), lambda acc, p: acc + surprise(p)) / F.size(probs)
        own = (1 - smoothing) * own + smoothing * spread
    fits = index.between(0, F.size(probs) - 1) & ~F.exists(probs, lambda p: p.isNull() | F.isnan(p))
    told = F.concat(F.lit("no probability for label "), F.coalesce(label.cast("string"), F.lit("null")))
    return F.when(F.coalesce(fits, F.lit(False)), own).otherwise(F.raise_error(told).cast("double"))


def masked_cross_entropy(
    rows: DataFrame,
    probs: str = "probs",
    label: str = "label",
    mask: str = "mask",
    smoothing: float = 0.0,
    by: list[str] | None = None,
) -> DataFrame:
    """Mask-weighted mean loss, one row or one per group of ``by``; 0 where no mask is positive."""
    loss = cross_entropy(F.col(probs), F.col(label), smoothing)
    weight = F.col(mask).cast("double")
    mean = F.sum(F.when(weight != 0, loss * weight).otherwise(F.lit(0.0))) / F.sum(weight)
    return rows.groupBy(*(by or [])).agg(
        F.when(F.count_if(weight > 0) > 0, mean).otherwise(F.lit(0.0)).alias("classification_loss")
    )


def total_loss(classification: Column, metric: Column, classification_weight: float = 1.0, metric_weight: float = 1.0) -> Column:
    return classification * classification_weight + metric * metric_weight


def epoch_means(log: DataFrame, by: list[str], value: str = "value", out: str = "epoch_value") -> DataFrame:
    """Mean over the batches of each epoch."""
    return log.groupBy(*by).agg(F.avg(value).alias(out))
