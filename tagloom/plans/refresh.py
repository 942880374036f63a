"""Pseudo-label refresh: keep confident rows of pure clusters, mask them for both tasks, balance classes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.checks import require_columns, require_names, require_non_negative
from tagloom.functions.casts import as_integer, at_least
from tagloom.functions.vectors import max_prob
from tagloom.operators.labels import purity_lookup
from tagloom.operators.ranking import MAX_GROUP_ROWS
from tagloom.operators.sampling import balance_by_score
from tagloom.operators.sizing import lookup_join
from tagloom.sources.tables import write_table


@dataclass(frozen=True)
class Thresholds:
    """Least purity and least top probability a row needs for each task."""

    metric_purity: float
    metric_max_prob: float
    classification_purity: float
    classification_max_prob: float

    def __post_init__(self):
        require_non_negative(
            metric_purity=self.metric_purity,
            metric_max_prob=self.metric_max_prob,
            classification_purity=self.classification_purity,
            classification_max_prob=self.classification_max_prob,
        )

    @property
    def least_purity(self) -> float:
        return min(self.metric_purity, self.classification_purity)

    @property
    def least_max_prob(self) -> float:
        return min(self.metric_max_prob, self.classification_max_prob)


def judge_rows(
    rows: DataFrame, centroids: DataFrame, thresholds: Thresholds, *, cluster: str = "cluster_id", probs: str = "probs"
) -> DataFrame:
    """Every row with its cluster's purity, its top probability and whether it passes the weaker limits."""
    purity = purity_lookup(centroids, cluster).withColumnRenamed(cluster, "_cluster")
    keyed = rows.withColumn("_cluster", as_integer(F.col(cluster)))
    judged = lookup_join(keyed, purity, "_cluster", what="centroid table", allow_empty=False).drop("_cluster")
    return judged.withColumns(
        {"max_prob": max_prob(F.col(probs)), "_pure": at_least(F.col("purity"), thresholds.least_purity)}
    ).withColumn("_sure", F.col("_pure") & at_least(F.col("max_prob"), thresholds.least_max_prob))


def mask_rows(judged: DataFrame, thresholds: Thresholds) -> DataFrame:
    """Rows passing the weaker limits, with a 0/1 mask per task; a row may stay with both masks 0."""
    t = thresholds
    metric = at_least(F.col("purity"), t.metric_purity) & at_least(F.col("max_prob"), t.metric_max_prob)
    classification = at_least(F.col("purity"), t.classification_purity) & at_least(
        F.col("max_prob"), t.classification_max_prob
    )
    return judged.filter("_sure").withColumns(
        {"metric_mask": metric.cast("bigint"), "classification_mask": classification.cast("bigint")}
    )


def refresh(
    rows: DataFrame,
    centroids: DataFrame,
    thresholds: Thresholds,
    *,
    key: str,
    text: str = "text",
    label: str = "label",
    cluster: str = "cluster_id",
    probs: str = "probs",
    balance: bool = True,
    keep_key: bool = False,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """``text, label, metric_mask, classification_mask`` of the rows worth training on.

    ``key`` is a unique column that settles ties in the top probability.
    """
    require_names(text=text, label=label, cluster=cluster, probs=probs, key=key)
    needed = list(dict.fromkeys([key, text, label, cluster, probs]))
    require_columns(rows, needed, "clustered rows")
    kept = mask_rows(judge_rows(rows.select(*needed), centroids, thresholds, cluster=cluster, probs=probs), thresholds)
    if balance:
        kept = balance_by_score(kept, label, "max_prob", key, max_group_rows=max_group_rows)
    columns = [text, label, "metric_mask", "classification_mask"]
    return kept.select(*([key] if keep_key else []), *columns)


def refresh_audit(judged: DataFrame) -> DataFrame:
    """One row of counts: all rows, those lost to purity, those then lost to the top probability, the rest."""
    return judged.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~F.col("_pure")).alias("dropped_purity"),
        F.count_if(F.col("_pure") & ~F.col("_sure")).alias("dropped_max_prob"),
        F.count_if(F.col("_sure")).alias("rows_kept"),
    )


def mask_fractions(dataset: DataFrame) -> DataFrame:
    """Rows and the share of each mask, 0 for an empty table."""
    return dataset.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.avg("metric_mask"), F.lit(0.0)).alias("metric_fraction"),
        F.coalesce(F.avg("classification_mask"), F.lit(0.0)).alias("classification_fraction"),
    )


def run_refresh(rows: DataFrame, centroids: DataFrame, thresholds: Thresholds, output_path: str, **options) -> None:
    """The refresh written as a Parquet table."""
    require_names(output_path=output_path)
    write_table(refresh(rows, centroids, thresholds, **options), output_path)
