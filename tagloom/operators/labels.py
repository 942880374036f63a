"""Label algebra: counts per cluster, purity, majority labels, dictionaries and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.checks import require_columns
from tagloom.functions.casts import as_integer
from tagloom.operators.ranking import rank_rows
from tagloom.operators.sizing import MAX_GROUP_ROWS, lookup_join, small_or_whole


def cluster_label_counts(
    rows: DataFrame, cluster: str = "cluster_id", label: str = "label", *, whole_labels: bool = False
) -> DataFrame:
    """Row count of every (cluster, label); rows missing either are dropped.

    The cluster must be a whole number, other values are skipped; ``whole_labels`` treats labels likewise.
    """
    require_columns(rows, [cluster, label], "clustered rows")
    kept = rows.select(cluster, label).dropna(subset=[cluster, label])
    kept = kept.withColumn(cluster, as_integer(F.col(cluster)))
    if whole_labels:
        kept = kept.withColumn(label, as_integer(F.col(label)))
    return kept.dropna(subset=[cluster, label]).groupBy(cluster, label).agg(F.count(F.lit(1)).alias("n"))


def incomplete_rows(rows: DataFrame, cluster: str = "cluster_id", label: str = "label") -> DataFrame:
    """One row: how many rows there are, and how many the counts leave out for a missing cluster or label."""
    require_columns(rows, [cluster, label], "clustered rows")
    numeric = {f.name for f in rows.schema.fields if f.dataType.typeName() in ("float", "double")}
    missing = [F.col(c).isNull() | (F.isnan(c) if c in numeric else F.lit(False)) for c in (cluster, label)]
    return rows.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(missing[0] | missing[1]).alias("dropped_rows"))


def purity_from_counts(counts: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    return counts.groupBy(cluster).agg((F.max("n") / F.sum("n")).alias("purity"))


def cluster_purity(rows: DataFrame, cluster: str = "cluster_id", label: str = "label") -> DataFrame:
    """Share of the most frequent label among the labelled rows of each cluster."""
    return purity_from_counts(cluster_label_counts(rows, cluster, label), cluster)


def majority_labels(
    rows: DataFrame, cluster: str = "cluster_id", label: str = "label", *, exclude_invalid: bool = False
) -> DataFrame:
    """Most frequent label of each cluster, the smallest one on ties.

    ``exclude_invalid`` leaves out cluster -1, which holds the rows without a usable vector.
    """
    counts = cluster_label_counts(rows, cluster, label, whole_labels=True)
    if exclude_invalid:
        counts = counts.filter(F.col(cluster) != -1)
    return counts.groupBy(cluster).agg(F.max_by(label, F.struct(F.col("n"), -F.col(label))).alias(label))


def attach_purity(centroids: DataFrame, purity: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """Centroids with their purity, replacing an older one; null for a centroid without labelled rows."""
    require_columns(centroids, [cluster], "centroids")
    joined = lookup_join(centroids.drop("purity"), purity.select(cluster, "purity"), cluster, what="purity table")
    return joined.select(cluster, *[c for c in centroids.columns if c not in (cluster, "purity")], "purity")


def centroids_without_purity(centroids: DataFrame, purity: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    return centroids.select(cluster).join(small_or_whole(purity.select(cluster)), cluster, "left_anti").orderBy(cluster)


def purity_lookup(centroids: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """(cluster, purity) from a centroid table, skipping ids that are no whole numbers."""
    require_columns(centroids, [cluster, "purity"], "centroids")
    whole = centroids.select(as_integer(F.col(cluster)).alias(cluster), F.col("purity").cast("double"))
    return whole.filter(F.col(cluster).isNotNull())


def label_lookup(rows: DataFrame, label_map: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """Attach the majority label of each row's cluster; null for an unknown cluster."""
    return lookup_join(rows, label_map, cluster, what="cluster label map")


def class_counts(rows: DataFrame, label: str = "label") -> DataFrame:
    """Rows per class; a missing label is no class."""
    present = rows.select(label).dropna(subset=[label])
    return present.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_size_range(rows: DataFrame, label: str = "label") -> tuple[int, int, int]:
    """(smallest class, largest class, number of classes); all zero for an empty table."""
    row = class_counts(rows, label).agg(F.min("n"), F.max("n"), F.count(F.lit(1))).first()
    return row[0] or 0, row[1] or 0, row[2]


def label_dictionary(
    tables: list[DataFrame], label: str = "label", *, whole: bool = False, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Dense ids from 0 for the sorted distinct labels of all ``tables``, in the order of their own type.

    ``whole`` reads labels as integers and fails on any that is not one.
    """
    parts = [t.select(F.col(label).cast("bigint").alias(label) if whole else F.col(label)) for t in tables]
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.union(part)
    ranked = rank_rows(everything.distinct(), [], [F.col(label).asc()], "label_id", max_group_rows=max_group_rows)
    return ranked.select(label, (F.col("label_id") - 1).cast("int").alias("label_id"))


def encode_labels(rows: DataFrame, dictionary: DataFrame, label: str = "label") -> DataFrame:
    """Add ``label_id``; a label the dictionary does not know is an error raised while the query runs."""
    joined = lookup_join(rows, dictionary, label, what="label dictionary")
    unknown = F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce(F.col(label).cast("string"), F.lit("null"))))
    return joined.withColumn("label_id", F.when(F.col("label_id").isNull(), unknown.cast("int")).otherwise(F.col("label_id")))


def decode_labels(rows: DataFrame, dictionary: DataFrame, label: str = "label") -> DataFrame:
    """Add the label of each ``label_id``."""
    return lookup_join(rows, dictionary.select("label_id", label), "label_id", what="label dictionary")


def num_classes(dictionary: DataFrame, label: str = "label") -> int:
    return dictionary.select(label).distinct().count()


def remap_predictions(rows: DataFrame, mapping: dict[int, int], pred: str = "pred", out: str = "mapped") -> DataFrame:
    """Send each predicted id through a dense mapping ``0..max``; an id beyond it is an error."""
    table = F.array(*[F.lit(mapping[i]).cast("bigint") for i in range(len(mapping))])
    index = F.col(pred).cast("int")
    beyond = F.raise_error(F.concat(F.lit("no mapping for prediction "), F.coalesce(index.cast("string"), F.lit("null"))))
    known = index.between(0, len(mapping) - 1)
    return rows.withColumn(out, F.when(known, F.get(table, index)).otherwise(beyond.cast("bigint")))
