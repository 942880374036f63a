"""Purity and label map of clusters, kept up to date while shards of clustered rows arrive.

Each (cluster, slot) keeps the number of its rows per label and the shards it has counted. Slots are hashes of the shard,
so that a cluster with a third of all rows is spread over many keys, and a key only remembers shards of its own slot. A
shard is counted once: a file that is delivered again, under whatever name, changes nothing, and of two deliveries in one
batch the one with the smaller path counts. A micro-batch appends the totals it changed under its number, so running it
again after a crash writes the same rows; the newest total of each key and label is the current one.

A shard's name is the number in ``part-<digits>.parquet``, else its file name. Rows without a cluster or label, or whose
cluster or label is no whole number, are not counted, as in the batch job.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tagloom.checks import require_columns, require_names, require_positive
from tagloom.functions.casts import as_integer
from tagloom.operators.labels import purity_from_counts
from tagloom.sources import paths
from tagloom.sources.tables import shard_number

SLOTS = 32
TOTALS = "cluster_id bigint, slot int, label bigint, n bigint"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LabelCounts(StatefulProcessor):
    """State of one (cluster, slot): rows per label, and the shards that were counted."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.labels = handle.getMapState("labels", "label bigint", "n bigint")
        self.shards = handle.getMapState("shards", "shard string", "counted boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seen: dict[str, dict[str, dict[int, int]]] = {}
        for part in rows:
            for (shard, file, label), n in part.groupby(["shard", "file", "label"]).size().items():
                labels = seen.setdefault(shard, {}).setdefault(file, {})
                labels[label] = labels.get(label, 0) + n
        changed: dict[int, int] = {}
        for shard, files in seen.items():
            if self.shards.containsKey((shard,)):
                continue
            self.shards.updateValue((shard,), (True,))
            for label, n in files[min(files)].items():
                changed[label] = changed.get(label, 0) + n
        for label, n in changed.items():
            before = self.labels.getValue((int(label),))
            changed[label] = int(n) + (before[0] if before else 0)
            self.labels.updateValue((int(label),), (changed[label],))
        if changed:
            yield pd.DataFrame({
                "cluster_id": [key[0]] * len(changed),
                "slot": [key[1]] * len(changed),
                "label": list(changed),
                "n": list(changed.values()),
            })

    def close(self) -> None:
        pass


def shard_name(file: Column) -> Column:
    name = F.element_at(F.split(file, "/"), -1)
    return F.coalesce(shard_number(file).cast("string"), name)


def count_arriving(
    stream: DataFrame,
    output_path: str,
    checkpoint_path: str,
    *,
    cluster: str = "cluster_id",
    label: str = "label",
    shard: Column | None = None,
    slots: int = SLOTS,
    once: bool = True,
) -> StreamingQuery:
    """Keep the label counts of a stream of files; ``once`` stops after the files present now.

    ``shard`` names the shard a row belongs to where the file name doesn't. ``slots`` must stay the same for one
    checkpoint.
    """
    require_columns(stream, [cluster, label], "stream")
    require_names(output_path=output_path, checkpoint_path=checkpoint_path)
    require_positive(slots=slots)
    spark, file = stream.sparkSession, F.col("_metadata.file_path")
    rows = stream.select(
        as_integer(F.col(cluster)).alias("cluster_id"),
        as_integer(F.col(label)).alias("label"),
        file.alias("file"),
        (shard_name(file) if shard is None else shard).alias("shard"),
    ).dropna(subset=["cluster_id", "label"])
    rows = rows.withColumn("slot", F.pmod(F.xxhash64("shard"), F.lit(slots)).cast("int"))
    totals = rows.groupBy("cluster_id", "slot").transformWithStateInPandas(LabelCounts(), TOTALS, "Update", "None")

    def append(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output_path}/batch={number}")

    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)  # the state of this operator needs it; the query takes it with it
    try:
        writer = totals.writeStream.outputMode("update").foreachBatch(append).option("checkpointLocation", checkpoint_path)
        return (writer.trigger(availableNow=True) if once else writer).start()
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def current_counts(spark: SparkSession, output_path: str) -> DataFrame:
    """``cluster_id``, ``label`` and ``n`` as of the last batch; the form ``cluster_label_counts`` has."""
    if not any(n.startswith("batch=") for n in paths.names(spark, output_path)):
        return spark.createDataFrame([], "cluster_id bigint, label bigint, n bigint")
    log = spark.read.option("basePath", output_path).schema(f"{TOTALS}, batch bigint").parquet(output_path)
    newest = log.groupBy("cluster_id", "slot", "label").agg(F.max_by("n", "batch").alias("n"))
    return newest.groupBy("cluster_id", "label").agg(F.sum("n").alias("n"))


def current_purity(spark: SparkSession, output_path: str) -> DataFrame:
    return purity_from_counts(current_counts(spark, output_path))


def current_label_map(spark: SparkSession, output_path: str, exclude_invalid: bool = False) -> DataFrame:
    """Most frequent label of each cluster, the smallest one on ties."""
    counts = current_counts(spark, output_path)
    if exclude_invalid:
        counts = counts.filter("cluster_id <> -1")
    return counts.groupBy("cluster_id").agg(F.max_by("label", F.struct("n", -F.col("label"))).alias("label"))
