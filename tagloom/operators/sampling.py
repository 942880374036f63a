"""Balancing, resampling, shuffling and sharding of rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.checks import require_positive
from tagloom.operators.labels import class_counts, class_size_range
from tagloom.operators.ranking import rank_rows, top_n_per_group
from tagloom.operators.sizing import MAX_GROUP_ROWS, small_or_whole, staged
from tagloom.sources import paths

_DRAWS_PER_SLICE = 1_000_000
#: Up to this many bounds between shards are written into an expression.
MAX_BOUNDS = 500


def balance_by_score(
    rows: DataFrame, label: str, score: str, key: str, *, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Cut every class down to the size of the smallest one, keeping the highest scores."""
    smallest, largest, _ = class_size_range(rows, label)
    if smallest == 0:
        return rows.filter(F.col(label).isNotNull())
    return top_n_per_group(
        rows, label, smallest, F.col(score), key, largest=largest, max_group_rows=max_group_rows
    )


def downsample(
    rows: DataFrame, label: str, key: str, seed: int = 42, *, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Cut every class down to the size of the smallest one, keeping rows at random but repeatably."""
    smallest, largest, _ = class_size_range(rows, label)
    if smallest == 0:
        raise ValueError("there are no labelled rows to keep")
    draw = F.xxhash64(F.col(key), F.lit(seed))
    return top_n_per_group(
        rows, label, smallest, draw, key, descending=False, largest=largest, max_group_rows=max_group_rows
    )


def upsample(
    rows: DataFrame, label: str, key: str, seed: int = 42, *, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Draw (largest class x number of classes) rows with replacement, classes being equally likely, in random order.

    Draws are counted per source row before they meet the data. A row drawn often is shipped once for every so
    many draws, and each such slice is copied by a task of its own. Neither rows nor their order depend on how
    ``rows`` is partitioned. ``key`` must be unique.
    """
    _, largest, classes = class_size_range(rows, label)
    if classes == 0:
        raise ValueError("there are no labels to draw rows by")
    spark = rows.sparkSession
    if not rows.filter(F.col(label).isNotNull()).groupBy(key).count().filter("count > 1").isEmpty():
        raise ValueError(f"'{key}' is not unique, rows cannot be drawn by it")
    by_label = [F.col(label).asc()]
    sizes = rank_rows(class_counts(rows, label), [], by_label, "_class", max_group_rows=max_group_rows)
    sizes = small_or_whole(sizes.select((F.col("_class") - 1).alias("_class"), F.col(label).alias("_label"), "n"))

    draws = spark.range(largest * classes).select(
        F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(classes)).alias("_class"),
        F.xxhash64("id", F.lit(seed), F.lit("row")).alias("_u"),
        F.floor(F.col("id") / F.lit(_DRAWS_PER_SLICE)).alias("_slice"),
    )
    drawn = draws.join(sizes, "_class").select(
        "_label", (F.pmod("_u", "n") + 1).alias("_row"), "_slice"
    )
    drawn = drawn.groupBy("_label", "_row", "_slice").agg(F.count(F.lit(1)).alias("_times"))

    narrow = rows.filter(F.col(label).isNotNull()).select(F.col(label).alias("_label"), F.col(key).alias("_key"))
    numbered = rank_rows(
        narrow, ["_label"], [F.col("_key").asc()], "_row", largest=largest, max_group_rows=max_group_rows
    )
    picked = drawn.join(numbered, ["_label", "_row"]).select("_key", "_slice", "_times")
    # a partition count of its own keeps small slices from being packed together before they grow
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sliced = rows.join(picked, F.col(key) == F.col("_key")).repartition(tasks, "_key", "_slice")
    copies = sliced.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times"))))
    place = F.xxhash64("_key", "_slice", "_copy", F.lit(seed))
    return copies.orderBy(place, "_key", "_slice", "_copy").select(*rows.columns)


def shuffled(rows: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Rows in a repeatable random order."""
    return rows.orderBy(F.xxhash64(F.col(key), F.lit(seed)), F.col(key))


def first_n(rows: DataFrame, n: int | None, key: str, *, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """The first ``n`` rows by ``key``; all of them when ``n`` is None."""
    if n is None:
        return rows
    require_positive(sample_limit=n)
    cut = keys_at_ranks(rows, key, [n], max_group_rows=max_group_rows)
    return rows if not cut else rows.filter(F.col(key) <= F.lit(cut[0]))


def keys_at_ranks(rows: DataFrame, key: str, ranks: Sequence[int], *, max_group_rows: int = MAX_GROUP_ROWS) -> list:
    """Keys standing at the given positions of the sorted key column; positions past the end are left out."""
    ranked = rank_rows(rows.select(key), [], [F.col(key).asc()], "_rank", max_group_rows=max_group_rows)
    return [r[0] for r in ranked.filter(F.col("_rank").isin(list(ranks))).orderBy("_rank").collect()]


def assign_shards(
    rows: DataFrame,
    num_shards: int,
    key: str,
    out: str = "shard_id",
    *,
    max_group_rows: int = MAX_GROUP_ROWS,
    max_bounds: int = MAX_BOUNDS,
) -> DataFrame:
    """Contiguous key ranges of ``ceil(n / num_shards)`` rows each; trailing shards may be empty.

    Only the keys are ranked. Few shards are found by halving the list of their last keys inside an expression;
    for many, keys meet their ranks in a join. Rows of one key share a shard.
    """
    require_positive(num_shards=num_shards)
    total = rows.count()
    size = math.ceil(total / num_shards)
    last_ranks = range(size, total, size) if size else []
    if not last_ranks:
        return rows.withColumn(out, F.lit(0))
    if len(last_ranks) > max_bounds:
        ranked = rank_rows(rows.select(F.col(key).alias("_key")), [], [F.col("_key").asc()], "_rank", max_group_rows=max_group_rows)
        shards = ranked.groupBy("_key").agg(F.floor((F.min("_rank") - 1) / size).cast("int").alias(out))
        joined = rows.drop(out).join(shards, F.col(key).eqNullSafe(F.col("_key")))
        return joined.select(*[c for c in rows.columns if c != out], out)
    last_keys = keys_at_ranks(rows, key, last_ranks, max_group_rows=max_group_rows)

    def halved(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col(key) <= F.lit(last_keys[middle]), halved(low, middle)).otherwise(halved(middle + 1, high))

    return rows.withColumn(out, halved(0, len(last_keys)))


def pending_shards(rows: DataFrame, done: DataFrame, shard: str = "shard_id") -> DataFrame:
    """Rows of the shards that are not among the finished ones."""
    return rows.join(small_or_whole(done.select(shard).distinct()), shard, "left_anti")


def write_shards(rows: DataFrame, path: str, shard: str = "shard_id", resume: bool = False) -> None:
    """Write rows under one folder per shard; ``resume`` writes only shards the folder does not hold whole yet.

    A shard is whole when the folder has as many rows of it as ``rows`` has, so what a writer that died left behind
    is written anew. Shards of the folder that ``rows`` does not have stay.
    """
    spark = rows.sparkSession
    paths.refuse_overwrite_of_input(rows, path)
    overwrite = "static"
    if resume and paths.exists(spark, path):
        schema = T.StructType([f for f in rows.schema if f.name != shard] + [rows.schema[shard]])
        there = spark.read.schema(schema).parquet(path).groupBy(shard).agg(F.count(F.lit(1)).alias("_there"))
        wanted = rows.groupBy(shard).agg(F.count(F.lit(1)).alias("_wanted"))
        whole = wanted.join(there, shard).filter("_there = _wanted").select(shard)
        rows, overwrite = pending_shards(rows, staged(whole, "whole_shards"), shard), "dynamic"
    writer = rows.hint("rebalance", F.col(shard)).write.mode("overwrite").option("partitionOverwriteMode", overwrite)
    writer.partitionBy(shard).parquet(path)
