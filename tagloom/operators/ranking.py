"""Exact ranks, cut-offs and running aggregates that never send a large group to one task.

Groups whose largest size is known to be small use a plain window. Larger ones are range-partitioned by
(group, order), written once, and numbered from the position inside each partition plus the row counts of
the partitions before it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.operators.sizing import MAX_GROUP_ROWS, small_or_whole, staged

_PARTITION_SHIFT = 33  # monotonically_increasing_id keeps the partition number above bit 33


def largest_group(df: DataFrame, group: list[str]) -> int:
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max("n")).first()[0] or 0


def rank_rows(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    out: str = "rank",
    *,
    largest: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add the 1-based position of each row in its group under ``order``, which must be total.

    ``largest`` is the size of the largest group where the caller knows it already.
    """
    if (largest_group(df, group) if largest is None else largest) <= max_group_rows:
        window = Window.partitionBy(*group).orderBy(*order)
        return df.withColumn(out, F.row_number().over(window).cast("bigint"))
    return _rank_by_ranges(df, group, order, out)


def _rank_by_ranges(df: DataFrame, group: list[str], order: list[Column], out: str) -> DataFrame:
    keys = [F.col(g) for g in group]
    placed = staged(
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_pos", F.monotonically_increasing_id()),
        "ranked",
    ).withColumn("_part", F.shiftright("_pos", _PARTITION_SHIFT))
    runs = placed.groupBy("_part", *group).agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("_part").alias("_run_part"),
        *[F.col(g).alias(f"_run_{g}") for g in group],
        "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    same = [F.col("_part") == F.col("_run_part")] + [F.col(g).eqNullSafe(F.col(f"_run_{g}")) for g in group]
    joined = placed.join(small_or_whole(runs), reduce(lambda a, b: a & b, same))
    rank = F.col("_before") + F.col("_pos") - F.col("_first") + 1
    return joined.select(*[F.col(c) for c in df.columns], rank.alias(out))


def top_n_per_group(
    df: DataFrame,
    group: str,
    n: int,
    score: Column,
    key: str,
    *,
    descending: bool = True,
    largest: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """The ``n`` best rows of every group by ``score``, ties going to the smaller unique ``key``.

    Only (group, score, key) is shuffled: it yields the n-th row of each group, and the full rows are then
    filtered against these cut-offs where they lie. ``df`` must return the same rows on every read. Rows
    without a group are dropped.
    """
    grouped = df.filter(F.col(group).isNotNull())
    narrow = grouped.select(F.col(group).alias("_g"), score.alias("_s"), F.col(key).alias("_k"))
    order = [F.col("_s").desc_nulls_last() if descending else F.col("_s").asc_nulls_last(), F.col("_k").asc()]
    ranked = rank_rows(narrow, ["_g"], order, "_r", largest=largest, max_group_rows=max_group_rows)
    ends = ranked.filter(F.col("_r").isin(n, n + 1)).groupBy("_g")
    cut, following = F.min_by(F.struct("_s", "_k"), "_r"), F.max_by(F.struct("_s", "_k"), "_r")
    clash = F.when((F.count(F.lit(1)) > 1) & cut.eqNullSafe(following), F.raise_error(
        F.lit(f"'{key}' does not tell rows with the same score apart")
    ).cast("boolean"))
    cuts = small_or_whole(ends.agg(cut.alias("_cut"), clash.alias("_clash")).filter(F.col("_clash").isNull()))
    cut_score, cut_key = F.col("_cut._s"), F.col("_cut._k")
    better = score > cut_score if descending else score < cut_score
    better = F.coalesce(better, cut_score.isNull() & score.isNotNull())
    tied = score.eqNullSafe(cut_score) & (F.col(key) <= cut_key)
    joined = grouped.join(cuts.select("_g", "_cut"), F.col(group) == F.col("_g"), "left")
    return joined.filter(F.col("_g").isNull() | better | tied).select(*df.columns)


def running_mean(
    log: DataFrame, group: list[str], step: str, value: str, out: str, *, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Mean of ``value`` over the rows of the group up to and including each step."""
    parts = {"_sum": (F.sum(value), F.sum), "_cnt": (F.count(value), F.sum)}
    rows, window = _after_earlier_chunks(log, group, step, parts, max_group_rows)
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.coalesce(F.col("_sum"), F.lit(0.0)) + F.coalesce(F.sum(value).over(upto), F.lit(0.0))
    count = F.coalesce(F.col("_cnt"), F.lit(0)) + F.count(value).over(upto)
    return rows.withColumn(out, F.when(count > 0, total / count)).select(*log.columns, out)


def best_so_far(
    log: DataFrame,
    group: list[str],
    step: str,
    value: str,
    out: str,
    *,
    minimize: bool,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """True where ``value`` is strictly better than every earlier value of its group."""
    best, pick = (F.min, F.least) if minimize else (F.max, F.greatest)
    rows, window = _after_earlier_chunks(log, group, step, {"_best": (best(value), best)}, max_group_rows)
    earlier = pick(F.col("_best"), best(value).over(window.rowsBetween(Window.unboundedPreceding, -1)))
    better = F.col(value) < earlier if minimize else F.col(value) > earlier
    flag = F.col(value).isNotNull() & F.coalesce(better, F.lit(True))
    return rows.withColumn(out, flag).select(*log.columns, out)


def _after_earlier_chunks(log, group, step, parts, max_group_rows):
    """Rows with the aggregates ``parts`` of all earlier chunks of their group, and the window inside a chunk.

    ``parts`` maps a name to (aggregate over rows, function that merges two such aggregates). A group that
    fits one task is a single chunk, so nothing comes before it.
    """
    if largest_group(log, group) <= max_group_rows:
        nothing = {name: F.lit(None).cast("double") for name in parts}
        return log.withColumns(nothing), Window.partitionBy(*group).orderBy(step)

    numbered = _rank_by_ranges(log, group, [F.col(step)], "_rank")
    rows = numbered.withColumn("_chunk", F.floor((F.col("_rank") - 1) / F.lit(max_group_rows)))
    totals = rows.groupBy(*group, "_chunk").agg(*[agg.alias(name) for name, (agg, _) in parts.items()])
    earlier = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        *[F.col(c).alias(f"_c_{c}") for c in [*group, "_chunk"]],
        *[merge(name).over(earlier).alias(name) for name, (_, merge) in parts.items()],
    )
    same = [F.col(c).eqNullSafe(F.col(f"_c_{c}")) for c in [*group, "_chunk"]]
    joined = rows.join(small_or_whole(carry), reduce(lambda a, b: a & b, same))
    return joined, Window.partitionBy(*group, "_chunk").orderBy("_rank")
