"""Exact nearest neighbours by distance that skip most of the bank where vectors form clusters.

A bounded sample of bank vectors serves as pivots; every bank vector belongs to the cell of its nearest pivot. A query first
searches the cells that surely hold ``k`` vectors near it. Its k-th best so far then bounds what is left: the triangle
inequality and the plane between two pivots show which cells can hold nothing closer, and only the others are searched.
Results are the same as those of ``nearest_neighbors``, whatever the pivots; bounds allow for rounding.

A cell of any size, also one vector that a third of the bank repeats, is cut into blocks of at most about ``cell_rows`` rows,
and so are the queries that visit it. No task sees more than two blocks, and at most ``k`` candidates a query leave it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.checks import require_columns, require_positive
from tagloom.functions.vectors import is_valid_vector
from tagloom.operators.neighbors import SLICE_ENTRIES, best_ranked, cell_search, rows_per_cell, vector_width
from tagloom.operators.sizing import staged

MAX_PIVOTS = 1024
PIVOT_BYTES = 32 * 2**20


@dataclass(frozen=True)
class Found:
    """Neighbours (query id, bank id, score, rank), and how many pairs of vectors were compared of how many there are."""

    neighbors: DataFrame
    compared: int
    pairs: int


class Cells:
    """Distances to the pivots, and the cells that a query has to search."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        self.norms = (pivots**2).sum(axis=1)
        self.apart = self.gaps(pivots)[0]
        self.sizes = self.least = self.most = None

    def gaps(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances of points to all pivots, and by how much each row's squares may be off."""
        norms = (points**2).sum(axis=1)
        squares = norms[:, None] + self.norms - 2 * (points @ self.pivots.T)
        reach = np.sqrt(norms) + math.sqrt(self.norms.max())
        off = 16 * np.finfo(float).eps * (points.shape[1] + 2) * reach**2
        return np.sqrt(np.maximum(squares, 0)), off

    def with_bank(self, rows: list) -> Cells:
        """Take in the number of vectors and the smallest and largest distance of each cell."""
        count = len(self.pivots)
        self.sizes, self.least, self.most = np.zeros(count, np.int64), np.zeros(count), np.zeros(count)
        for r in rows:
            self.sizes[r["_cell"]], self.least[r["_cell"]], self.most[r["_cell"]] = r["n"], r["least"], r["most"]
        return self

    def first(self, points: np.ndarray, k: int) -> list[np.ndarray]:
        """The cells nearest at their far ends that hold ``k`` vectors together."""
        far = np.where(self.sizes > 0, self.gaps(points)[0] + self.most, np.inf)
        order = np.argsort(far, axis=1, kind="stable")
        enough = np.cumsum(self.sizes[order], axis=1) < k
        stop = np.minimum(enough.sum(axis=1) + 1, (self.sizes > 0).sum())
        return [row[:n].astype(np.int32) for row, n in zip(order, stop, strict=True)]

    def others(self, points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Which cells may hold a vector within each point's bound."""
        gaps, off = self.gaps(points)
        home = gaps.argmin(axis=1)
        between = self.apart[home]
        planes = gaps**2 - gaps[np.arange(len(gaps)), home][:, None] ** 2 - 2 * off[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            planes = np.where(between > 0, planes / (2 * between), -np.inf)
        closest = np.maximum(np.maximum(gaps - self.most, self.least - gaps), -np.inf)
        closest = np.maximum(closest - 4 * np.sqrt(off)[:, None], planes)
        return (closest <= (bounds * (1 + 1e-9))[:, None]) & (self.sizes > 0)


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _lists(cells: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(c) for c in cells])]).astype(np.int32)
    flat = np.concatenate(cells).astype(np.int32) if cells else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def pick_pivots(bank: DataFrame, n: int, dim: int) -> np.ndarray:
    """At most ``n`` different vectors of the bank, those whose ids have the smallest hashes."""
    drawn = bank.select("_b", "_v").orderBy(F.xxhash64("_b"), "_b").limit(n).select("_v").toArrow()
    points = _matrix(drawn["_v"].combine_chunks(), dim)
    return points[np.sort(np.unique(points, axis=0, return_index=True)[1])]


def pivot_neighbors(
    queries: DataFrame,
    bank: DataFrame,
    k: int,
    *,
    query_id: str = "val_id",
    bank_id: str = "vec_id",
    vector: str = "embedding",
    pivots: int | None = None,
    cell_rows: int | None = None,
    dim: int | None = None,
) -> Found:
    """Exact ``k`` nearest bank vectors of every query vector by distance; equal ones rank by bank id.

    Ids must be unique. Vectors that are null, of another width or not finite are left out on both sides. ``pivots`` is the
    square root of the bank's size unless given, at most ``MAX_PIVOTS`` and ``PIVOT_BYTES`` of vectors.
    """
    require_positive(k=k, pivots=pivots, cell_rows=cell_rows, dim=dim)
    require_columns(queries, [query_id, vector], "query vectors")
    require_columns(bank, [bank_id, vector], "bank vectors")
    spark, dim = queries.sparkSession, dim or vector_width(bank, vector)
    valid = is_valid_vector(F.col(vector), dim)
    left = queries.filter(valid).select(F.col(query_id).alias("_q"), F.col(vector).cast("array<double>").alias("_v"))
    right = bank.filter(valid).select(F.col(bank_id).alias("_b"), F.col(vector).cast("array<double>").alias("_v"))
    schema = T.StructType([left.schema["_q"], right.schema["_b"], T.StructField("_score", T.DoubleType())])
    out = [F.col("_q").alias(query_id), F.col("_b").alias(bank_id), F.col("_score").alias("score"), F.col("rank").cast("bigint")]
    left_rows, right_rows = left.count(), right.count()
    if not left_rows or not right_rows:
        return Found(best_ranked(spark.createDataFrame([], schema), k, "l2").select(*out), 0, 0)
    bound = max(1, min(MAX_PIVOTS, PIVOT_BYTES // (8 * dim)))
    cells = Cells(pick_pivots(right, min(bound, pivots or math.isqrt(right_rows - 1) + 1), dim))
    rows = cell_rows or rows_per_cell(left_rows, right_rows, dim, spark.sparkContext.defaultParallelism)
    step = max(1, SLICE_ENTRIES // max(dim, len(cells.pivots)))

    @F.arrow_udf("_cell int, _gap double")
    def cell_of(vectors: pa.Array) -> pa.Array:
        near, gap = [np.zeros(0, np.int32)], [np.zeros(0)]
        for start in range(0, len(vectors), step):
            gaps = cells.gaps(_matrix(vectors.slice(start, step), dim))[0]
            near.append(gaps.argmin(axis=1).astype(np.int32))
            gap.append(gaps.min(axis=1))
        return pa.StructArray.from_arrays([pa.array(np.concatenate(near)), pa.array(np.concatenate(gap))], ["_cell", "_gap"])

    right = staged(right.withColumn("_at", cell_of("_v")).select("_b", "_v", "_at.*"), "pivot_cells")
    per_cell = right.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"), F.min("_gap").alias("least"), F.max("_gap").alias("most"))
    cells = cells.with_bank(per_cell.collect())  # a row per pivot

    @F.arrow_udf("array<int>")
    def first(vectors: pa.Array) -> pa.Array:
        found: list[np.ndarray] = []
        for start in range(0, len(vectors), step):
            found += cells.first(_matrix(vectors.slice(start, step), dim), k)
        return _lists(found)

    @F.arrow_udf("array<int>")
    def others(vectors: pa.Array, bounds: pa.Array) -> pa.Array:
        found: list[np.ndarray] = []
        bounds = bounds.fill_null(math.inf).to_numpy(zero_copy_only=False)
        for start in range(0, len(vectors), step):
            may = cells.others(_matrix(vectors.slice(start, step), dim), bounds[start : start + step])
            found += [np.flatnonzero(row).astype(np.int32) for row in may]
        return _lists(found)

    search = cell_search(k, dim, "l2", ["_q"], ["_b"])

    def visit(visitors: DataFrame) -> tuple[DataFrame, int]:
        """Search the cells listed in ``_cells``; candidates, and the pairs that were compared."""
        visits = visitors.select(F.explode("_cells").alias("_cell")).groupBy("_cell").count().collect()  # a row per pivot
        blocks = [
            (r["_cell"], math.ceil(r["count"] / rows), math.ceil(int(cells.sizes[r["_cell"]]) / rows)) for r in visits
        ]
        lookup = F.broadcast(spark.createDataFrame(blocks, "_cell int, _lbs int, _rbs int"))  # at most MAX_PIVOTS rows

        def dealt(side: DataFrame, key: str, own: str, other: str) -> DataFrame:
            met = side.join(lookup, "_cell").withColumn(own, F.pmod(F.xxhash64(key), F.col(f"{own}s")).cast("int"))
            return met.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))).select(key, "_v", "_cell", "_lb", "_rb")

        a = dealt(visitors.select("_q", "_v", F.explode("_cells").alias("_cell")), "_q", "_lb", "_rb")
        b = dealt(right.select("_b", "_v", "_cell"), "_b", "_rb", "_lb")
        keys = ["_cell", "_lb", "_rb"]
        found = a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInArrow(search, schema)
        return found, sum(r["count"] * int(cells.sizes[r["_cell"]]) for r in visits)

    left = staged(left.withColumn("_cells", first("_v")), "pivot_queries")
    found, compared = visit(left)
    near = staged(best_ranked(found, k, "l2"), "pivot_found")
    bounds = near.filter(F.col("rank") == k).select(F.col("_q"), F.col("_score").alias("_bound"))
    wider = left.join(bounds, "_q", "left").withColumn("_cells", F.array_except(others("_v", "_bound"), "_cells"))
    wider = staged(wider.filter(F.size("_cells") > 0).select("_q", "_v", "_cells"), "pivot_visits")
    more, further = visit(wider)
    best = best_ranked(near.drop("rank").unionByName(more), k, "l2")
    return Found(best.select(*out), compared + further, left_rows * right_rows)
