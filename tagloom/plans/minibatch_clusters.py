"""k-means by mini-batches: one pass over shards, a table, or files as they arrive.

A mini-batch moves every centre to the mean of all vectors it was ever given: ``centre += (sum - n * centre) / count``. A
batch of any size is assigned where its rows lie, against the broadcast centres; only sums per centre are shuffled, and
the driver holds the centres and their counts, which are the model. Centres that get far fewer vectors than the largest
one are put on random vectors of the batch now and then.

The state after a batch is saved under the number of the batch before the next one starts. A batch that is run again
after a crash starts from the state before it, so nothing is counted twice. The same batches give the same state, up to
rounding, however their rows are partitioned. Vectors that are missing, of another width or not finite are left out.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tagloom.checks import require_columns, require_positive
from tagloom.functions.vectors import is_valid_vector
from tagloom.operators.neighbors import assign_nearest_centroid, vector_width
from tagloom.operators.sizing import staging_path
from tagloom.sources import paths

#: Rows that first centres are drawn from; the only rows that reach the driver.
INIT_ROWS = 100_000
#: A centre with fewer vectors than this share of the largest one's is starved.
STARVED = 0.01


@dataclass(frozen=True)
class State:
    """Centres, how many vectors each stands for, and how many batches and vectors were seen."""

    centers: np.ndarray
    counts: np.ndarray
    batches: int = 0
    vectors: int = 0
    since_reseeded: int = 0

    def table(self, spark: SparkSession, cluster: str = "cluster_id") -> DataFrame:
        """``cluster``, ``center`` and ``n``."""
        rows = [(i, c, int(n)) for i, (c, n) in enumerate(zip(self.centers.tolist(), self.counts, strict=True))]
        return spark.createDataFrame(rows, f"`{cluster}` bigint, center array<double>, n bigint")


def _sample(rows: DataFrame, vector: str, n: int, seed: int) -> np.ndarray:
    """``n`` vectors, chosen and ordered by a seeded hash of their values."""
    drawn = rows.select(vector).orderBy(F.xxhash64(F.lit(seed), vector), vector).limit(n)
    points = drawn.toArrow()[vector].combine_chunks()
    return points.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(points), -1)


def spread_centers(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` of the points, each drawn with a chance that grows with its squared distance to those before it."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.integers(len(points)))]
    gaps = ((points - points[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k:
        total = gaps.sum()
        if total == 0:
            raise ValueError(f"{k} clusters need as many different vectors; the first batch has {len(chosen)}")
        place = int(np.searchsorted(np.cumsum(gaps), rng.random() * total, side="right"))
        place = min(place, len(points) - 1)
        while gaps[place] == 0:  # rounding may end on a point that is taken already
            place -= 1
        chosen.append(place)
        gaps = np.minimum(gaps, ((points - points[place]) ** 2).sum(axis=1))
    return points[chosen]


def start(
    rows: DataFrame, vector: str, n_clusters: int, *, seed: int = 42, init_rows: int = INIT_ROWS, dim: int | None = None
) -> State:
    """First centres, drawn from ``init_rows`` valid vectors of ``rows``."""
    valid = rows.filter(is_valid_vector(F.col(vector), dim or vector_width(rows, vector)))
    points = _sample(valid, vector, init_rows, seed)
    if len(points) < n_clusters:
        raise ValueError(f"{n_clusters} clusters need as many vectors; the first batch has {len(points)}")
    return State(spread_centers(points, n_clusters, seed), np.zeros(n_clusters, np.int64))


SUMS = "cluster_id bigint, n bigint, total array<double>"
_FIELDS = pa.schema([("cluster_id", pa.int64()), ("n", pa.int64()), ("total", pa.list_(pa.float64()))])


def _sums(assigned: DataFrame, vector: str, clusters: int, dim: int) -> DataFrame:
    """Number and sum of the vectors of each cluster: one row per cluster and task, then one per cluster."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((clusters, dim)), np.zeros(clusters, np.int64)
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            points = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(own), dim)
            order = np.argsort(own, kind="stable")
            found, first, size = np.unique(own[order], return_index=True, return_counts=True)
            if len(found):
                total[found] += np.add.reduceat(points[order], first, axis=0)
                n[found] += size
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n[seen]), pa.array(total[seen].tolist(), pa.list_(pa.float64()))], schema=_FIELDS)

    def merge(rows: pa.Table) -> pa.Table:
        total = np.array(rows["total"].to_pylist()).sum(axis=0)
        return pa.table([rows["cluster_id"][:1], pa.array([sum(rows["n"].to_pylist())]), pa.array([total.tolist()])], schema=_FIELDS)

    return assigned.select("cluster_id", vector).mapInArrow(per_task, SUMS).groupBy("cluster_id").applyInArrow(merge, SUMS)


def partial_fit(state: State, rows: DataFrame, vector: str = "pca", *, seed: int = 42, starved: float = STARVED) -> State:
    """The state after one more batch of rows."""
    spark, (clusters, dim) = rows.sparkSession, state.centers.shape
    valid = rows.filter(is_valid_vector(F.col(vector), dim)).select(F.col(vector).cast("array<double>").alias(vector))
    assigned = assign_nearest_centroid(valid, state.table(spark), vector=vector)
    found = _sums(assigned, vector, clusters, dim).toArrow()  # at most a row per centre
    at = found["cluster_id"].to_numpy()
    n, total = np.zeros(clusters, np.int64), np.zeros((clusters, dim))
    n[at], total[at] = found["n"].to_numpy(), np.array(found["total"].to_pylist()).reshape(len(at), dim)
    counts, centers = state.counts + n, state.centers.copy()
    moved = n > 0
    centers[moved] += (total[moved] - n[moved, None] * centers[moved]) / counts[moved, None]
    since = state.since_reseeded + int(n.sum())
    poor = np.flatnonzero(counts < starved * counts.max())
    if len(poor) and since >= 10 * clusters:
        fresh = _sample(valid, vector, len(poor), seed + state.batches + 1)
        poor = poor[: len(fresh)]
        rest = np.delete(counts, poor)
        centers[poor], counts[poor], since = fresh, rest.min() if len(rest) else 0, 0
    return State(centers, counts, state.batches + 1, state.vectors + int(n.sum()), since)


STATE = "cluster_id int, center array<double>, n bigint, batches bigint, vectors bigint, since bigint"


def save_state(spark: SparkSession, state: State, path: str, number: int) -> None:
    """The state after batch ``number``, as one folder that Spark's committer makes whole or leaves without its mark."""
    rows = [
        (i, c, int(n), state.batches, state.vectors, state.since_reseeded)
        for i, (c, n) in enumerate(zip(state.centers.tolist(), state.counts, strict=True))
    ]
    spark.createDataFrame(rows, STATE).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch-{number:012d}")


def _saved(spark: SparkSession, path: str) -> list[int]:
    names = (re.fullmatch(r"batch-(\d{12})", n) for n in paths.names(spark, path))
    numbers = sorted(int(m[1]) for m in names if m)
    return [n for n in numbers if paths.exists(spark, f"{path}/batch-{n:012d}/_SUCCESS")]


def load_state(spark: SparkSession, path: str, before: int | None = None) -> State | None:
    """The last saved state, or the last before batch ``before``; None where there is none."""
    numbers = [n for n in _saved(spark, path) if before is None or n < before]
    if not numbers:
        return None
    rows = spark.read.schema(STATE).parquet(f"{path}/batch-{numbers[-1]:012d}").orderBy("cluster_id").collect()  # a row per centre
    first = rows[0]
    return State(np.array([r["center"] for r in rows]), np.array([r["n"] for r in rows]), first["batches"], first["vectors"], first["since"])


def fit_batches(
    rows: DataFrame,
    vector: str = "pca",
    *,
    n_clusters: int = 200,
    batch_rows: int = 1_000_000,
    passes: int = 1,
    seed: int = 42,
    init_rows: int = INIT_ROWS,
    starved: float = STARVED,
    dim: int | None = None,
) -> State:
    """Fit a stored table: rows are dealt to mini-batches by a seeded hash of their vectors, and each is seen ``passes`` times.

    Copies of a vector meet in one mini-batch, which is spread over tasks like any other.
    """
    require_positive(n_clusters=n_clusters, batch_rows=batch_rows, passes=passes, init_rows=init_rows)
    require_columns(rows, [vector], "vectors")
    spark, dim = rows.sparkSession, dim or vector_width(rows, vector)
    valid = rows.filter(is_valid_vector(F.col(vector), dim)).select(F.col(vector).cast("array<double>").alias(vector))
    batches = max(1, math.ceil(valid.count() / batch_rows))
    folder = staging_path(spark, "vector_batches")
    part = F.pmod(F.xxhash64(F.lit(seed), vector), F.lit(batches)).cast("int")
    valid.withColumn("part", part).write.partitionBy("part").parquet(folder)
    state = start(spark.read.parquet(folder), vector, n_clusters, seed=seed, init_rows=init_rows, dim=dim)
    for _ in range(passes):
        for number in range(batches):
            state = partial_fit(state, spark.read.parquet(folder).filter(F.col("part") == number), vector, seed=seed, starved=starved)
    paths.remove(spark, folder)
    return state


def fit_arriving(
    stream: DataFrame,
    model_path: str,
    checkpoint_path: str,
    vector: str = "pca",
    *,
    dim: int | None = None,
    n_clusters: int = 200,
    seed: int = 42,
    init_rows: int = INIT_ROWS,
    starved: float = STARVED,
    once: bool = True,
) -> StreamingQuery:
    """Fit the vectors of a stream, a state per micro-batch under ``model_path``; ``once`` stops after the files present now.

    The first batch with a valid vector settles the width, where ``dim`` doesn't, and the first centres. A restarted
    query goes on where it stopped.
    """
    require_positive(n_clusters=n_clusters, init_rows=init_rows)
    require_columns(stream, [vector], "stream")

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        state = load_state(spark, model_path, before=number)
        if state is None:
            width = dim or vector_width(batch, vector)
            if width == 0:
                return
            state = start(batch, vector, n_clusters, seed=seed, init_rows=init_rows, dim=width)
        save_state(spark, partial_fit(state, batch, vector, seed=seed, starved=starved), model_path, number)
        for old in _saved(spark, model_path)[:-2]:
            paths.remove(spark, f"{model_path}/batch-{old:012d}")

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint_path)
    return (writer.trigger(availableNow=True) if once else writer).start()
