"""Nearest neighbours, nearest centroids and pairwise losses over vectors.

Comparing two sets of vectors costs |left| x |right| whatever the engine. The work is cut into cells of a
bounded number of rows per side; a cell is one matrix product in one task and emits only what its rows keep
(k candidates or one partial sum each), never the pairs themselves.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.checks import require_choice, require_columns, require_positive
from tagloom.functions.vectors import is_valid_vector
from tagloom.operators.metrics import classification_metrics
from tagloom.operators.sizing import lookup_join, small_or_whole, small_rows, staged

# A task holds about ten arrays the size of a cell's side or of a slice, so both stay far below a worker's memory.
CELL_BYTES = 16 * 2**20
MIN_CELL_ROWS = 4096
SLICE_ENTRIES = 2**20
CENTROID_BYTES = 64 * 2**20
ROUNDING = 16 * np.finfo(np.float64).eps


def vector_width(df: DataFrame, column: str) -> int:
    """Width that most non-empty vectors have, the smaller one on ties; 0 when there is none."""
    widths = df.filter(F.size(column) > 0).groupBy(F.size(column).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return widths.agg(F.max(F.struct("n", (-F.col("w")).alias("w"))).alias("m")).select(F.coalesce(-F.col("m.w"), F.lit(0))).first()[0]


def rows_per_cell(left_rows: int, right_rows: int, dim: int, cores: int) -> int:
    """Side length of a cell: a few cells per core, within the memory limit; larger cells mean fewer copies."""
    balanced = math.ceil(math.sqrt(left_rows * right_rows / (4 * max(cores, 1))))
    return max(1, min(max(MIN_CELL_ROWS, balanced), CELL_BYTES // (8 * max(dim, 1))))


def nearest_neighbors(
    queries: DataFrame,
    bank: DataFrame,
    k: int,
    *,
    query_id: str = "val_id",
    bank_id: str = "vec_id",
    vector: str = "embedding",
    distance: str = "cos",
    carry_query: dict[str, str] | None = None,
    carry_bank: dict[str, str] | None = None,
    cell_rows: int | None = None,
) -> DataFrame:
    """Exact ``k`` nearest bank vectors of every query vector: (query id, bank id, score, rank).

    ``cos`` ranks by inner product, largest first, and expects unit vectors; ``l2`` by distance, smallest
    first. Equal scores rank by bank id. A bank smaller than ``k`` is used whole. ``carry_query`` and
    ``carry_bank`` name further columns to keep and what to call them, which saves joining them back.
    """
    require_positive(k=k)
    require_choice(distance, ["cos", "l2"], "distance")
    carry_query, carry_bank = carry_query or {}, carry_bank or {}
    require_columns(queries, [query_id, vector, *carry_query], "query vectors")
    require_columns(bank, [bank_id, vector, *carry_bank], "bank vectors")
    dim = vector_width(bank, vector)
    left = _vectors(queries, vector, dim, {query_id: "_q", **carry_query})
    right = _vectors(bank, vector, dim, {bank_id: "_b", **carry_bank})
    query_fields, bank_fields = left.drop("_v").schema.fields, right.drop("_v").schema.fields
    query_names, bank_names = [f.name for f in query_fields], [f.name for f in bank_fields]
    schema = T.StructType([*query_fields, *bank_fields, T.StructField("_score", T.DoubleType())])
    left_rows, right_rows = left.count(), right.count()
    cores = queries.sparkSession.sparkContext.defaultParallelism
    rows = cell_rows or rows_per_cell(left_rows, right_rows, dim, cores)
    left_blocks = max(1, math.ceil(left_rows / rows))
    right_blocks = max(1, math.ceil(right_rows / rows))
    left = _in_cells(left, "_q", "_lb", left_blocks, "_rb", right_blocks)
    right = _in_cells(right, "_b", "_rb", right_blocks, "_lb", left_blocks)

    best_in_cell = cell_search(k, dim, distance, query_names, bank_names)
    candidates = left.groupBy("_lb", "_rb").cogroup(right.groupBy("_lb", "_rb")).applyInArrow(best_in_cell, schema)
    return best_ranked(candidates, k, distance).select(
        F.col("_q").alias(query_id),
        F.col("_b").alias(bank_id),
        F.col("_score").alias("score"),
        F.col("rank").cast("bigint"),
        *carry_query.values(),
        *carry_bank.values(),
    )


def best_ranked(candidates: DataFrame, k: int, distance: str) -> DataFrame:
    """The ``k`` best candidates of each query with their ranks, equal scores by bank id."""
    by_score = F.col("_score").desc() if distance == "cos" else F.col("_score").asc()
    window = Window.partitionBy("_q").orderBy(by_score, F.col("_b").asc())
    return candidates.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def cell_search(k: int, dim: int, distance: str, query_names: list[str], bank_names: list[str]):
    """A function of the two tables of a cell: the ``k`` best bank rows of each query in it, with their scores."""

    def best_in_cell(queries_table: pa.Table, bank_table: pa.Table) -> pa.Table:
        def matrix(table):
            flat = pc.list_flatten(table["_v"]).to_numpy()
            return np.ascontiguousarray(flat, dtype=np.float64).reshape(table.num_rows, dim)

        def answer(picked_queries, picked_bank, scores):
            columns = {n: queries_table[n].take(pa.array(picked_queries, pa.int64())) for n in query_names}
            columns |= {n: bank_table[n].take(pa.array(picked_bank, pa.int64())) for n in bank_names}
            return pa.table({**columns, "_score": pa.array(scores, pa.float64())})

        if queries_table.num_rows == 0 or bank_table.num_rows == 0:
            return answer([], [], [])
        def distinct(vectors):
            """First place of each distinct vector, and for each row which of them it is."""
            whole = vectors.view(np.dtype((np.void, vectors.itemsize * dim))).ravel()
            _, first, which = np.unique(whole, return_index=True, return_inverse=True)
            return first, which

        # Copies are compared once. Of equal bank vectors only the k with the smallest ids can be chosen.
        a, b = matrix(queries_table), matrix(bank_table)
        first, which = distinct(a)
        a = a[first]
        order = pc.sort_indices(bank_table["_b"]).to_numpy()
        _, group = distinct(b[order])
        by_group = np.argsort(group, kind="stable")
        sizes = np.bincount(group)
        place = np.empty(len(group), dtype=np.int64)
        place[by_group] = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        order = order[place < k]
        b = b[order]

        keep = min(k, len(b))
        chosen, scores = [], []
        for part, near in _near_pairs(a, b, keep, distance):
            # The matrix product only narrows the choice; kept pairs are scored one by one, so that
            # copies of a vector score alike whatever cell they fall into.
            row, column = near
            score = _pair_scores(part, b, row, column, distance)
            ranked = np.lexsort((column, -score if distance == "cos" else score, row))
            first_of_row = np.searchsorted(row[ranked], np.arange(len(part)))
            best = ranked[first_of_row[:, None] + np.arange(keep)]
            chosen.append(order[column[best]])
            scores.append(score[best])
        chosen, scores = np.concatenate(chosen), np.concatenate(scores)
        picked = np.repeat(np.arange(len(which)), keep)
        return answer(picked, chosen[which].ravel(), scores[which].ravel())

    return best_in_cell


def _near_pairs(a: np.ndarray, b: np.ndarray, keep: int, distance: str):
    """Slices of ``a`` with all pairs that may belong to the ``keep`` best of their row.

    Closeness comes from a matrix product; what it may be off by is in proportion to the norms, so vectors of any
    scale are told apart alike.
    """
    half_norms = (b * b).sum(axis=1) / 2
    reach = np.sqrt(2 * half_norms.max())
    step = max(1, SLICE_ENTRIES // len(b))
    for start in range(0, len(a), step):
        part = a[start : start + step]
        closeness = part @ b.T
        off = np.sqrt((part * part).sum(axis=1)) * reach
        if distance == "l2":
            closeness -= half_norms
            off += reach * reach
        least = np.partition(closeness, len(b) - keep, axis=1)[:, len(b) - keep]
        least -= 2 * ROUNDING * (b.shape[1] + 2) * off
        yield part, np.nonzero(closeness >= least[:, None])


def _pair_scores(a: np.ndarray, b: np.ndarray, row: np.ndarray, column: np.ndarray, distance: str) -> np.ndarray:
    """Scores of pairs, a bounded number of them at a time."""
    score = np.empty(len(row))
    step = max(1, SLICE_ENTRIES // max(1, b.shape[1]))
    for start in range(0, len(row), step):
        some = slice(start, start + step)
        left, right = a[row[some]], b[column[some]]
        score[some] = (left * right).sum(axis=1) if distance == "cos" else np.sqrt(((left - right) ** 2).sum(axis=1))
    return score


def _vectors(df: DataFrame, vector: str, dim: int, names: dict[str, str]) -> DataFrame:
    valid = df.filter(is_valid_vector(F.col(vector), dim))
    return valid.select(*[F.col(c).alias(name) for c, name in names.items()], F.col(vector).alias("_v"))


def _in_cells(df: DataFrame, key: str, own: str, own_blocks: int, other: str, other_blocks: int) -> DataFrame:
    """Give each row a block of its own side and a copy per block of the other side."""
    blocks = F.sequence(F.lit(0), F.lit(other_blocks - 1))
    return df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(own_blocks)).cast("int")).withColumn(other, F.explode(blocks))


def neighbor_labels(
    queries: DataFrame,
    bank: DataFrame,
    k: int,
    *,
    query_id: str = "val_id",
    bank_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    distance: str = "cos",
    cell_rows: int | None = None,
) -> DataFrame:
    """Neighbours with their labels and the label of the query: the input of the two scores below."""
    return nearest_neighbors(
        queries,
        bank,
        k,
        query_id=query_id,
        bank_id=bank_id,
        vector=vector,
        distance=distance,
        carry_query={label: "query_label"},
        carry_bank={label: "bank_label"},
        cell_rows=cell_rows,
    )


def recall_at_k(neighbors: DataFrame, ks: list[int], query_id: str = "val_id") -> DataFrame:
    """Share of queries with a neighbour of their own label among the first K, one row per K; 0 for no neighbours."""
    match = F.when(F.col("bank_label") == F.col("query_label"), F.col("rank"))
    first = neighbors.groupBy(query_id).agg(F.min(match).alias("first"))
    hits = first.agg(*[F.avg(F.coalesce((F.col("first") <= k).cast("double"), F.lit(0.0))).alias(f"r{k}") for k in ks])
    rows = F.array(*[F.struct(F.lit(k).cast("bigint").alias("k"), F.coalesce(F.col(f"r{k}"), F.lit(0.0)).alias("recall")) for k in ks])
    return hits.select(F.explode(rows).alias("r")).select("r.*")


def knn_votes(neighbors: DataFrame, k: int, query_id: str = "val_id") -> DataFrame:
    """Majority label of the first ``k`` neighbours of each query, the smallest label on ties."""
    votes = neighbors.filter(F.col("rank") <= k).groupBy(query_id, "query_label", "bank_label").agg(F.count(F.lit(1)).alias("n"))
    return votes.groupBy(query_id, "query_label").agg(
        F.max_by("bank_label", F.struct(F.col("n"), -F.col("bank_label"))).alias("pred")
    )


def knn_macro_f1(neighbors: DataFrame, k: int, query_id: str = "val_id") -> DataFrame:
    """Macro F1 of the neighbour vote; 0 for no neighbours."""
    metrics = classification_metrics(knn_votes(neighbors, k, query_id), "query_label", "pred")
    return metrics.select(F.col("f1").alias("knn_macro_f1"))


def last_batches(bank: DataFrame, n: int | None, batch: str = "batch_id") -> DataFrame:
    """Rows of the ``n`` highest batch ids; everything when ``n`` is None or not positive."""
    if n is None or n <= 0:
        return bank
    recent = bank.select(batch).distinct().orderBy(F.col(batch).desc()).limit(n)
    return bank.join(small_or_whole(recent), batch, "left_semi")


def assign_nearest_centroid(
    rows: DataFrame,
    centroids: DataFrame,
    *,
    key: str | None = None,
    vector: str = "pca",
    cluster: str = "cluster_id",
    center: str = "center",
    centroid_bytes: int = CENTROID_BYTES,
) -> DataFrame:
    """Rows with the id of the closest centroid, -1 for a vector that is missing or of another width.

    Equally distant centroids go to the smaller id, however the work is done: a centroid table within
    ``centroid_bytes`` is broadcast and rows never move; a larger one is compared cell by cell, by ``key`` where it is
    given and unique, else by a row number that is written down first.
    """
    require_columns(rows, [vector], "rows to assign")
    require_columns(centroids, [cluster, center], "centroids")
    dim = vector_width(centroids, center)
    valid = is_valid_vector(F.col(vector), dim)
    usable = centroids.filter(is_valid_vector(F.col(center), dim)).select(cluster, center)
    limit = max(1, centroid_bytes // (8 * max(dim, 1)))
    table = small_rows(usable, limit)
    rows = rows.drop(cluster)
    if table is not None:
        nearest = _nearest_of(rows.sparkSession, table, cluster, center, dim)
        return rows.withColumn(cluster, F.coalesce(nearest(F.when(valid, F.col(vector))), F.lit(-1)))
    columns = rows.columns
    if key is None:
        key = "_row"
        rows = staged(rows.withColumn(key, F.monotonically_increasing_id()), "numbered")
    near = nearest_neighbors(
        rows.filter(valid).select(key, vector),
        usable.select(F.col(cluster), F.col(center).alias(vector)),
        1,
        query_id=key,
        bank_id=cluster,
        vector=vector,
        distance="l2",
    )
    joined = rows.join(near.select(key, cluster), key, "left").select(*columns, cluster)
    return joined.withColumn(cluster, F.coalesce(F.col(cluster), F.lit(-1)))


def _nearest_of(spark: SparkSession, table: pa.Table, cluster: str, center: str, dim: int):
    table = table.sort_by(cluster)
    centers = np.array(table[center].to_pylist(), dtype=np.float64).reshape(table.num_rows, dim)
    shared = spark.sparkContext.broadcast((table[cluster].to_numpy().astype(np.int64), centers))

    @F.arrow_udf("bigint")
    def nearest(vectors: pa.Array) -> pa.Array:
        ids, centers = shared.value
        out = np.full(len(vectors), -1, dtype=np.int64)
        present = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        points = flat.reshape(len(present), dim)
        if len(ids) and len(present):
            done = 0
            for part, (row, column) in _near_pairs(points, centers, 1, "l2"):
                ranked = np.lexsort((column, _pair_scores(part, centers, row, column, "l2"), row))
                first = np.searchsorted(row[ranked], np.arange(len(part)))
                out[present[done : done + len(part)]] = ids[column[ranked[first]]]
                done += len(part)
        return pa.array(out)

    return nearest


def contrastive_loss(
    rows: DataFrame,
    *,
    batch: str = "batch_id",
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    mask: str = "mask",
    temperature: float = 0.1,
    cell_rows: int | None = None,
) -> DataFrame:
    """Supervised contrastive loss of every batch over its rows with a positive mask.

    For each row with at least one other row of its label: the log of its positives' share in all its
    exponentiated similarities; summed over the batch and divided by the number of positive pairs. 0 for a
    batch without positive pairs. A batch of any size is cut into cells; small batches share them.
    """
    tau = max(temperature, 1e-8)
    dim = vector_width(rows, vector)
    kept = rows.filter(F.col(mask) > 0).filter(is_valid_vector(F.col(vector), dim))
    kept = kept.select(
        F.col(batch).alias("_batch"), F.col(key).alias("_id"), F.col(vector).alias("_v"), F.col(label).alias("_label")
    )
    sizes = kept.groupBy("_batch").agg(F.count(F.lit(1)).alias("_rows"))
    total, largest = (n or 0 for n in sizes.agg(F.sum("_rows"), F.max("_rows")).first())
    cores = rows.sparkSession.sparkContext.defaultParallelism
    side = cell_rows or rows_per_cell(largest, largest, dim, cores)
    packs = max(1, math.ceil(total / min(side, cell_rows or MIN_CELL_ROWS)))
    blocks = F.ceil(F.col("_rows") / F.lit(side)).cast("int")
    pack = F.pmod(F.xxhash64("_batch"), F.lit(packs)).alias("_pack")
    placed = None if largest <= side else lookup_join(kept, sizes, "_batch", "inner", "batch sizes").select(
        "_batch", "_id", "_v", "_label",
        pack,
        F.pmod(F.xxhash64("_id"), blocks).alias("_own"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("_other"),
    )
    schema = T.StructType(
        [
            T.StructField("_batch", rows.schema[batch].dataType),
            T.StructField("_id", rows.schema[key].dataType),
            T.StructField("_positive", T.DoubleType()),
            T.StructField("_all", T.DoubleType()),
            T.StructField("_pairs", T.LongType()),
        ]
    )

    def cell_sums(left: pa.Table, right: pa.Table) -> pa.Table:
        def matrix(table):
            flat = pc.list_flatten(table["_v"]).to_numpy()
            return np.ascontiguousarray(flat, dtype=np.float64).reshape(table.num_rows, dim)

        def rows_by(values):
            places = {}
            for place, value in enumerate(values.to_pylist()):
                places.setdefault(value, []).append(place)
            return places

        a, b = matrix(left), matrix(right)
        a_ids, b_ids = left["_id"].to_numpy(), right["_id"].to_numpy()
        a_labels, b_labels = left["_label"].to_numpy(), right["_label"].to_numpy()
        positive, whole, pairs = (np.zeros(len(a)) for _ in range(3))
        right_rows = rows_by(right["_batch"])
        for value, mine in rows_by(left["_batch"]).items():
            theirs = right_rows.get(value, [])
            step = max(1, SLICE_ENTRIES // max(1, len(theirs)))
            for start in range(0, len(mine), step):
                part = mine[start : start + step]
                other = a_ids[part][:, None] != b_ids[theirs][None, :]
                same = other & (a_labels[part][:, None] == b_labels[theirs][None, :])
                weight = np.exp(a[part] @ b[theirs].T / tau) * other
                positive[part] = (weight * same).sum(axis=1)
                whole[part] = weight.sum(axis=1)
                pairs[part] = same.sum(axis=1)
        return pa.table(
            {
                "_batch": left["_batch"],
                "_id": left["_id"],
                "_positive": pa.array(positive),
                "_all": pa.array(whole),
                "_pairs": pa.array(pairs.astype(np.int64)),
            }
        )

    if placed is None:  # every batch fits one cell, so its rows meet after a single shuffle
        packed = kept.withColumn("_pack", pack).groupBy("_pack")
        partial = packed.applyInArrow(lambda cell: cell_sums(cell, cell), schema)
    else:
        turned = {"_own": "_other", "_other": "_own"}
        others = placed.select(*[F.col(turned.get(c, c)).alias(c) for c in placed.columns])
        sides = [rows_of.groupBy("_pack", "_own", "_other") for rows_of in (placed, others)]
        partial = sides[0].cogroup(sides[1]).applyInArrow(cell_sums, schema)
    per_row = partial.groupBy("_batch", "_id").agg(F.sum("_positive").alias("p"), F.sum("_all").alias("a"), F.sum("_pairs").alias("n"))
    log_share = F.log((F.col("p") + 1e-12) / (F.col("a") + 1e-12))
    per_batch = per_row.groupBy("_batch").agg(
        (-F.sum(F.when(F.col("n") > 0, log_share)) / F.nullif(F.sum("n"), F.lit(0))).alias("metric_loss")
    )
    batches = rows.select(F.col(batch)).distinct()
    joined = batches.join(per_batch, F.col(batch) == F.col("_batch"), "left")
    return joined.select(batch, F.coalesce("metric_loss", F.lit(0.0)).alias("metric_loss"))


