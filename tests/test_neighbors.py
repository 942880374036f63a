"""Neighbour search, centroid assignment and the pairwise loss against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.operators import neighbors as ops
from tagloom.plans.evaluate import evaluate_embeddings

RNG = np.random.default_rng(3)


def unit(n, d=8):
    x = RNG.normal(size=(n, d)).astype(np.float32)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


BANK = np.concatenate([unit(60), np.repeat(unit(1), 40, axis=0)])  # forty copies of one vector
VAL = np.concatenate([unit(25), BANK[[70, 71]]])
BANK_LABELS, VAL_LABELS = RNG.integers(0, 3, 100), RNG.integers(0, 3, 27)


def table(spark, vectors, labels, key):
    rows = [(int(i), [float(x) for x in v], int(label)) for i, (v, label) in enumerate(zip(vectors, labels))]
    return spark.createDataFrame(rows, f"{key} bigint, embedding array<float>, label int")


@pytest.fixture(scope="module")
def bank(spark):
    return table(spark, BANK, BANK_LABELS, "vec_id").persist()


@pytest.fixture(scope="module")
def val(spark):
    return table(spark, VAL, VAL_LABELS, "val_id").persist()


def expected(k, distance):
    a, b = VAL.astype(float), BANK.astype(float)
    out = {}
    for i, q in enumerate(a):
        score = np.array([np.sum(q * x) if distance == "cos" else np.sqrt(np.sum((q - x) ** 2)) for x in b])
        order = sorted(range(len(b)), key=lambda j: (-score[j] if distance == "cos" else score[j], j))[:k]
        out[i] = order
    return out


@pytest.mark.parametrize("distance", ["cos", "l2"])
@pytest.mark.parametrize("cell_rows", [None, 7, 1000])
@pytest.mark.parametrize("k", [1, 10, 500])
def test_top_k_is_exact(bank, val, distance, cell_rows, k):
    got = {}
    near = ops.nearest_neighbors(val, bank, k, distance=distance, cell_rows=cell_rows)
    for r in near.orderBy("val_id", "rank").collect():
        got.setdefault(r.val_id, []).append(r.vec_id)
    assert got == expected(k, distance)


def test_invalid_vectors_are_left_out(spark, bank):
    odd = spark.createDataFrame([(1, None), (2, [1.0]), (3, [0.0] * 7 + [None])], "val_id bigint, embedding array<float>")
    assert ops.nearest_neighbors(odd, bank, 3).count() == 0


def test_empty_bank_scores_zero(bank, val):
    near = ops.neighbor_labels(val, bank.limit(0), 10)
    assert {r.k: r.recall for r in ops.recall_at_k(near, [1, 10]).collect()} == {1: 0.0, 10: 0.0}
    assert ops.knn_macro_f1(near, 10).first()[0] == 0.0


def test_recall_and_vote(bank, val):
    near = ops.neighbor_labels(val, bank, 10, cell_rows=16)
    order = expected(10, "cos")
    for row in ops.recall_at_k(near, [1, 3, 10]).collect():
        hits = [any(BANK_LABELS[j] == VAL_LABELS[i] for j in order[i][: row.k]) for i in order]
        assert row.recall == pytest.approx(np.mean(hits))
    for row in ops.knn_votes(near, 4).collect():
        votes = np.bincount(BANK_LABELS[order[row.val_id][:4]], minlength=3)
        assert row.pred == votes.argmax()


def test_vote_tie_takes_smaller_label(spark):
    near = spark.createDataFrame([(1, 1, 2, 9), (1, 2, 1, 9)], "val_id int, rank int, bank_label int, query_label int")
    assert ops.knn_votes(near, 10).first().pred == 1


@pytest.mark.parametrize("n,kept", [(2, {3, 4}), (0, {1, 2, 3, 4}), (None, {1, 2, 3, 4}), (9, {1, 2, 3, 4})])
def test_bank_retention(spark, n, kept):
    bank = spark.createDataFrame([(b, i) for b in (1, 2, 3, 4) for i in range(3)], "batch_id bigint, vec_id int")
    assert {r.batch_id for r in ops.last_batches(bank, n).collect()} == kept


def test_evaluation_job(bank, val):
    masked = bank.withColumns({"batch_id": F.col("vec_id") % 5, "metric_mask": F.lit(1)})
    out = evaluate_embeddings(val.withColumn("metric_mask", F.lit(1)), masked, ks=[1, 5], knn_k=3, keep_batches=2)
    values = {r.name: r.value for r in out.collect()}
    assert set(values) == {"recall_at_1", "recall_at_5", "knn_macro_f1"}
    assert 0 <= values["recall_at_1"] <= values["recall_at_5"] <= 1


@pytest.mark.parametrize("limit", [ops.CENTROID_BYTES, 1])
def test_nearest_centroid(spark, limit):
    points = [[0.0, 0.1], [5.0, 5.0], None, [], [1.0], [1.0, None], [2.5, 2.5]]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(points)], "id bigint, pca array<double>")
    centers = spark.createDataFrame([(3, [5.0, 5.0]), (1, [0.0, 0.0]), (2, [0.0, 0.0])], "cluster_id bigint, center array<float>")
    got = ops.assign_nearest_centroid(rows, centers, key="id", centroid_bytes=limit)
    assert {r.id: r.cluster_id for r in got.collect()} == {0: 1, 1: 3, 2: -1, 3: -1, 4: -1, 5: -1, 6: 1}


@pytest.mark.parametrize("scale", [1e-7, 1.0, 1e7])
def test_nearest_centroid_at_any_scale(spark, scale):
    """Ids depend neither on the scale of the vectors nor on how the work is done."""
    points, centers = RNG.normal(size=(200, 6)), np.repeat(RNG.normal(size=(20, 6)), 2, axis=0)
    want = [int(np.argmin(np.sqrt(((p * scale - centers * scale) ** 2).sum(axis=1)))) for p in points]
    rows = spark.createDataFrame([(i, (p * scale).tolist()) for i, p in enumerate(points)], "id bigint, pca array<double>")
    table = spark.createDataFrame([(i, (c * scale).tolist()) for i, c in enumerate(centers)], "cluster_id bigint, center array<double>")
    for options in ({}, {"centroid_bytes": 1}, {"centroid_bytes": 1, "key": "id"}):
        got = {r.id: r.cluster_id for r in ops.assign_nearest_centroid(rows.repartition(3), table, **options).collect()}
        assert [got[i] for i in range(200)] == want


def test_vectors_that_are_not_finite_are_invalid(spark, bank, val):
    odd = [(901, [float("nan")] * 8, 0), (902, [float("inf")] + [0.0] * 7, 1), (903, [float("-inf")] * 8, 1)]
    more = bank.unionByName(spark.createDataFrame(odd, bank.schema))
    queries = val.unionByName(spark.createDataFrame(odd, val.schema))
    near = ops.nearest_neighbors(queries, more, 5)
    assert near.filter("vec_id > 900 OR val_id > 900").count() == 0 and near.count() == 27 * 5
    centers = bank.limit(3).select(F.col("vec_id").alias("cluster_id"), F.col("embedding").alias("center"))
    got = ops.assign_nearest_centroid(queries, centers, vector="embedding")
    assert {r.val_id for r in got.filter("cluster_id = -1").collect()} == {901, 902, 903}
    batch = more.withColumns({"batch_id": F.lit(0), "mask": F.lit(1.0)})
    assert np.isfinite(ops.contrastive_loss(batch).first().metric_loss)


def test_width_is_the_usual_one(spark):
    rows = spark.createDataFrame([([1.0],), ([1.0, 2.0],), ([3.0, 4.0],), (None,), ([],)], "v array<double>")
    assert ops.vector_width(rows, "v") == 2
    assert ops.vector_width(rows.limit(0), "v") == 0


def loss_by_hand(x, labels, tau):
    s = np.exp(x @ x.T / tau) * (1 - np.eye(len(x)))
    same = (labels[:, None] == labels[None, :]) * (1 - np.eye(len(x)))
    n = same.sum(axis=1)
    logs = np.log(((s * same).sum(axis=1) + 1e-12) / (s.sum(axis=1) + 1e-12))
    return -logs[n > 0].sum() / n[n > 0].sum() if (n > 0).any() else 0.0


@pytest.mark.parametrize("cell_rows", [4096, 9])
def test_contrastive_loss(spark, cell_rows):
    rows = table(spark, BANK, BANK_LABELS, "vec_id").withColumns(
        {"batch_id": F.when(F.col("vec_id") < 50, 0).when(F.col("vec_id") < 98, 1).otherwise(F.col("vec_id")), "mask": F.lit(1.0)}
    )
    got = {r.batch_id: r.metric_loss for r in ops.contrastive_loss(rows, cell_rows=cell_rows).collect()}
    x = BANK.astype(float)
    for batch, part in {0: slice(0, 50), 1: slice(50, 98)}.items():
        assert got[batch] == pytest.approx(loss_by_hand(x[part], BANK_LABELS[part], 0.1))
    assert got[98] == got[99] == 0.0
    masked = rows.withColumn("mask", (F.col("vec_id") < 30).cast("double"))
    got = {r.batch_id: r.metric_loss for r in ops.contrastive_loss(masked, cell_rows=cell_rows).collect()}
    assert got[0] == pytest.approx(loss_by_hand(x[:30], BANK_LABELS[:30], 0.1)) and got[1] == 0.0


def test_cells_and_slices_stay_small_at_any_size():
    for rows in (10**4, 10**6, 10**9):
        assert ops.rows_per_cell(rows, rows, 64, 12) * 64 * 8 <= 16 * 2**20
    assert ops.SLICE_ENTRIES * 8 <= 8 * 2**20
