"""Reduction, clustering, preparation and training."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.operators.neighbors import assign_nearest_centroid
from tagloom.plans import clusters
from tagloom.plans.prepare import prepare
from tagloom.plans.training import train_classifier
from tagloom.sources.models import load_kmeans, load_pipeline, save_model

RNG = np.random.default_rng(0)


@pytest.fixture(scope="module")
def vectors(spark):
    points = RNG.normal(size=(120, 6)) * [5, 3, 2, 1, 1, 1] + [4, 0, 0, 0, 0, 0]
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)] + [(500, None), (501, [1.0])]
    return spark.createDataFrame(rows, "id bigint, cls array<float>").persist()


def test_pca_against_numpy(spark, vectors, tmp_path):
    model = clusters.fit_pca(vectors, n_components=3)
    save_model(model, str(tmp_path / "deep" / "pca"))
    model = load_pipeline(spark, str(tmp_path / "deep" / "pca"))
    reduced = {r.id: r.pca for r in clusters.transform_pca(vectors, model).collect()}
    assert reduced.pop(500) is None and reduced.pop(501) is None
    got = np.array([reduced[i] for i in sorted(reduced)])
    x = np.array([r.cls for r in vectors.filter("id < 500").orderBy("id").collect()])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    x -= x.mean(axis=0)
    axes = np.linalg.svd(x, full_matrices=False)[2][:3]
    axes *= np.sign(axes[np.arange(3), np.abs(axes).argmax(axis=1)])[:, None]
    assert np.allclose(got, x @ axes.T, atol=1e-6)
    assert np.allclose(got.mean(axis=0), 0, atol=1e-9) and (np.diff(got.var(axis=0)) <= 0).all()


def test_pca_needs_data(vectors):
    with pytest.raises(ValueError, match="usable vector"):
        clusters.fit_pca(vectors.limit(0))


def test_clusters_train_and_predict(spark, vectors, tmp_path):
    rows = vectors.withColumnRenamed("cls", "pca").withColumn("cluster_id", F.lit(99))
    model_path, centroids_path = str(tmp_path / "m" / "kmeans"), str(tmp_path / "centroids")
    options = dict(n_clusters=4, max_iter=10)
    trained = clusters.run_clusters(rows, model_path, centroids_path=centroids_path, **options)
    first = {r.id: r.cluster_id for r in trained.collect()}
    assert first[500] == first[501] == -1 and set(first.values()) == {-1, 0, 1, 2, 3}
    again = clusters.run_clusters(rows, model_path, run_mode="predict")
    assert {r.id: r.cluster_id for r in again.collect()} == first
    table = spark.read.parquet(centroids_path)
    assert table.dtypes == [("cluster_id", "bigint"), ("center", "array<float>")]
    from_table = assign_nearest_centroid(rows, table)
    assert {r.id: r.cluster_id for r in from_table.collect()} == first
    model = load_kmeans(spark, model_path)
    points = {r.id: np.array(r.cls) for r in vectors.filter("id < 500").collect()}
    centers = np.array(model.clusterCenters())
    for key, point in points.items():
        gaps = np.linalg.norm(centers - point, axis=1)
        assert gaps[first[key]] <= gaps.min() + 1e-6


def test_cluster_arguments(vectors, tmp_path):
    rows = vectors.withColumnRenamed("cls", "pca")
    with pytest.raises(FileNotFoundError):
        clusters.run_clusters(rows, str(tmp_path / "absent"), run_mode="predict")
    with pytest.raises(ValueError, match="run_mode"):
        clusters.run_clusters(rows, "x", run_mode="both")
    with pytest.raises(ValueError, match="n_clusters"):
        clusters.fit_clusters(rows, n_clusters=1)
    model = clusters.fit_clusters(rows, n_clusters=2, max_iter=3, sample_limit=10, key="id")
    assert model.summary.predictions.count() == 10


@pytest.fixture(scope="module")
def labelled(spark):
    words = {"good": "fine great lovely", "bad": "awful poor sad"}
    rows = [(i, f"{words[c]} text {i % 5}", c) for i, c in enumerate(["good"] * 30 + ["bad"] * 12)]
    return spark.createDataFrame(rows, "id bigint, text string, label string")


def test_prepare(spark, labelled):
    extra = spark.createDataFrame([("other", "odd")], "text string, label string")
    down = prepare(labelled, extra, key="id", balance="down")
    assert {r.label: r.label_id for r in down.dictionary.collect()} == {"bad": 0, "good": 1, "odd": 2}
    assert {r["count"] for r in down.train.groupBy("label").count().collect()} == {12}
    assert prepare(labelled, extra, key="id", balance="up").train.count() == 60
    assert prepare(labelled, extra, key="id").train.count() == 42
    with pytest.raises(ValueError, match="balance"):
        prepare(labelled, extra, key="id", balance="side")
    with pytest.raises(ValueError, match="metric_mask"):
        prepare(labelled, extra, key="id", masked=True)


def test_random_order_survives_a_large_dictionary(spark, labelled, monkeypatch):
    """Whatever join the dictionary takes, rows are put in order after it."""
    from tagloom.operators import sizing

    orders = []
    for limit in (sizing.MAX_LOOKUP_ROWS, 0):
        for name in ("small_rows", "small_table", "small_or_whole", "lookup_join"):
            defaults = list(getattr(sizing, name).__defaults__)
            place = next(i for i, v in enumerate(defaults) if isinstance(v, int) and not isinstance(v, bool))
            defaults[place] = limit
            monkeypatch.setattr(getattr(sizing, name), "__defaults__", tuple(defaults))
        for balance in (None, "up", "down"):
            ready = prepare(labelled.repartition(3), labelled.drop("id"), key="id", balance=balance)
            orders.append([r.id for r in ready.train.collect()])
    assert orders[:3] == orders[3:]
    assert all(o != sorted(o) for o in orders)


def test_vectors_with_nan_take_no_part_in_fits(spark, vectors):
    odd = vectors.unionByName(spark.createDataFrame([(600, [float("nan")] * 6), (601, [float("inf")] + [1.0] * 5)], vectors.schema))
    plain, mixed = clusters.fit_pca(vectors, n_components=2), clusters.fit_pca(odd, n_components=2)
    assert np.allclose(plain.stages[-1].pc.toArray(), mixed.stages[-1].pc.toArray())
    reduced = clusters.transform_pca(odd, mixed)
    assert {r.id for r in reduced.filter("pca IS NULL").collect()} == {500, 501, 600, 601}
    model = clusters.fit_clusters(odd, "cls", n_clusters=3, max_iter=5)
    assert np.isfinite(np.array(model.clusterCenters())).all()


def test_many_wide_centroids_need_no_key(spark):
    centers = RNG.normal(size=(5000, 768)).astype(np.float32)
    rows = [(i, (centers[i * 7] * 1.01).tolist()) for i in range(20)]
    points = spark.createDataFrame(rows, "id bigint, pca array<float>")
    table = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centers)], "cluster_id bigint, center array<float>")
    got = {r.id: r.cluster_id for r in assign_nearest_centroid(points, table).collect()}
    assert got == {i: i * 7 for i in range(20)}


def test_prepare_masked_needs_whole_labels(spark):
    rows = spark.createDataFrame([(1, "a", "5", 1, 0), (2, "b", "3", 0, 1)], "id int, text string, label string, metric_mask int, classification_mask int")
    ready = prepare(rows, rows, key="id", masked=True)
    assert {r.label: r.label_id for r in ready.train.collect()} == {3: 0, 5: 1}


@pytest.mark.parametrize("by", ["f1", "loss"])
def test_training_picks_the_best(labelled, by):
    ready = prepare(labelled, labelled.drop("id"), key="id")
    grid = {"regParam": [5.0, 0.0, 0.01]}
    trained = train_classifier(ready.train, ready.validation, grid=grid, save_best_by=by, num_features=256)
    best = [e[by] for e in trained.log]
    chosen = next(e for e in trained.log if e["regParam"] == trained.settings["regParam"])
    assert chosen[by] == (min(best) if by == "loss" else max(best)) and chosen["accuracy"] == 1.0
    assert trained.model.transform(ready.validation).count() == 42
