"""Mini-batch k-means against the same updates in numpy."""

import numpy as np
import pytest

from tagloom.plans import minibatch_clusters as mb

RNG = np.random.default_rng(2)
CENTERS = RNG.normal(size=(4, 3)) * 8


@pytest.fixture(scope="module")
def points():
    return np.concatenate([c + RNG.normal(size=(60, 3)) for c in CENTERS])


def table(spark, points, parts=3):
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)] + [(900, None), (901, [1.0]), (902, [float("inf")] * 3)]
    return spark.createDataFrame(rows, "id bigint, pca array<double>").repartition(parts)


def by_hand(state, points):
    nearest = ((points[:, None] - state.centers[None]) ** 2).sum(axis=2).argmin(axis=1)
    counts, centers = state.counts.copy(), state.centers.copy()
    for c in range(len(centers)):
        own = points[nearest == c]
        if len(own):
            counts[c] += len(own)
            centers[c] += (own.sum(axis=0) - len(own) * centers[c]) / counts[c]
    return counts, centers


@pytest.mark.parametrize("parts", [1, 5])
def test_updates_against_numpy(spark, points, parts):
    """The same state for any partitioning."""
    state = mb.start(table(spark, points), "pca", 4)
    for part in (points[::2], points[1::2]):
        want = by_hand(state, part)
        state = mb.partial_fit(state, table(spark, part, parts), starved=0.0)
        assert np.array_equal(state.counts, want[0]) and np.allclose(state.centers, want[1], atol=1e-12)
    assert (state.batches, state.vectors) == (2, 240)
    gaps = np.linalg.norm(CENTERS[:, None] - state.centers[None], axis=2).min(axis=1)
    assert (gaps < 0.6).all()


def test_first_centres(spark, points):
    chosen = mb.spread_centers(points, 4, 7)
    assert len(np.unique(chosen, axis=0)) == 4
    with pytest.raises(ValueError, match="different vectors"):
        mb.spread_centers(np.ones((9, 3)), 2, 7)
    with pytest.raises(ValueError, match="as many vectors"):
        mb.start(table(spark, points[:3]), "pca", 4)
    again = mb.start(table(spark, points, 7), "pca", 4)
    assert np.array_equal(again.centers, mb.start(table(spark, points, 2), "pca", 4).centers)


def test_starved_centres_are_moved(spark, points):
    far = np.array([[0.0, 0.0, 0.0], [1e6, 0.0, 0.0]])
    state = mb.State(far, np.array([500, 1]))
    moved = mb.partial_fit(state, table(spark, points))
    assert (np.abs(moved.centers) < 100).all() and moved.since_reseeded == 0 and moved.counts[1] == moved.counts[0]
    kept = mb.partial_fit(state, table(spark, points), starved=0.0)
    assert kept.centers[1, 0] == 1e6


def test_dealt_batches(spark, points):
    state = mb.fit_batches(table(spark, points), n_clusters=4, batch_rows=50, passes=2)
    assert state.vectors == 480 and state.batches == 10
    gaps = np.linalg.norm(CENTERS[:, None] - state.centers[None], axis=2).min(axis=1)
    assert (gaps < 0.6).all()


def test_arriving_shards_and_restart(spark, points, tmp_path):
    shards, model, progress = (str(tmp_path / n) for n in ("shards", "model", "progress"))

    def run(model=model, progress=progress):
        stream = spark.readStream.schema("id bigint, pca array<double>").option("maxFilesPerTrigger", "1").parquet(shards)
        mb.fit_arriving(stream, model, progress, n_clusters=4, starved=0.0).awaitTermination()
        return mb.load_state(spark, model)

    table(spark, points[:0], 1).filter("id = 900").write.parquet(shards)  # a first file without any usable vector
    assert run() is None
    for part in (points[:100], points[100:200]):
        table(spark, part, 1).coalesce(1).write.mode("append").parquet(shards)
    first = run()
    assert (first.batches, first.vectors) == (2, 200)
    assert np.array_equal(run().centers, first.centers)  # nothing new
    table(spark, points[200:], 1).coalesce(1).write.mode("append").parquet(shards)
    last = run()
    assert (last.batches, last.vectors, last.counts.sum()) == (3, 240, 240)
    # a batch that is run again starts from the state before it
    number = mb._saved(spark, model)[-1]
    again = mb.partial_fit(mb.load_state(spark, model, before=number), table(spark, points[200:]), starved=0.0)
    assert np.allclose(again.centers, last.centers, atol=1e-12) and len(mb._saved(spark, model)) == 2
