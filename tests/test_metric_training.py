"""Joint training: gradients, sums over tasks, steps, checkpoints."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.operators.neighbors import contrastive_loss
from tagloom.plans import metric_training as joint
from tagloom.plans.metric_training import JointModel, Settings

RNG = np.random.default_rng(1)


@pytest.mark.parametrize("smoothing, weights", [(0.0, (1.0, 0.0)), (0.2, (0.7, 0.0)), (0.1, (0.0, 1.0)), (0.1, (0.5, 2.0))])
def test_gradient_equals_finite_differences(smoothing, weights):
    settings = Settings(smoothing=smoothing, classification_weight=weights[0], metric_weight=weights[1], temperature=0.5)
    model = JointModel(RNG.normal(size=(5, 4)), RNG.normal(size=4), RNG.normal(size=(4, 3)), RNG.normal(size=3))
    vectors, labels = RNG.normal(size=(9, 5)), RNG.integers(0, 3, 9)
    masks = np.stack([RNG.choice([0.0, 0.5, 1.0], 9), RNG.choice([0.0, 1.0], 9, p=[0.2, 0.8])], axis=1)

    def loss(flat):
        a, b, _ = joint.batch_gradient(model.like(flat), vectors, labels, masks, settings)
        return weights[0] * a + weights[1] * b

    flat = model.flat()
    gradient = joint.batch_gradient(model, vectors, labels, masks, settings)[2]
    for i in range(len(flat)):
        step = np.zeros(len(flat))
        step[i] = 1e-6
        assert math.isclose((loss(flat + step) - loss(flat - step)) / 2e-6, gradient[i], rel_tol=1e-4, abs_tol=1e-7)


def test_losses_without_masked_rows_or_pairs():
    scores, labels = RNG.normal(size=(3, 2)), np.array([0, 1, 1])
    assert joint.cross_entropy_gradient(scores, labels, np.zeros(3), 0.0)[0] == 0
    unit = np.eye(3)
    for mask, own in (([0, 0, 0], labels), ([1, 0, 0], labels), ([1, 1, 0], labels)):
        loss, gradient = joint.contrastive_gradient(unit, own, np.array(mask, float), 0.1)
        assert loss == 0 and not gradient.any()


@pytest.fixture(scope="module")
def rows(spark):
    out = []
    for i in range(400):
        point = RNG.normal(size=6)
        label = int(point[0] > 0)
        out.append((i, [float(x) for x in point], label, i % 5 > 0, int(i % 7 > 0)))
    out += [(900, None, 0, True, 1), (901, [1.0], 0, True, 1), (902, [math.nan] * 6, 1, True, 1), (903, [9.0] * 6, 0, False, 0)]
    table = spark.createDataFrame(out, "vec_id bigint, embedding array<double>, label int, classification_mask boolean, metric_mask int")
    return table.withColumn("classification_mask", F.col("classification_mask").cast("int")).persist()


SETTINGS = Settings(epochs=3, batch_rows=20, batches_per_step=2, learning_rate=0.15, save_best_by="loss", recall_at=(1, 5), knn_k=3)


def test_sums_do_not_depend_on_partitions(spark, rows, monkeypatch):
    usable = joint.usable_rows(rows, "vec_id", "embedding", "label", 6, joint.MASKS)
    assert usable.count() == sum(1 for i in range(400) if i % 5 or i % 7)
    model = JointModel.start(6, 4, 2, 3)
    dealt = joint.deal(usable, 20, 4, 5).persist()
    assert dealt.select(F.sum(F.size("members"))).first()[0] == usable.count()
    losses = {}
    for parts, fan in ((1, 64), (7, 64), (13, 2)):
        monkeypatch.setattr(joint, "FAN", fan)
        losses[parts] = joint.step_gradient(dealt.repartition(parts), model, SETTINGS)
    for found in losses.values():
        assert found[3] == 20 and np.allclose(found[2], losses[1][2], atol=1e-12) and np.allclose(found[:2], losses[1][:2])
    # the contrastive loss is the one the library evaluates
    placed = usable.withColumn("batch_id", F.pmod(F.xxhash64(F.lit(5), "key"), F.lit(20)))
    embedded = joint.project(placed, model, "vector")
    per_batch = contrastive_loss(embedded, key="key", mask="metric_mask", temperature=SETTINGS.temperature)
    assert math.isclose(per_batch.agg(F.avg("metric_loss")).first()[0], losses[1][1], rel_tol=1e-9)


def test_training_learns_and_resumes(spark, rows, tmp_path):
    late = F.col("vec_id") % 4 == 0
    options = dict(settings=SETTINGS, dim=6)
    whole = joint.train_joint(rows.filter(~late), rows.filter(late), **options)
    assert [r["epoch"] for r in whole.log] == [1, 2, 3]
    assert whole.log[-1]["loss"] < whole.log[0]["loss"] and whole.log[-1]["accuracy"] > 0.8
    assert whole.best_epoch == min(whole.log, key=lambda r: r["loss"])["epoch"]
    path = str(tmp_path / "states")
    joint.train_joint(rows.filter(~late).repartition(3), rows.filter(late), checkpoint_path=path, stop_after=1, **options)
    resumed = joint.train_joint(rows.filter(~late), rows.filter(late), checkpoint_path=path, **options)
    assert np.allclose(resumed.last.flat(), whole.last.flat(), atol=1e-9) and resumed.best_epoch == whole.best_epoch
    finished = joint.train_joint(rows.filter(~late), rows.filter(late), checkpoint_path=path, **options)
    assert np.array_equal(finished.model.flat(), resumed.model.flat()) and len(finished.log) == 3
    with pytest.raises(ValueError, match="other settings"):
        joint.train_joint(rows, rows, checkpoint_path=path, settings=Settings(epochs=3))
    assert whole.log_table(spark).count() == 3


def test_small_steps_in_runs_give_the_same_model(spark, rows, monkeypatch):
    """One job for many small steps, in runs of any length, ends where a job for each step does."""
    late, options, found = F.col("vec_id") % 4 == 0, dict(settings=SETTINGS, dim=6), {}
    size = 8 * 6 * SETTINGS.batch_rows * SETTINGS.batches_per_step
    for name, step_bytes, run_bytes in (("single", 0, 0), ("short", 2**20, 3 * size), ("long", 2**20, 2**25)):
        monkeypatch.setattr(joint, "STEP_BYTES", step_bytes)
        monkeypatch.setattr(joint, "RUN_BYTES", run_bytes)
        found[name] = joint.train_joint(rows.filter(~late), rows.filter(late), **options)
    for name in ("short", "long"):
        assert np.allclose(found[name].last.flat(), found["single"].last.flat(), atol=1e-9)
        for ours, theirs in zip(found[name].log, found["single"].log, strict=True):
            assert math.isclose(ours["train_metric_loss"], theirs["train_metric_loss"], rel_tol=1e-9)


def test_projection_of_invalid_vectors(spark, rows):
    model = JointModel.start(6, 3, 2, 1)
    got = {r["vec_id"]: r for r in joint.project(rows, model).collect()}
    assert got[900]["embedding"] is got[901]["probs"] is got[902]["embedding"] is None
    assert math.isclose(sum(got[5]["probs"]), 1) and math.isclose(sum(x * x for x in got[5]["embedding"]), 1)


def test_schedules():
    rates = {s: [joint.learning_rate(Settings(schedule=s, warmup_steps=2, learning_rate=1.0), i, 6) for i in range(6)] for s in joint.SCHEDULES}
    assert rates["constant"] == [1.0] * 6
    assert rates["linear"] == [0.0, 0.5, 1.0, 0.75, 0.5, 0.25]
    assert np.allclose(rates["cosine"], [0, 0.5, 1, (1 + math.cos(math.pi / 4)) / 2, 0.5, (1 + math.cos(3 * math.pi / 4)) / 2])


def test_arguments(rows):
    with pytest.raises(ValueError, match="schedule"):
        Settings(schedule="steps")
    with pytest.raises(ValueError, match="recall_at_1"):
        Settings(save_best_by="recall_at_1", recall_at=(10,))
    with pytest.raises(ValueError, match="usable vector"):
        joint.train_joint(rows.limit(0), rows)
    with pytest.raises(ValueError, match="out of range"):
        joint.train_joint(rows, rows, classes=1)
    with pytest.raises(ValueError, match="neither mask"):
        joint.train_joint(rows.filter("vec_id = 903"), rows)
