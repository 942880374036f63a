"""Classification metrics and losses against hand-computed values and plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tagloom.operators import metrics as ops


def pairs(spark, rows):
    return spark.createDataFrame(rows, "label int, pred int")


def by_hand(rows):
    classes = sorted({x for r in rows for x in r})
    scores = []
    for c in classes:
        tp = sum(a == c == b for a, b in rows)
        predicted, actual = sum(b == c for _, b in rows), sum(a == c for a, _ in rows)
        p, r = (tp / predicted if predicted else 0.0), (tp / actual if actual else 0.0)
        scores.append((p, r, 2 * p * r / (p + r) if p + r else 0.0))
    macro = [sum(s[i] for s in scores) / len(classes) for i in range(3)]
    return [sum(a == b for a, b in rows) / len(rows), *macro]


def test_macro_covers_classes_of_truth_and_prediction(spark):
    """T4: class 2 only occurs as truth, class 3 only as prediction."""
    rows = [(0, 0), (0, 0), (1, 0), (1, 1), (2, 0), (1, 3)]
    assert list(ops.classification_metrics(pairs(spark, rows)).first()) == pytest.approx(by_hand(rows))
    scores = {r["class"]: (r.precision, r.recall, r.f1) for r in ops.per_class_scores(pairs(spark, rows)).collect()}
    assert scores[2] == (0, 0, 0) and scores[3] == (0, 0, 0)


def test_random_pairs(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(5), rng.randrange(6)) for _ in range(300)]
    for parts in (1, 2, 7):
        got = ops.classification_metrics(pairs(spark, rows).repartition(parts)).first()
        assert list(got) == pytest.approx(by_hand(rows))


def test_no_rows_score_zero(spark):
    assert tuple(ops.classification_metrics(pairs(spark, [])).first()) == (0.0, 0.0, 0.0, 0.0)


def test_by_batch_with_masks(spark):
    rows = spark.createDataFrame(
        [(1, 0, 0, 1.0), (1, 1, 0, 1.0), (1, 1, 1, 0.0), (2, 0, 0, 0.0)], "batch int, label int, pred int, mask double"
    )
    got = {r.batch: [r[m] for m in ops.METRICS] for r in ops.masked_metrics_by_batch(rows, "batch", "mask").collect()}
    assert got[1] == pytest.approx(by_hand([(0, 0), (1, 0)])) and got[2] == [0.0] * 4


def test_confusion_grid(spark):
    rows = pairs(spark, [(0, 0), (0, 1), (0, 1), (1, 1)])
    counts = ops.confusion_counts(rows, 3)
    assert {(r.label, r.pred): r.n for r in counts.collect()} == {
        (0, 0): 1, (0, 1): 2, (0, 2): 0, (1, 0): 0, (1, 1): 1, (1, 2): 0, (2, 0): 0, (2, 1): 0, (2, 2): 0,
    }
    shown = {(r.label, r.pred): (r.share, r.shown) for r in ops.confusion_normalized(counts).collect()}
    assert shown[0, 1] == (pytest.approx(2 / 3), "66.7%") and shown[2, 2] == (0.0, "0.0%")
    assert shown[1, 1] == (1.0, "100.0%")


def test_confusion_range_check(spark):
    with pytest.raises(ValueError, match="out of range"):
        ops.confusion_counts(pairs(spark, [(0, 3)]), 3)


def test_cross_entropy(spark):
    rows = spark.createDataFrame(
        [("a", [0.5, 0.25, 0.25], 0, 1.0), ("a", [0.1, 0.8, 0.1], 1, 1.0), ("a", [0.0, 1.0, 0.0], 0, 0.0), ("b", [0.2, 0.8, 0.0], 1, 0.0)],
        "b string, probs array<double>, label int, mask double",
    )
    got = {r.b: r.classification_loss for r in ops.masked_cross_entropy(rows, by=["b"]).collect()}
    assert got == {"a": pytest.approx(-(math.log(0.5) + math.log(0.8)) / 2), "b": 0.0}
    smooth = ops.masked_cross_entropy(rows.limit(1), smoothing=0.3).first()[0]
    logs = [-math.log(p) for p in (0.5, 0.25, 0.25)]
    assert smooth == pytest.approx(0.7 * logs[0] + 0.1 * sum(logs))


def test_total_and_epoch_means(spark):
    log = spark.createDataFrame([(1, 2.0, 4.0), (1, 4.0, 0.0), (2, 1.0, 1.0)], "epoch int, c double, m double")
    total = log.withColumn("value", ops.total_loss(F.col("c"), F.col("m"), 1.0, 0.5))
    assert {r[0]: r[1] for r in ops.epoch_means(total, ["epoch"]).collect()} == {1: 4.0, 2: 1.5}


@pytest.mark.parametrize("probs,label", [([0.5, 0.5], 2), ([0.5, 0.5], -1), ([0.5, 0.5], None), ([0.5, None], 0), ([], 0), (None, 0)])
def test_impossible_labels_are_errors(spark, probs, label):
    rows = spark.createDataFrame([(probs, label, 1.0), ([1.0, 0.0], 0, 1.0)], "probs array<double>, label int, mask double")
    for smoothing in (0.0, 0.1):
        with pytest.raises(Exception, match="no probability for label"):
            ops.masked_cross_entropy(rows, smoothing=smoothing).collect()
        masked = rows.withColumn("mask", F.when(F.col("label") == 0, F.col("mask")).otherwise(0.0)) if label != 0 else None
        if masked is not None:
            assert ops.masked_cross_entropy(masked, smoothing=smoothing).first()[0] is not None


def test_a_probability_of_zero_is_floored(spark):
    rows = spark.createDataFrame([([1.0, 0.0], 1, 1.0)], "probs array<double>, label int, mask double")
    assert 600 < ops.masked_cross_entropy(rows).first()[0] < 800
