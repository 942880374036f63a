"""The pseudo-label refresh: thresholds, masks, balancing and its plan."""

import math

import pytest
from pyspark.sql import functions as F

from tagloom.plans.refresh import Thresholds, judge_rows, mask_fractions, refresh, refresh_audit, run_refresh

LIMITS = Thresholds(0.9, 0.6, 0.8, 0.8)


def centroids(spark, *purities):
    return spark.createDataFrame([(i, p) for i, p in enumerate(purities)], "cluster_id bigint, purity double")


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "id bigint, text string, label string, cluster_id bigint, probs array<double>")


def test_thresholds_and_masks(spark):
    purity = centroids(spark, 0.9, 0.85, 0.95, 0.7, math.nan, None)
    rows = rows_of(
        spark,
        [
            (1, "a", "x", 0, [0.6, 0.4]),
            (2, "b", "x", 1, [0.75, 0.25]),
            (3, "c", "x", 2, [0.85, 0.15]),
            (4, "d", "x", 3, [0.99, 0.01]),
            (5, "e", "x", 4, [0.99, 0.01]),
            (6, "f", "x", 5, [0.99, 0.01]),
            (7, "g", "x", -1, [0.99, 0.01]),
            (8, "h", "x", None, [0.99, 0.01]),
            (9, "i", "x", 2, [0.9, math.nan]),
            (10, "j", "x", 2, None),
        ],
    )
    out = refresh(rows, purity, LIMITS, key="id", keep_key=True, balance=False)
    got = {r.id: (r.metric_mask, r.classification_mask) for r in out.collect()}
    assert got == {1: (1, 0), 2: (0, 0), 3: (1, 1)}
    audit = refresh_audit(judge_rows(rows, purity, LIMITS)).first()
    assert tuple(audit) == (10, 5, 2, 3)


def test_exact_boundary_is_kept(spark):
    out = refresh(
        rows_of(spark, [(1, "a", "x", 0, [0.8, 0.2])]), centroids(spark, 0.8), Thresholds(0.8, 0.8, 0.8, 0.8), key="id"
    )
    assert [tuple(r) for r in out.collect()] == [("a", "x", 1, 1)]
    assert out.columns == ["text", "label", "metric_mask", "classification_mask"]


def balance_rows(spark):
    scores = [0.9, 0.95, 0.95, 0.95, 0.9]
    rows = [(i, f"a{i}", "a", 0, [s, 1 - s]) for i, s in enumerate(scores)]
    rows += [(10 + i, f"b{i}", "b", 0, [0.85, 0.15]) for i in range(2)]
    return rows_of(spark, rows + [(20, "n", None, 0, [0.99, 0.01])])


@pytest.mark.parametrize("limit", [1_000_000, 0])
@pytest.mark.parametrize("parts", [1, 2, 7])
def test_balance_keeps_best_rows_and_breaks_ties_by_key(spark, limit, parts):
    """T9: ties go to the smaller key, for small groups and for split ones."""
    rows = balance_rows(spark).repartition(parts)
    purity = centroids(spark, 0.95)
    on = refresh(rows, purity, LIMITS, key="id", keep_key=True, max_group_rows=limit)
    assert sorted(r.id for r in on.collect()) == [1, 2, 10, 11]
    off = refresh(rows, purity, LIMITS, key="id", balance=False)
    assert off.count() == 8


def test_key_must_tell_rows_apart(spark):
    rows = balance_rows(spark).withColumn("id", F.lit(1).cast("bigint"))
    with pytest.raises(Exception, match="does not tell rows"):
        refresh(rows, centroids(spark, 0.95), LIMITS, key="id").collect()


def test_bad_input(spark):
    with pytest.raises(ValueError, match="non-negative"):
        Thresholds(-0.1, 0.5, 0.5, 0.5)
    with pytest.raises(ValueError, match="probs"):
        refresh(balance_rows(spark).drop("probs"), centroids(spark, 0.9), LIMITS, key="id")
    with pytest.raises(ValueError, match="no valid"):
        refresh(balance_rows(spark), centroids(spark), LIMITS, key="id")


def test_fractions(spark):
    empty = spark.createDataFrame([], "metric_mask bigint, classification_mask bigint")
    assert tuple(mask_fractions(empty).first()) == (0, 0.0, 0.0)
    some = spark.createDataFrame([(1, 0), (1, 1)], "metric_mask bigint, classification_mask bigint")
    assert tuple(mask_fractions(some).first()) == (2, 1.0, 0.5)


def test_written_table_and_plan(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    balance_rows(spark).withColumn("unused", F.lit("x" * 50)).write.parquet(source)
    rows = spark.read.parquet(source)
    run_refresh(rows, centroids(spark, 0.95), LIMITS, target, key="id")
    assert spark.read.parquet(target).count() == 4
    with pytest.raises(ValueError, match="Refusing"):
        run_refresh(rows, centroids(spark, 0.95), LIMITS, source, key="id")
    plan = refresh(rows, centroids(spark, 0.95), LIMITS, key="id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "unused" not in plan
    # The text is filtered where it lies: nothing but broadcasts moves.
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
