"""Ranks, cut-offs and running aggregates give the same answer for small and for split groups."""

import random

import pytest
from pyspark.sql import functions as F

from tagloom.operators.ranking import best_so_far, rank_rows, running_mean, top_n_per_group

LIMITS = [1_000_000, 50]


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most of the rows, many of them with one and the same score."""
    rng = random.Random(5)
    rows = [(i, "hot" if i % 10 else f"g{i % 3}", rng.choice([0.5, 0.5, 0.5, round(rng.random(), 3)])) for i in range(2000)]
    rows += [(5000 + i, None, 0.5) for i in range(20)]
    return spark.createDataFrame(rows, "id bigint, g string, x double").repartition(6).persist()


def by_group(skewed):
    groups = {}
    for r in skewed.collect():
        groups.setdefault(r.g, []).append((r.id, r.x))
    return groups


@pytest.mark.parametrize("limit", LIMITS)
def test_ranks(skewed, limit):
    ranked = rank_rows(skewed, ["g"], [F.col("x").desc(), F.col("id").asc()], max_group_rows=limit)
    got = {r.id: r["rank"] for r in ranked.collect()}
    expected = {}
    for rows in by_group(skewed).values():
        for place, (key, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), 1):
            expected[key] = place
    assert got == expected


@pytest.mark.parametrize("limit", LIMITS)
def test_global_rank(skewed, limit):
    ranked = rank_rows(skewed.select("id"), [], [F.col("id").asc()], max_group_rows=limit)
    ids = sorted(r.id for r in skewed.collect())
    assert {r.id: r["rank"] for r in ranked.collect()} == {k: i for i, k in enumerate(ids, 1)}


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("descending", [True, False])
def test_top_n(skewed, limit, descending):
    sign = -1 if descending else 1
    for n in (1, 60, 700):
        got = top_n_per_group(skewed, "g", n, F.col("x"), "id", descending=descending, max_group_rows=limit)
        expected = set()
        for group, rows in by_group(skewed).items():
            if group is not None:
                expected |= {k for k, _ in sorted(rows, key=lambda r: (sign * r[1], r[0]))[:n]}
        assert {r.id for r in got.collect()} == expected


@pytest.mark.parametrize("limit", LIMITS)
def test_running_mean(skewed, limit):
    got = {r.id: r.m for r in running_mean(skewed, ["g"], "id", "x", "m", max_group_rows=limit).collect()}
    for rows in by_group(skewed).values():
        total = 0.0
        for n, (key, x) in enumerate(sorted(rows), 1):
            total += x
            assert got[key] == pytest.approx(total / n)


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("minimize", [True, False])
def test_best_so_far(skewed, limit, minimize):
    flagged = best_so_far(skewed, ["g"], "id", "x", "best", minimize=minimize, max_group_rows=limit)
    got = {r.id: r.best for r in flagged.collect()}
    for rows in by_group(skewed).values():
        best = None
        for key, x in sorted(rows):
            better = best is None or (x < best if minimize else x > best)
            assert got[key] is better
            best = x if better else best


def test_best_so_far_fixture(spark):
    log = spark.createDataFrame([(1, 3.0), (2, 2.0), (3, 2.0), (4, 1.0)], "step bigint, value double")
    flags = best_so_far(log.withColumn("run", F.lit("r")), ["run"], "step", "value", "b", minimize=True)
    assert [r.b for r in flags.orderBy("step").collect()] == [True, True, False, True]
