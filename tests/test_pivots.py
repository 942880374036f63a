"""Pivot search against the cell join and against numpy."""

import numpy as np
import pytest

from tagloom.operators.neighbors import nearest_neighbors
from tagloom.operators.pivots import Cells, pivot_neighbors

RNG = np.random.default_rng(9)


def frame(spark, points, key):
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, f"{key} bigint, embedding array<double>")


def rows_of(df):
    return sorted((r["val_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in df.collect())


CLUSTERED = (RNG.normal(size=(12, 6)) * 20)[RNG.integers(12, size=600)] + RNG.normal(size=(600, 6))


@pytest.mark.parametrize("k, pivots, cell_rows", [(1, None, None), (7, 30, 20), (60, 5, 50)])
def test_same_rows_as_the_cell_join(spark, k, pivots, cell_rows):
    bank, queries = frame(spark, CLUSTERED[:500], "vec_id"), frame(spark, CLUSTERED[480:], "val_id")
    found = pivot_neighbors(queries, bank, k, pivots=pivots, cell_rows=cell_rows)
    assert rows_of(found.neighbors) == rows_of(nearest_neighbors(queries, bank, k, distance="l2"))
    assert found.pairs == 120 * 500 and found.compared <= found.pairs


def test_most_pairs_of_clustered_vectors_are_skipped(spark):
    bank, queries = frame(spark, CLUSTERED[:500], "vec_id"), frame(spark, CLUSTERED[500:], "val_id")
    found = pivot_neighbors(queries, bank, 5, pivots=40)
    assert found.compared < 0.2 * found.pairs


def test_vectors_without_clusters_and_copies(spark):
    """Nothing can be skipped for noise, and a vector that a third of the bank repeats ranks by id."""
    noise = RNG.normal(size=(200, 24))
    noise[:70] = noise[70]
    bank, queries = frame(spark, noise, "vec_id"), frame(spark, noise[60:90], "val_id")
    found = pivot_neighbors(queries, bank, 9, pivots=12, cell_rows=16)
    assert rows_of(found.neighbors) == rows_of(nearest_neighbors(queries, bank, 9, distance="l2"))
    firsts = [r[2] for r in rows_of(found.neighbors) if r[0] == 0]
    assert firsts == list(range(9))


@pytest.mark.parametrize("scale", [1e-7, 1.0, 1e7])
def test_any_scale(spark, scale):
    points = CLUSTERED[:150] * scale
    bank, queries = frame(spark, points, "vec_id"), frame(spark, points[::10] * (1 + 1e-9), "val_id")
    found = pivot_neighbors(queries, bank, 3)
    want = {(i, int(j)) for i, q in enumerate(points[::10] * (1 + 1e-9)) for j in np.linalg.norm(points - q, axis=1).argsort()[:3]}
    assert {(r["val_id"], r["vec_id"]) for r in found.neighbors.collect()} == want


def test_no_bound_skips_a_cell_with_a_closer_vector():
    for _ in range(30):
        bank, queries = RNG.normal(size=(80, 3)), RNG.normal(size=(20, 3)) * 2
        cells = Cells(bank[RNG.choice(80, 9, replace=False)])
        own = cells.gaps(bank)[0]
        home, gap = own.argmin(axis=1), own.min(axis=1)
        cells.with_bank([
            {"_cell": c, "n": (home == c).sum(), "least": gap[home == c].min(), "most": gap[home == c].max()} for c in set(home)
        ])
        true = np.linalg.norm(queries[:, None] - bank[None], axis=2)
        bounds = np.sort(true, axis=1)[:, 4]
        may = cells.others(queries, bounds)
        near = true <= bounds[:, None]
        assert all(may[i, home[j]] for i, j in zip(*np.nonzero(near), strict=True))


def test_small_and_empty_sides_and_invalid_vectors(spark):
    bank = frame(spark, CLUSTERED[:3], "vec_id")
    odd = spark.createDataFrame([(7, None), (8, [1.0]), (9, [float("nan")] * 6)], "vec_id bigint, embedding array<double>")
    queries = frame(spark, CLUSTERED[:2], "val_id")
    assert len(rows_of(pivot_neighbors(queries, bank.unionByName(odd), 10).neighbors)) == 6
    assert rows_of(pivot_neighbors(queries.limit(0), bank, 2).neighbors) == []
    assert rows_of(pivot_neighbors(queries, bank.limit(0), 2, dim=6).neighbors) == []
