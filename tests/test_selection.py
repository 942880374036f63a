"""Selection by counts against sorting in plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from tagloom.operators.selection import nth_values, top_n_selected

RANDOM = random.Random(4)
# a flat group, one value throughout, one value in a third of the rows, few rows, and no group at all
GROUPS = {
    "flat": [RANDOM.uniform(-5, 5) for _ in range(3000)],
    "one": [2.5] * 1500,
    "third": [7.0] * 700 + [RANDOM.gauss(7, 1) for _ in range(1400)],
    "few": [3.0, 1.0, 2.0],
    None: [float(RANDOM.randrange(20)) for _ in range(900)],
}


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, g, x) for i, (g, x) in enumerate((g, x) for g, xs in GROUPS.items() for x in xs)]
    data += [(-1, "few", None), (-2, "few", float("nan")), (-3, "none", None)]
    return spark.createDataFrame(data, "id bigint, g string, x double").repartition(6).cache()


@pytest.mark.parametrize("share, last", [(0.0, 3), (0.37, 10), (0.5, 1000), (1.0, 5)])
def test_values_at_ranks(spark, rows, share, last):
    ranks = {g: max(1, int(len(xs) * share)) for g, xs in GROUPS.items()} | {"none": 1}
    table = spark.createDataFrame([(g, n) for g, n in ranks.items()], "g string, rank int")
    found = {r["g"]: r for r in nth_values(rows, table, "g", "x", last=last).collect()}
    assert set(found) == set(GROUPS)
    for g, xs in GROUPS.items():
        want = sorted(xs)[ranks[g] - 1]
        assert (found[g]["value"], found[g]["before"], found[g]["equal"]) == (want, sum(x < want for x in xs), xs.count(want))


def test_ranks_past_the_end_are_left_out(spark, rows):
    table = spark.createDataFrame([("few", 4), ("one", 1500), ("strange", 1)], "g string, rank int")
    assert [r["g"] for r in nth_values(rows, table, "g", "x", last=2).collect()] == ["one"]
    assert nth_values(rows, table.limit(0), "g", "x").count() == 0


@pytest.mark.parametrize("n, last", [(1, 5), (40, 20), (1000, 100), (5000, 1000)])
def test_top_rows_of_each_group(spark, rows, n, last):
    found = {(r["g"], r["id"]) for r in top_n_selected(rows, "g", n, "x", "id", last=last).collect()}
    data = [(g, x, i) for i, (g, x) in enumerate((g, x) for g, xs in GROUPS.items() for x in xs)]
    want = {(g, i) for name in GROUPS for g, _, i in sorted((r for r in data if r[0] == name), key=lambda r: (-r[1], r[2]))[:n]}
    assert found == want


def test_ties_in_score_and_key_are_refused(spark):
    twice = spark.createDataFrame([(1, "a", 1.0)] * 3, "id bigint, g string, x double")
    with pytest.raises(ValueError, match="tie"):
        top_n_selected(twice, "g", 2, "x", "id")
    assert top_n_selected(twice, "g", 3, "x", "id").count() == 3


def test_keys_beyond_the_reach_of_doubles(spark):
    big = 2**60
    rows = spark.range(50).select((F.lit(big) + F.col("id")).alias("id"), F.lit("a").alias("g"), F.lit(0.0).alias("x"))
    assert sorted(r["id"] - big for r in top_n_selected(rows, "g", 7, "x", "id", last=3).collect()) == list(range(7))
