"""Vector and probability functions."""

import math

import pytest
from pyspark.sql import functions as F

from tagloom.functions import vectors as v
from tagloom.functions.casts import as_integer, at_least


def column(spark, kind, values, expr):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("x"))).collect()]


def test_normalise_keeps_zero_and_floors_tiny(spark):
    got = column(spark, "array<double>", [[3.0, 4.0], [0.0, 0.0], [1e-13, 0.0]], v.l2_normalize)
    assert got[0] == pytest.approx([0.6, 0.8]) and got[1] == [0.0, 0.0] and got[2] == pytest.approx([0.1, 0.0])


def test_validity(spark):
    values = [[3.0, 4.0], [0.0, 0.0], None, [], [1.0], [1.0, None]]
    assert column(spark, "array<double>", values, lambda c: v.is_valid_vector(c, 2)) == [True, True] + [False] * 4


def test_max_prob_guards_nan_and_null(spark):
    """T1, T2: NaN is the largest value for Spark and null is skipped; neither may survive."""
    values = [[0.2, 0.8], [], None, [0.9, math.nan], [0.9, None]]
    assert column(spark, "array<double>", values, v.max_prob) == [0.8, None, None, None, None]
    kept = column(spark, "array<double>", values, lambda c: at_least(v.max_prob(c), 0.0))
    assert kept == [True, False, False, False, False]
    assert column(spark, "double", [math.nan, None, 0.8], lambda c: at_least(c, 0.8)) == [False, False, True]


def test_softmax_and_argmax(spark):
    got = column(spark, "array<double>", [[0.0, math.log(3)], [1000.0, 1000.0]], v.softmax)
    assert got[0] == pytest.approx([0.25, 0.75]) and got[1] == [0.5, 0.5]
    assert column(spark, "array<double>", [[0.2, 0.4, 0.4]], v.argmax) == [1]


def test_scores(spark):
    rows = spark.createDataFrame([([1.0, 2.0], [4.0, 6.0])], "a array<float>, b array<double>")
    assert rows.select(v.dot(F.col("a"), F.col("b")), v.l2_distance(F.col("a"), F.col("b"))).first() == (16.0, 5.0)


def test_class_names(spark):
    assert column(spark, "int", [0, 1, 7], lambda c: v.class_name(c, ["n", "p"])) == ["n", "p", None]
    assert column(spark, "int", [7], lambda c: v.class_name(c, ["n"], fallback_to_index=True)) == ["7"]


def test_integer_casts(spark):
    """T3: plain casts raise; values that are no integer are skipped."""
    assert column(spark, "string", ["3", "1.7", "abc", None], as_integer) == [3, None, None, None]
    assert column(spark, "double", [1.7, -2.0], as_integer) == [1, -2]
