"""Content sort against groups made in Python."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tagloom.llm import exact_dedup


def expected(rows):
    groups = {}
    for i, (key, text) in enumerate(rows):
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", text or ""), []).append((-len(text or ""), key is None, key or 0, i, key))
    out = []
    for body, members in groups.items():
        head = min(members, key=lambda m: m[:3])
        for m in members:
            out.append((m[4], head[4], len(members), m[:3] == head[:3], hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=repr)


def marked(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    out = exact_dedup.mark_copies(df, **options)
    return [tuple(r) for r in out.select("doc_id", *exact_dedup.ADDED).collect()]


ROWS = [
    (1, "a b"), (2, "ab"), (3, "a  b"), (4, "a \t\n\x0b\x0c\rb"), (5, None), (6, ""), (7, "  "), (8, "\x1c"), (9, "\xa0ab"),
    (10, "é" * 40 + "x"), (11, "é" * 40 + "y"), (None, "ab "), (12, "z" * 200_000), (13, "z " * 200_000), (14, "A b"),
]


def test_small_table(spark):
    assert sorted(marked(spark, ROWS), key=repr) == expected(ROWS)


@pytest.mark.parametrize("partitions", [1, 7])
def test_hot_contents_are_sliced_with_the_same_result(spark, partitions):
    rows = ROWS + [(100 + i, "hot text" + " " * (i % 3)) for i in range(400)] + [(1000 + i, f"own {i}") for i in range(200)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        sliced, whole = marked(spark, rows, min_hot_rows=2), marked(spark, rows, min_hot_rows=10**9)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(sliced, key=repr) == sorted(whole, key=repr) == expected(rows)


@pytest.mark.parametrize("floor", [2, 10**9])
def test_repeated_rows_leave_one(spark, floor):
    rows = [(1, "same")] * 5 + [(2, "same")] * 5 + [(3, "other")]
    out = marked(spark, rows, min_hot_rows=10**9)
    assert sum(r[3] for r in out) == 2
    assert {r[1] for r in out} == {1, 3}


def test_one_shuffle_of_the_texts(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    plan = exact_dedup.mark_copies(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan and "Python" not in plan


def test_clashing_names_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "y")], "doc_id bigint, text string, KEPT string")
    out = exact_dedup.mark_copies(df)
    assert out.columns == ["doc_id", "text", *exact_dedup.ADDED]
    assert out.filter("kept").count() == 1
    assert exact_dedup.drop_copies(df.limit(0)).count() == 0
    assert exact_dedup.drop_copies(df.withColumn("lang", F.lit("en"))).columns == ["doc_id", "text", "lang"]
