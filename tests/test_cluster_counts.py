"""Label counts of clusters kept in a stream, against the batch job over the same rows."""

import random

import pytest

from tagloom.operators.labels import cluster_label_counts, cluster_purity, majority_labels
from tagloom.streaming import cluster_counts as cc

SCHEMA = "cluster_id string, label double, id int"


@pytest.fixture(scope="module")
def shards():
    rng = random.Random(4)
    rows = [[(str(rng.choice([0, 0, 0, 1, 2, -1])), float(rng.choice([0, 1, 1, 2])), i) for i in range(60)] for _ in range(4)]
    rows[0] += [(None, 1.0, 1), ("x", 1.0, 2), ("1", None, 3)]
    return rows


def test_totals_equal_the_batch_job(spark, shards, tmp_path):
    folder, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def deliver(number, name=None):
        one = str(tmp_path / f"one-{number}-{name}")
        spark.createDataFrame(shards[number], SCHEMA).coalesce(1).write.parquet(one)
        (part,) = [p for p in (tmp_path / f"one-{number}-{name}").iterdir() if p.name.endswith(".parquet")]
        target = tmp_path / "in" / (name or f"part-{number:05d}.parquet")
        target.parent.mkdir(exist_ok=True, parents=True)
        part.rename(target)

    def run(files=1):
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", str(files)).option("recursiveFileLookup", "true").parquet(folder)
        cc.count_arriving(stream, out, progress, slots=2).awaitTermination()
        return {(r["cluster_id"], r["label"]): r["n"] for r in cc.current_counts(spark, out).collect()}

    def batch(numbers):
        return spark.createDataFrame([r for i in numbers for r in shards[i]], SCHEMA)

    def wanted(numbers):
        rows = cluster_label_counts(batch(numbers), whole_labels=True).collect()
        return {(r["cluster_id"], r["label"]): r["n"] for r in rows}

    assert cc.current_counts(spark, out).count() == 0
    deliver(0)
    deliver(1)
    assert run() == wanted([0, 1])
    assert run() == wanted([0, 1])  # a restart without news
    deliver(1, "again/part-1.parquet")  # the same shard from elsewhere, late
    deliver(2)
    assert run(files=5) == wanted([0, 1, 2])
    deliver(3)
    deliver(3, "again/part-3.parquet")  # twice in one batch
    assert run(files=5) == wanted([0, 1, 2, 3])
    whole = batch(range(4)).selectExpr("cluster_id", "bigint(label) AS label")
    assert {tuple(r) for r in cc.current_purity(spark, out).collect()} == {tuple(r) for r in cluster_purity(whole).collect()}
    got = {tuple(r) for r in cc.current_label_map(spark, out, exclude_invalid=True).collect()}
    assert got == {tuple(r) for r in majority_labels(whole, exclude_invalid=True).collect()}
    assert spark.conf.get(cc._PROVIDER) != cc._ROCKS


def test_shard_names(spark):
    names = spark.createDataFrame([("s3://a/part-00012.parquet",), ("/b/part-12.parquet",), ("/b/c-9.snappy.parquet",)], "f string")
    assert [r[0] for r in names.select(cc.shard_name(names.f)).collect()] == ["12", "12", "c-9.snappy.parquet"]
