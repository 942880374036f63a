"""Down- and up-sampling, shards, resume and shuffling."""

import pytest
from pyspark.sql import functions as F

from tagloom.operators import sampling as ops


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(i, "a" if i == 0 else "b", f"t{i}") for i in range(5)], "id bigint, label string, text string")


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_upsample_is_the_same_for_any_partitioning(rows, limit):
    draws = [ids(ops.upsample(rows.repartition(p), "label", "id", max_group_rows=limit)) for p in (1, 2, 7)]
    assert len(draws[0]) == 8 and draws[0] == draws[1] == draws[2]
    assert ids(ops.upsample(rows, "label", "id", seed=7)) != draws[0]


def test_upsample_evens_out_classes(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") < 20, "rare").otherwise("common").alias("label"))
    drawn = ops.upsample(rows, "label", "id")
    counts = {r.label: r["count"] for r in drawn.groupBy("label").count().collect()}
    assert sum(counts.values()) == 1960 and abs(counts["rare"] - 980) < 120
    assert drawn.filter("label = 'rare'").select("id").distinct().count() == 20


def test_upsampled_rows_come_in_random_order(spark):
    rows = spark.range(400).select("id", F.when(F.col("id") < 5, "rare").otherwise("common").alias("label"))
    drawn = [[r.id for r in ops.upsample(rows.repartition(p), "label", "id").collect()] for p in (1, 2, 7)]
    assert drawn[0] == drawn[1] == drawn[2]
    share = {i: drawn[0].count(i) / len(drawn[0]) for i in set(drawn[0])}
    by_chance = sum(s * s for s in share.values()) * len(drawn[0])
    equal = sum(a == b for a, b in zip(drawn[0], drawn[0][1:]))
    assert by_chance / 2 < equal < 2 * by_chance


def test_upsample_copies_behind_an_exchange(rows):
    plan = ops.upsample(rows, "label", "id")._jdf.queryExecution().executedPlan().toString()
    copying = plan.index("Generate explode(sequence(")
    below = plan[copying:]
    assert below.index("REPARTITION_BY_NUM") < below.index("Join")


def test_upsample_needs_unique_keys(spark):
    twice = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b")], "id int, label string")
    with pytest.raises(ValueError, match="not unique"):
        ops.upsample(twice, "label", "id")


def test_upsample_in_slices(spark, monkeypatch):
    rows = spark.range(50).select("id", F.when(F.col("id") == 0, "one").otherwise("many").alias("label"))
    whole = ids(ops.upsample(rows, "label", "id"))
    monkeypatch.setattr(ops, "_DRAWS_PER_SLICE", 10)
    assert ids(ops.upsample(rows, "label", "id")) == whole


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_downsample(spark, limit):
    rows = spark.range(300).select("id", (F.col("id") % 7 % 3).alias("label"), F.lit("t").alias("text"))
    small = min(r["count"] for r in rows.groupBy("label").count().collect())
    kept = [ops.downsample(rows.repartition(p), "label", "id", max_group_rows=limit) for p in (1, 5)]
    assert {r["count"] for r in kept[0].groupBy("label").count().collect()} == {small}
    assert ids(kept[0]) == ids(kept[1]) != ids(ops.downsample(rows, "label", "id", seed=1))


def test_empty_tables_are_errors(rows):
    for sample in (ops.downsample, ops.upsample):
        with pytest.raises(ValueError):
            sample(rows.filter(F.lit(False)), "label", "id")


@pytest.mark.parametrize("limit", [1_000_000, 0])
@pytest.mark.parametrize("n,shards,sizes", [(10, 4, [3, 3, 3, 1]), (5, 4, [2, 2, 1]), (3, 1, [3]), (2, 5, [1, 1])])
def test_shard_sizes(spark, n, shards, sizes, limit):
    """T8: shards are contiguous key ranges and need no global window over the rows."""
    table = spark.range(n).repartition(3)
    sharded = ops.assign_shards(table, shards, "id", max_group_rows=limit)
    counts = sharded.groupBy("shard_id").agg(F.count("*").alias("n"), F.min("id").alias("lo")).orderBy("shard_id").collect()
    assert [r.n for r in counts] == sizes
    assert [r.lo for r in counts] == sorted(r.lo for r in counts)


def test_resume_adds_only_missing_shards(spark, tmp_path):
    path = str(tmp_path / "shards")
    table = ops.assign_shards(spark.range(20), 4, "id")
    ops.write_shards(table.filter("shard_id in (0, 2)"), path)
    pending = ops.pending_shards(table, spark.read.parquet(path))
    assert {r.shard_id for r in pending.collect()} == {1, 3}
    ops.write_shards(table, path, resume=True)
    assert ids(spark.read.parquet(path)) == list(range(20))
    ops.write_shards(table, path, resume=True)
    assert spark.read.parquet(path).count() == 20


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_many_shards_are_few_shards(spark, limit):
    table = spark.createDataFrame([(k, i) for i, k in enumerate([5, 5, 5, 1, 2, 9, 9, 7, 3, 3, 11])], "k int, i int")
    for shards in (2, 4, 11, 30):
        few = ops.assign_shards(table, shards, "k", max_group_rows=limit).collect()
        many = ops.assign_shards(table, shards, "k", max_group_rows=limit, max_bounds=0).collect()
        assert sorted(few) == sorted(many)
        size = -(-11 // shards)
        keys = sorted(r.k for r in few)
        assert {r.k: r.shard_id for r in few} == {k: keys.index(k) // size for k in keys}


def test_resume_after_a_crash(spark, tmp_path):
    path = tmp_path / "shards"
    table = ops.assign_shards(spark.range(20), 4, "id")
    (path / "_temporary" / "0").mkdir(parents=True)
    ops.write_shards(table, str(path), resume=True)
    assert ids(spark.read.parquet(str(path))) == list(range(20))
    for file in (path / "shard_id=1").iterdir():
        file.unlink()
    ops.write_shards(table.filter("id < 2").withColumn("shard_id", F.lit(1)), str(path / "shard_id=1") + "-half")
    half = next((path / "shard_id=1-half" / "shard_id=1").glob("*.parquet"))
    half.rename(path / "shard_id=1" / half.name)
    import shutil

    shutil.rmtree(path / "shard_id=1-half")
    ops.write_shards(table, str(path), resume=True)
    assert ids(spark.read.parquet(str(path))) == list(range(20))


def test_shards_never_overwrite_their_input(spark, tmp_path):
    path = str(tmp_path / "shards")
    ops.write_shards(ops.assign_shards(spark.range(4), 2, "id"), path)
    with pytest.raises(ValueError, match="Refusing"):
        ops.write_shards(spark.read.parquet(path), path)


def test_first_n_and_shuffle(spark):
    table = spark.range(50).repartition(4)
    assert ids(ops.first_n(table, 7, "id")) == list(range(7))
    assert ids(ops.first_n(table, 99, "id")) == list(range(50)) == ids(ops.first_n(table, None, "id"))
    with pytest.raises(ValueError):
        ops.first_n(table, 0, "id")
    order = [r.id for r in ops.shuffled(table, "id").collect()]
    assert order == [r.id for r in ops.shuffled(table.repartition(2), "id").collect()] != sorted(order)
