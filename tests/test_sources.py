"""Sources, sinks and the rules on where intermediate tables may go."""

import pytest
from pyspark.sql import functions as F

from tagloom.checks import require_choice, require_columns, require_in_range, require_names, require_positive
from tagloom.operators.sizing import shared_folder, small_rows, small_table, spread, staged
from tagloom.sources import tables as ops


def test_shards_directory(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no folder"):
        ops.read_shards(spark, str(tmp_path / "absent"))
    folder = tmp_path / "shards"
    folder.mkdir()
    (folder / "notes.txt").write_text("x")
    with pytest.raises(FileNotFoundError, match="holds no"):
        ops.read_shards(spark, str(folder))
    spark.range(7).withColumn("b", F.lit(1)).write.mode("append").parquet(str(folder))
    shards = ops.read_shards(spark, str(folder), ["id"])
    assert shards.columns == ["id"] and shards.count() == 7 == ops.rows_in_shards(spark, str(folder))
    assert "ReadSchema: struct<id:bigint>" in shards._jdf.queryExecution().executedPlan().treeString()
    with pytest.raises(ValueError, match=r"\['c'\]"):
        ops.read_shards(spark, str(folder), ["id", "c"])


def test_shard_numbers(spark):
    names = ["/a/part-00012.parquet", "part-x.parquet", "part-3.csv", "b/part-7.parquet"]
    rows = spark.createDataFrame([(n,) for n in names], "p string")
    assert [r[0] for r in rows.select(ops.shard_number(F.col("p"))).collect()] == [12, None, None, 7]


def test_read_by_extension(spark, tmp_path):
    (tmp_path / "a.TXT").write_text("text,label\nx,1\n")
    assert ops.read_by_extension(spark, str(tmp_path / "a.TXT")).columns == ["text", "label"]


def test_train_and_validation(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", 1)], "text string, label int").write.parquet(path)
    train, validation = ops.read_train_and_validation(spark, path, path, ["text", "label"])
    assert train.count() == validation.count() == 1 and ops.read_texts(spark, path).columns == ["text"]
    with pytest.raises(ValueError, match="validation"):
        ops.read_train_and_validation(spark, path, "", ["text"])
    with pytest.raises(ValueError, match="metric_mask"):
        ops.read_train_and_validation(spark, path, path, ["metric_mask"])


def test_never_overwrite_an_input(spark, tmp_path):
    """T7."""
    path = str(tmp_path / "t")
    ops.write_table(spark.range(3), path)
    with pytest.raises(ValueError, match="Refusing"):
        ops.write_table(spark.read.parquet(path).filter("id > 1"), path)
    ops.write_table(spark.read.parquet(path), path + "-v2")
    assert spark.read.parquet(path + "-v2").count() == 3


def test_concatenation(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([("y", 2)], "s string, i int")
    assert sorted(tuple(r) for r in ops.concat_tables([a, b]).collect()) == [(1, "x"), (2, "y")]
    assert ops.concat_tables([a.limit(0)]).columns == ["i", "s"]


def test_small_tables_have_a_proven_size(spark):
    assert small_rows(spark.range(10), 9) is None and small_rows(spark.range(10), 10).num_rows == 10
    assert small_table(spark.range(10), 9) is None
    assert sorted(r.id for r in small_table(spark.range(3)).collect()) == [0, 1, 2]


def test_staged_tables_go_to_the_configured_folder(spark):
    assert shared_folder(spark).removeprefix("file:").startswith(spark.conf.get("spark.checkpoint.dir"))
    table = staged(spark.range(5))
    assert table.count() == 5 and all(spark.conf.get("spark.checkpoint.dir") in f for f in table.inputFiles())


def test_spread_leaves_large_sources_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    wide = spark.range(100).repartition(cores + 3)
    assert spread(wide) is wide and spread(spark.range(100).coalesce(1)).rdd.getNumPartitions() == cores


def test_argument_checks(spark):
    rows = spark.createDataFrame([(0,), (3,)], "c int")
    with pytest.raises(ValueError, match="Missing columns"):
        require_columns(rows, ["x"], "rows")
    with pytest.raises(ValueError, match="out of range"):
        require_in_range(rows, ["c"], 3)
    assert require_in_range(rows, ["c"], 4) is rows
    with pytest.raises(ValueError, match="a must be provided"):
        require_names(a="")
    with pytest.raises(ValueError, match="b must be positive"):
        require_positive(a=1, b=0)
    with pytest.raises(ValueError, match="Invalid mode"):
        require_choice("x", ["a"], "mode")


def test_cells_keep_their_blanks(spark, tmp_path):
    path = str(tmp_path / "cells.csv")
    rows = [("  a ", "x"), ("b\n c", ' "q" '), ("\t", "1")]
    ops.write_csv(spark.createDataFrame(rows, "text string, label string"), path)
    assert sorted(tuple(r) for r in ops.read_csv(spark, path).collect()) == sorted(rows)
    with pytest.raises(ValueError, match="Refusing"):
        ops.write_csv(ops.read_csv(spark, path), path)


def test_maps_travel_through_the_file_system(spark, tmp_path):
    rows = spark.range(25_000).select("id", (F.col("id") % 3).alias("to"))
    path = f"file://{tmp_path}/deep/map.json"
    ops.write_int_map(rows.repartition(3), "id", "to", path)
    assert ops.read_prediction_mapping(spark, path) == {i: i % 3 for i in range(25_000)}
    ops.write_int_map(rows.limit(2), "id", "to", path)
    assert ops.read_prediction_mapping(spark, path) == {0: 0, 1: 1}
    with pytest.raises(FileNotFoundError):
        ops.read_prediction_mapping(spark, path + "x")


def test_staged_tables_can_be_removed(spark):
    from tagloom.operators import sizing

    before = list(sizing._staged_paths)
    sizing._staged_paths.clear()
    path = sizing.staging_path(spark, "t")
    spark.range(3).write.parquet(path)
    assert sizing.remove_staged(spark) == 1 and sizing.remove_staged(spark) == 0
    assert not ops.paths.exists(spark, path)
    sizing._staged_paths.extend(before)


def test_wide_rows_are_not_small(spark):
    rows = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("s"))
    assert small_rows(rows, 10) is not None and small_rows(rows, 10, 5000) is None
