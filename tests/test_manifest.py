"""Published versions against plain tables: what is rewritten, what readers see, what writers that fail leave."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tagloom.sources import manifest, paths

ROWS = [(i, f"text {i}", i % 4) for i in range(40)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, text string, shard_id int")


def contents(df):
    return sorted(map(tuple, df.collect()), key=repr)


def loads(spark, root, table="rows", version=None):
    found = manifest.entries(spark, root, manifest.load_version(spark, root, version))
    return {r["shard"]: r["load"] for r in found.filter(F.col("table") == table).collect()}


def test_only_shards_with_other_rows_are_written(spark, tmp_path):
    root = str(tmp_path)
    assert manifest.publish(root, {"rows": frame(spark, ROWS)}) == 1
    changed = [(i, "other" if i == 6 else t, s) for i, t, s in ROWS]  # the same number of rows in shard 2
    assert manifest.publish(root, {"rows": frame(spark, changed[::-1]).repartition(7)}) == 2
    before, after = loads(spark, root, version=1), loads(spark, root)
    assert [n for n in range(4) if before[n] != after[n]] == [2]
    assert contents(manifest.read_version(spark, root, "rows")) == sorted(changed, key=repr)
    assert contents(manifest.read_version(spark, root, "rows", 1)) == sorted(ROWS, key=repr)
    assert manifest.publish(root, {"rows": frame(spark, changed)}) == 3
    assert loads(spark, root) == after


def test_a_table_is_what_was_given_unless_others_are_kept(spark, tmp_path):
    root, half = str(tmp_path), [r for r in ROWS if r[2] < 2]
    rest = [r for r in ROWS if r[2] >= 2]
    manifest.publish(root, {"rows": frame(spark, half)})
    manifest.publish(root, {"rows": frame(spark, rest)}, keep_others=True)
    assert contents(manifest.read_version(spark, root, "rows")) == sorted(ROWS, key=repr)
    manifest.publish(root, {"rows": frame(spark, half)})
    assert contents(manifest.read_version(spark, root, "rows")) == sorted(half, key=repr)
    with pytest.raises(ValueError, match="other columns"):
        manifest.publish(root, {"rows": frame(spark, half).drop("text")}, keep_others=True)
    manifest.publish(root, {"rows": frame(spark, half).drop("text")})
    assert manifest.read_version(spark, root, "rows").columns == ["id", "shard_id"]
    manifest.publish(root, {"rows": frame(spark, [])})
    assert contents(manifest.read_version(spark, root, "rows")) == []


def test_tables_appear_together_or_not_at_all(spark, tmp_path):
    root = str(tmp_path)
    manifest.publish(root, {"a": frame(spark, ROWS), "b": frame(spark, ROWS[:5])})
    with pytest.raises(ValueError, match="without a whole number"):
        manifest.publish(root, {"a": frame(spark, ROWS[:9]), "b": frame(spark, [(1, "x", None)])})
    assert manifest.versions(spark, root) == [1]
    assert contents(manifest.read_version(spark, root, "a")) == sorted(ROWS, key=repr)
    manifest.publish(root, {"b": frame(spark, ROWS[5:])})
    assert contents(manifest.read_version(spark, root, "a")) == sorted(ROWS, key=repr)
    assert manifest.remove_unused(spark, root) == 2  # what the failed call wrote, and the first b
    assert contents(manifest.read_version(spark, root, "b")) == sorted(ROWS[5:], key=repr)
    assert manifest.versions(spark, root) == [2]


def test_a_number_is_given_once(spark, tmp_path):
    path = f"{tmp_path}/versions/000000000001.json"
    assert paths.publish_text(spark, path, "first")
    assert not paths.publish_text(spark, path, "second")
    assert paths.read_text(spark, path) == "first"
    assert [n for n in os.listdir(f"{tmp_path}/versions") if "partial" in n] == []


def test_lost_and_foreign_files_are_found_and_mended(spark, tmp_path):
    root = str(tmp_path)
    manifest.publish(root, {"rows": frame(spark, ROWS)})
    assert manifest.damaged_shards(spark, root, "rows").isEmpty()
    load = loads(spark, root)[1]
    for part in glob.glob(f"{root}/data/rows/{load}/_shard=1/*.parquet"):
        os.remove(part)
    frame(spark, ROWS[3:4]).coalesce(1).write.mode("append").parquet(f"{root}/data/rows/{load}/_shard=3")
    found = {tuple(r) for r in manifest.damaged_shards(spark, root, "rows").collect()}
    assert found == {(1, 10, 0), (3, 10, 11)}
    manifest.publish(root, {"rows": frame(spark, ROWS)})
    assert loads(spark, root)[1] == load  # files are only read when asked for
    manifest.publish(root, {"rows": frame(spark, ROWS)}, check_files=True)
    assert contents(manifest.read_version(spark, root, "rows")) == sorted(ROWS, key=repr)
    assert manifest.damaged_shards(spark, root, "rows").isEmpty()


@pytest.mark.parametrize(
    "a, b",
    [
        ([(1, None, 0)], [(None, "1", 0)]),
        ([(1, "x", 0), (1, "x", 0)], [(2, "y", 0), (2, "y", 0)]),
        ([(1, "", 0)], [(1, None, 0)]),
        ([(1, "a", 0), (2, "b", 0)], [(1, "b", 0), (2, "a", 0)]),
    ],
)
def test_digests_tell_rows_apart(spark, a, b):
    one, other = (manifest.shard_digests(frame(spark, rows)).first() for rows in (a, b))
    assert one["rows"] == other["rows"] and one["digest"] != other["digest"]


def test_digests_of_nested_values(spark):
    def digest(value):
        rows = spark.createDataFrame([(value, 0)], "v array<double>, shard_id int")
        return manifest.shard_digests(rows).first()["digest"]

    assert len({digest(v) for v in ([1.0, None], [None, 1.0], [1.0], [], None, [float("nan")], [0.0], [-0.0])}) == 8


def test_names_and_unknown_tables(spark, tmp_path):
    with pytest.raises(ValueError, match="no name for a table"):
        manifest.publish(str(tmp_path), {"../x": frame(spark, ROWS)})
    with pytest.raises(ValueError, match="no table"):
        manifest.read_version(spark, str(tmp_path), "rows")
    with pytest.raises(ValueError, match="no version"):
        manifest.load_version(spark, str(tmp_path), 4)
