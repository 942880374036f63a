"""CSV read by byte ranges against the reader of whole files."""

import random

import pytest

from tagloom.catalog import jobs
from tagloom.sources import split_csv
from tagloom.sources.tables import read_csv, write_csv


@pytest.fixture
def small_ranges(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "48")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def both(spark, path):
    def rows(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    whole, split = split_csv.whole_file_reader(spark, path), read_csv(spark, path, split=True)
    assert split.columns == whole.columns
    assert rows(split) == rows(whole)
    return split.count()


def test_random_cells(spark, tmp_path, small_ranges):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    rng = random.Random(6)
    parts = ["a", "é😀", " ", ",", '"', "\n", "\n\n", "x" * 60, "\r\n", "NA", "' "]
    rows = [("".join(rng.choice(parts) for _ in range(rng.randint(0, 9))), rng.choice(["", None, "k", 'q"']), str(i)) for i in range(300)]
    path = str(tmp_path / "cells.csv")
    write_csv(spark.createDataFrame(rows, "text string, other string, ID string").coalesce(1), path)
    assert both(spark, path) == 300
    lines = split_csv._lines(spark, path)
    assert lines.select("start").distinct().count() > 10


CASES = {
    "plain": "a,b\n1,2\n3,4\n",
    "no end": "a,b\n1,2\n3,4",
    "returns": "a,b\r\n1,\"x\r\ny\"\r\n3,4\r\n",
    "a return at the end": "a,b\r\n\"1\r\n\r\n\",2\r\n3,\"4\r\"",
    "blank lines": "\n\na,b\n\n1,2\n\n   \n3,4\n\n",
    "broken header": "\"a\n1\",b\n1,2\n",
    "long cell": "a,b\n1,\"" + "y\n" * 200 + "\"\n2,z\n",
    "short and long rows": "a,b\n1\n1,2,3\n,\n",
    "only a header": "a,b\n",
    "quote inside a cell": "a,b\n1,5\" disk\n2,x\n3,y\n",
    "quotes and more": "a,b\n1,\"x\" y\n2,z\n",
    "never closed": "a,b\n1,\"x\n2,y\n3,z\n",
    "mixed ends": "a,b\n1,2\r\n3,4\r\n5,6\n",
    "old ends": "a,b\r1,2\r3,4\r",
    "mark": "a,b\n1,\x01\n\"\x01\",2\n",
    "empty quotes": "a,b\n\"\",\"\"\"\"\n\"\"\"x\"\"\",\n",
}


@pytest.mark.parametrize("name", CASES)
def test_odd_files(spark, tmp_path, small_ranges, name):
    path = tmp_path / "one.csv"
    path.write_bytes(CASES[name].encode())
    both(spark, str(path))


def test_a_folder_of_files(spark, tmp_path, small_ranges):
    """Regular files and one that must be read as a whole."""
    for i, name in enumerate(["plain", "long cell", "quote inside a cell", "no end"]):
        (tmp_path / f"f{i}.csv").write_bytes(CASES[name].encode())
    assert both(spark, str(tmp_path)) == 9


def test_only_large_files_are_split(spark, tmp_path, small_ranges):
    small, large = tmp_path / "s.csv", tmp_path / "l.csv"
    small.write_text("a\n1\n")
    large.write_text("a\n" + "1\n" * 100)
    assert not split_csv.worth_splitting(spark, str(small)) and split_csv.worth_splitting(spark, str(large))
    assert read_csv(spark, str(large)).count() == 100


def test_tasks_do_not_grow_with_the_ranges(spark, tmp_path, monkeypatch):
    """A large file in small ranges is read by a bounded number of tasks, and the settings are put back."""
    rows = [(i, 0, "user", f"text {i} " + "x" * 600) for i in range(2000)]
    spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    setting, tasks = "spark.sql.files.maxPartitionNum", []

    def counted(spark, path, read=jobs.read_scoring_csv):
        tasks.append(split_csv._lines(spark, path).rdd.getNumPartitions())
        return read(spark, path)

    before = spark.conf.get(setting, None)
    monkeypatch.setattr(jobs, "read_scoring_csv", counted)
    assert jobs.csv_byte_ranges(spark, str(tmp_path)).distinct().count() == len(rows)
    assert 1 < tasks[0] <= 5 * spark.sparkContext.defaultParallelism and spark.conf.get(setting, None) == before
