"""Table sources and sinks."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Mapping
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.checks import require_columns
from tagloom.sources import paths
from tagloom.sources.split_csv import read_split_csv, whole_file_reader, worth_splitting


def read_shards(spark: SparkSession, directory: str, columns: Iterable[str] | None = None) -> DataFrame:
    """All ``*.parquet`` shards directly under ``directory``, pruned to ``columns``."""
    if not paths.is_directory(spark, directory):
        raise FileNotFoundError(f"there is no folder {directory} to read shards from")
    jvm_path, fs = paths._hadoop_path(spark, directory)
    names = [s.getPath().getName() for s in fs.listStatus(jvm_path)]
    if not any(n.endswith(".parquet") and n[0] not in "._" for n in names):
        raise FileNotFoundError(f"{directory} holds no *.parquet file")
    df = spark.read.option("pathGlobFilter", "*.parquet").parquet(directory)
    return df if columns is None else prune(df, columns, f"shards of {directory}")


def prune(df: DataFrame, columns: Iterable[str], what: str) -> DataFrame:
    columns = list(dict.fromkeys(columns))
    return require_columns(df, columns, what).select(*columns)


def read_texts(spark: SparkSession, path: str, text_column: str = "text") -> DataFrame:
    return prune(spark.read.parquet(path), [text_column], path)


def is_parquet(path: str) -> bool:
    return os.path.splitext(path)[1].lower() == ".parquet"


def read_by_extension(spark: SparkSession, path: str) -> DataFrame:
    """``.parquet`` as Parquet, ``.csv`` and ``.txt`` as CSV with a header; anything else is an error."""
    suffix = os.path.splitext(path)[1].lower()
    if is_parquet(path):
        return spark.read.parquet(path)
    if suffix in {".csv", ".txt"}:
        return read_csv(spark, path)
    raise ValueError(f"tables are read from .parquet, .csv or .txt, not from '{suffix}'")


def read_csv(spark: SparkSession, path: str, split: bool | None = None) -> DataFrame:
    """Header CSV whose quoted cells may hold line breaks and doubled quotes.

    Files larger than a byte range are read by several tasks; ``split`` asks for that, or for one task per file.
    """
    if split or (split is None and worth_splitting(spark, path)):
        return read_split_csv(spark, path)
    return whole_file_reader(spark, path)


def read_scoring_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV to be scored: the name ends in ``.csv``, it has ``ID`` and ``text``, and it is not empty."""
    if not path.rstrip("/").endswith(".csv"):
        raise ValueError(f"{path} should end in .csv")
    df = require_columns(read_csv(spark, path), ["ID", "text"], path)
    if df.isEmpty():
        raise ValueError(f"{path} has a header and no rows")
    return df.select("ID", "text")


def read_train_and_validation(
    spark: SparkSession, train_path: str, validation_path: str, columns: Iterable[str]
) -> tuple[DataFrame, DataFrame]:
    """Both tables are mandatory and must carry ``columns``."""
    if not train_path or not validation_path:
        raise ValueError("both a train and a validation path must be provided")
    train = require_columns(spark.read.parquet(train_path), columns, "train parquet")
    validation = require_columns(spark.read.parquet(validation_path), columns, "validation parquet")
    return train, validation


def write_table(df: DataFrame, path: str, mode: str = "overwrite", by: list[str] | None = None) -> None:
    """Parquet write that is published by the committer as a whole."""
    if mode == "overwrite":
        paths.refuse_overwrite_of_input(df, path)
    writer = df.write.mode(mode)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; cells keep the blanks around them."""
    paths.refuse_overwrite_of_input(df, path)
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', **blanks)


def write_metrics(df: DataFrame, path: str) -> None:
    """A one-row table of metrics as JSON."""
    paths.refuse_overwrite_of_input(df, path)
    df.coalesce(1).write.mode("overwrite").json(path)


def write_int_map(df: DataFrame, key: str, value: str, path: str) -> None:
    """Export a two-column map, keys sorted: JSON when the name ends in ``.json``, else YAML.

    One file by its nature: entries reach it partition by partition through the session's file system, and the driver
    never holds all of them. An empty map is an error.
    """
    as_json = path.lower().endswith(".json")
    ordered = df.select(F.col(key).cast("bigint"), F.col(value).cast("bigint")).orderBy(key)
    entries = ordered.toLocalIterator()
    first = next(entries, None)
    if first is None:
        raise ValueError(f"an empty map is not written to {path}")

    def pieces():
        for number, (k, v) in enumerate(chain([first], entries)):
            yield f'{"," if number else "{"}\n  "{k}": {v}' if as_json else f"{k}: {v}\n"
        yield "\n}" if as_json else ""

    paths.write_text(df.sparkSession, path, pieces())


def read_prediction_mapping(spark: SparkSession, path: str) -> dict[int, int]:
    """JSON object whose keys are ``"0"``, ``"1"``, ... without a gap."""
    return dense_mapping(json.loads(paths.read_text(spark, path)))


def dense_mapping(mapping: Mapping) -> dict[int, int]:
    whole = {int(k): int(v) for k, v in mapping.items()}
    missing = sorted(set(range(max(whole, default=-1) + 1)) - set(whole))
    if not whole or missing:
        raise ValueError(f"Prediction mapping lacks keys {missing or [0]}")
    return whole


def centroid_table(spark: SparkSession, centers, column: str = "cluster_id") -> DataFrame:
    """Centroids of a fitted model as a table of id and float vector."""
    schema = T.StructType(
        [T.StructField(column, T.LongType()), T.StructField("center", T.ArrayType(T.FloatType()))]
    )
    rows = [(i, [float(x) for x in center]) for i, center in enumerate(centers)]
    return spark.createDataFrame(rows, schema)


def concat_tables(tables: list[DataFrame]) -> DataFrame:
    """Union by name of one or more tables with the same columns."""
    if not tables:
        raise ValueError("no tables to concatenate")
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def rows_in_shards(spark: SparkSession, directory: str) -> int:
    """Row count over all shards; Spark answers it from the file footers."""
    return read_shards(spark, directory).count()


def shard_number(path: Column) -> Column:
    """Number in a ``part-<digits>.parquet`` file name, null for any other name."""
    name = F.substring_index(path, "/", -1)
    digits = F.regexp_extract(name, r"^part-(\d+)\.parquet$", 1)
    return F.when(digits != "", digits.cast("bigint"))
