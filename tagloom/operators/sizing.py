"""Decisions that depend on how large something really is.

A side is broadcast only after its rows were counted; data read twice with a row order that must not
change in between is written once to the shared checkpoint folder.
"""

from __future__ import annotations

import tempfile
import uuid
import warnings

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.sources import paths

MAX_LOOKUP_ROWS = 100_000
MAX_LOOKUP_BYTES = 256 * 2**20
MAX_GROUP_ROWS = 1_000_000


def small_rows(df: DataFrame, max_rows: int = MAX_LOOKUP_ROWS, max_bytes: int = MAX_LOOKUP_BYTES) -> pa.Table | None:
    """The rows of ``df`` when there are at most ``max_rows`` of them in ``max_bytes``, else None."""
    rows = df.limit(max_rows + 1).toArrow()
    return rows if rows.num_rows <= max_rows and rows.nbytes <= max_bytes else None


def small_table(df: DataFrame, max_rows: int = MAX_LOOKUP_ROWS) -> DataFrame | None:
    """``df`` as a broadcast table when it has at most ``max_rows`` rows, else None.

    The rows that prove the size are the ones that get broadcast, so an aggregate behind ``df`` runs once.
    """
    rows = small_rows(df, max_rows)
    return None if rows is None else F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def small_or_whole(df: DataFrame, max_rows: int = MAX_LOOKUP_ROWS) -> DataFrame:
    """The broadcast form of a small ``df``; a larger one as it is, for a shuffled join."""
    small = small_table(df, max_rows)
    return df if small is None else small


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "left",
    what: str = "lookup table",
    max_rows: int = MAX_LOOKUP_ROWS,
    allow_empty: bool = True,
) -> DataFrame:
    """Join with a unique-key lookup: broadcast when small, shuffled with skew handling otherwise."""
    rows = small_rows(lookup, max_rows)
    if rows is not None and rows.num_rows == 0 and not allow_empty:
        raise ValueError(f"{what} holds no valid {key}")
    if rows is None:
        side = lookup
        unique = lookup.groupBy(key).count().filter("count > 1").isEmpty()
    else:
        side = F.broadcast(df.sparkSession.createDataFrame(rows, lookup.schema))
        unique = pc.count_distinct(rows[key], mode="all").as_py() == rows.num_rows
    if not unique:
        raise ValueError(f"{what} holds more than one row for some {key}")
    return df.join(side, key, how)


def spread(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Deal the rows of ``df`` out to all cores when the scan behind it has fewer splits than there are cores.

    Meant ahead of costly work per row. ``source`` is that scan where ``df`` is more than the scan itself. A
    large source has splits enough and its rows are not moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = (df if source is None else source).rdd.getNumPartitions()
    return df if splits >= cores else df.repartition(cores)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it; only a local session gets a temporary one.

    A ``file:`` folder on a cluster must be mounted on every machine; a warning says so.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="tagloom-")
        sc.setCheckpointDir(folder)
    if sc.getCheckpointDir().startswith("file:") and not sc.master.startswith("local"):
        warnings.warn(f"{sc.getCheckpointDir()} must be a folder that all executors share", stacklevel=2)
    return sc.getCheckpointDir()


_staged_paths: list[str] = []


def staging_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _staged_paths.append(path)
    return path


def remove_staged(spark: SparkSession) -> int:
    """Delete everything this session has staged; for when no result that still reads it is needed any more."""
    count = 0
    while _staged_paths:
        paths.remove(spark, _staged_paths.pop())
        count += 1
    return count


def staged(df: DataFrame, name: str = "staged") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back with its lineage cut."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
