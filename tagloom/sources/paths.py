"""Path helpers that go through the session's file system, local or remote."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from itertools import islice
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def _hadoop_path(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def is_directory(spark: SparkSession, path: str) -> bool:
    jvm_path, fs = _hadoop_path(spark, path)
    return fs.exists(jvm_path) and fs.getFileStatus(jvm_path).isDirectory()


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path, fs = _hadoop_path(spark, path)
    return fs.exists(jvm_path)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none where there is no such folder."""
    jvm_path, fs = _hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(jvm_path)) if fs.exists(jvm_path) else []


def write_text(spark: SparkSession, path: str, pieces: Iterable[str]) -> None:
    """Write one file, some thousand pieces at a time; it appears under its name when it is whole."""
    jvm_path, fs = _hadoop_path(spark, path)
    partial, _ = _hadoop_path(spark, f"{path}.partial")
    out, pieces = fs.create(partial, True), iter(pieces)
    while waiting := list(islice(pieces, 10_000)):
        out.write(bytearray("".join(waiting).encode()))
    out.close()
    if fs.exists(jvm_path):
        fs.delete(jvm_path, False)
    if not fs.rename(partial, jvm_path):
        raise OSError(f"{path} could not be put in place")


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that appears whole under its name; False where that name is taken, whose file then stays."""
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    target, fs = _hadoop_path(spark, path)
    partial, target = fs.makeQualified(hadoop.Path(f"{path}.{uuid.uuid4().hex}.partial")), fs.makeQualified(target)
    out = fs.create(partial, False)
    out.write(bytearray(text.encode()))
    out.close()
    options = sc._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.NONE
    try:
        hadoop.FileContext.getFileContext(target.toUri(), sc._jsc.hadoopConfiguration()).rename(partial, target, options)
    except Py4JJavaError as failure:
        fs.delete(partial, False)
        if "FileAlreadyExistsException" in failure.java_exception.toString():
            return False
        raise
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as a whole."""
    if not exists(spark, path):
        raise FileNotFoundError(f"there is no file {path}")
    return spark.read.text(path, wholetext=True).first()[0]


def remove(spark: SparkSession, path: str) -> None:
    jvm_path, fs = _hadoop_path(spark, path)
    fs.delete(jvm_path, True)


def _plain(uri: str) -> str:
    """One spelling for the ways a file URI may be written."""
    return re.sub(r"^file:/+", "file:/", unquote(uri)).rstrip("/")


def qualified(spark: SparkSession, path: str) -> str:
    jvm_path, fs = _hadoop_path(spark, path)
    return _plain(fs.makeQualified(jvm_path).toString())


def refuse_overwrite_of_input(df: DataFrame, path: str) -> None:
    """A plan must never write over a path it still reads from."""
    target = qualified(df.sparkSession, path)
    for name in df.inputFiles():
        source = _plain(name)
        if source == target or source.startswith(target + "/"):
            raise ValueError(f"Refusing to overwrite {path}: the same plan reads {name}")
