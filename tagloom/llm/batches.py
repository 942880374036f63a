"""Work on the texts of Arrow batches: whole-column tokenising without a Python loop per word.

A text is bytes; a 256-entry table lower-cases A-Z and turns separators into blanks, so lengths and UTF-8 sequences
stay as they are, and Arrow splits the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

SLICE_BYTES = 4 << 20
#: Bytes of rows that go to Python at once. Spark's own bound is 64 MiB, of which a task holds several.
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_LOWER = [c + 32 if 65 <= c <= 90 else c for c in range(256)]
#: Words are runs of a-z, 0-9 and everything beyond ASCII, after A-Z was lower-cased.
ALNUM = bytes(c if c >= 0x80 or chr(c).isalnum() else 32 for c in _LOWER)
#: Words are runs of anything but ``[\x20\x09-\x0D]``, after A-Z was lower-cased.
BLANKS = bytes(_LOWER)


_kept: list[Callable] = []


def kept_by_worker(maxsize: int) -> Callable[[Callable], Callable]:
    """Marks a function whose last results a worker keeps from task to task, until it runs those of another operator."""

    def mark(function: Callable) -> Callable:
        _kept.append(lru_cache(maxsize=maxsize)(function))
        return _kept[-1]

    return mark


def forget(but: Callable | None = None) -> None:
    """Let go of what this worker keeps, except for results of ``but``."""
    for cached in _kept:
        if cached is not but:
            cached.cache_clear()


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's bound on batches for Python to ``BATCH_BYTES``; a lower one stays."""
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if size(spark.conf.get(_BATCH_SETTING)) > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, f"{BATCH_BYTES}b")


def plain(texts: pa.Array) -> pa.Array:
    """The texts as one string array without nulls; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return pc.fill_null(texts.cast(pa.string()), "")


def layout(texts: pa.Array) -> tuple[np.ndarray, memoryview]:
    """Where each text or row of bytes begins and ends in the buffer, and what it holds of them."""
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return bounds, memoryview(data or b"")[bounds[0] : bounds[-1]]


def translated(texts: pa.Array, table: bytes) -> pa.Array:
    """Every byte mapped by ``table``; the array must come from ``plain``."""
    if len(texts) == 0:
        return texts
    bounds, data = layout(texts)
    offsets = (bounds - bounds[0]).astype(np.int32)
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(bytes(data).translate(table)))


def split_words(texts: pa.Array, table: bytes) -> tuple[pa.Array, np.ndarray]:
    """All words of a slice one after another, and the row of each."""
    if len(texts) == 0:
        return pa.array([], pa.string()), np.zeros(0, np.int64)
    parts = pc.ascii_split_whitespace(translated(texts, table))
    words = parts.flatten()
    rows = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    filled = pc.greater(pc.binary_length(words), 0)
    return words.filter(filled), rows[filled.to_numpy(zero_copy_only=False)]


def row_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes at most; a longer text makes a range of its own."""
    if len(texts) == 0:
        return
    bounds, _ = layout(texts)
    start = 0
    while start < len(texts):
        stop = int(np.searchsorted(bounds, bounds[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), len(texts))
        yield start, stop
        start = stop


def append_columns(
    df: DataFrame,
    text: str,
    fields: list[T.StructField],
    compute: Callable[[pa.Array, pa.RecordBatch], list],
    keeps: Callable | None = None,
    keep_text: bool = True,
) -> DataFrame:
    """``df`` with new columns that ``compute`` derives from slices of its texts.

    Input columns whose names the new ones take are dropped first, so the result never has a name twice. Workers keep
    the results of ``keeps`` and let go of what other operators kept. Without ``keep_text`` the result lacks the texts,
    and Python doesn't send them back.
    """
    bound_batches(df.sparkSession)
    taken = {f.name.lower() for f in fields} | (set() if keep_text else {text.lower()})
    source = "_text_of_rows"
    kept = [c for c in df.columns if c.lower() not in taken and c.lower() != source]
    rows = df.select(*[df[f"`{c}`"] for c in kept], df[f"`{text}`"].cast("string").alias(source))
    arrow = [to_arrow_type(f.dataType) for f in fields]
    names = kept + [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget(keeps)
        for batch in batches:
            texts = plain(batch.column(len(kept)))
            for start, stop in row_slices(texts):
                part = batch.slice(start, stop - start)
                new = compute(texts.slice(start, stop - start), part)
                made = [v.cast(t) if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(new, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *made], names=names)
        # a worker that waits for its next task holds no freed buffers meanwhile
        pa.default_memory_pool().release_unused()

    schema = T.StructType([*(rows.schema[c] for c in kept), *fields])
    return rows.mapInArrow(run, schema)
