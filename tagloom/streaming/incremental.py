"""Scoring of files as they arrive.

The query is stateless: each file is read once, its rows are scored and appended. The stream's checkpoint
remembers which files are done, so a restarted query goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tagloom.checks import require_choice, require_columns
from tagloom.functions.text import missing_as_nan_text
from tagloom.operators.scoring import Scorer, score_texts


def arriving_files(
    spark: SparkSession,
    directory: str,
    schema: StructType,
    *,
    fmt: str = "parquet",
    pattern: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Stream of the rows of new CSV or Parquet files under ``directory``."""
    require_choice(fmt, ["parquet", "csv"], "format")
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.options(header="true", multiLine="true", quote='"', escape='"')
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.load(directory)


def score_arriving(
    stream: DataFrame,
    load_model: Callable[[], Scorer],
    output_path: str,
    checkpoint_path: str,
    *,
    text: str = "text",
    batch_size: int = 32,
    once: bool = True,
    markers: list[str] | None = None,
) -> StreamingQuery:
    """Append scored rows to ``output_path``; ``once`` stops after the files present now.

    A missing text is scored as ``nan``, as the batch job does; ``markers`` lists cells that stand for one, as a CSV
    has them.
    """
    require_columns(stream, [text], "stream")
    stream = stream.withColumn(text, missing_as_nan_text(F.col(text), markers))
    scored = score_texts(stream, load_model, text=text, batch_size=batch_size)
    writer = scored.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", output_path).option("checkpointLocation", checkpoint_path)
    return (writer.trigger(availableNow=True) if once else writer).start()
