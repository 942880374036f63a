"""CSV with line breaks in cells, read by as many tasks as its bytes ask for.

Spark reads the file as lines, split by byte ranges as any text. A line break lies inside a cell where an odd number of
quotes stands before it, so a range only has to know whether the quotes before it are odd in number: ranges count their
quotes, a prefix sum over the (few) ranges tells each how it begins, and a running count inside the range tells each line.
Lines that are whole records are parsed where they lie. Pieces of records that span lines are brought together under the
line, and the range, in which the record begins.

Counting quotes is right where quotes stand only around whole cells and in pairs inside them. Each line is checked for
that, for line ends of one kind, and for a header; a file that fails is read as a whole by the usual reader, so the rows
are the same in any case.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.operators.sizing import small_or_whole, staged

QUOTE = '"'
MARK = "\x01"
OPTIONS = {"quote": QUOTE, "escape": QUOTE, "multiLine": "true"}
BOM = "﻿"


def whole_file_reader(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Header CSV whose quoted cells may hold line breaks and doubled quotes, one task per file."""
    return spark.read.csv(path, header=True, **OPTIONS)


def worth_splitting(spark: SparkSession, path: str) -> bool:
    """Whether some file is larger than a range; only names and sizes are read."""
    largest = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    return largest > size(spark.conf.get("spark.sql.files.maxPartitionBytes"))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Each line with its file, its range, and whether quotes before it in its range, and in itself, are odd in number."""
    source = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parity, place, begun = None, 0, 0, False
        for batch in batches:
            lines, starts = batch.column(0), batch.column(2).to_numpy()
            files = batch.column(1).to_pylist()
            odd = pc.count_substring(lines, QUOTE).to_numpy(zero_copy_only=False).astype(np.int64) & 1
            filled = pc.greater(pc.binary_length(pc.utf8_rtrim(lines, "\r")), 0).to_numpy(zero_copy_only=False)
            before, at, header = np.empty(len(odd), np.int64), np.empty(len(odd), np.int64), np.zeros(len(odd), bool)
            row = 0
            while row < len(odd):
                key = (files[row], starts[row])
                stop = row + 1
                while stop < len(odd) and starts[stop] == starts[row] and files[stop] == files[row]:
                    stop += 1
                if key != current:
                    current, parity, place, begun = key, 0, 0, False
                sums = np.cumsum(odd[row:stop])
                before[row:stop] = (parity + sums - odd[row:stop]) & 1
                at[row:stop] = place + np.arange(stop - row)
                if starts[row] == 0 and not begun and filled[row:stop].any():
                    header[row + int(filled[row:stop].argmax())] = begun = True
                parity, place, row = (parity + int(sums[-1])) & 1, place + stop - row, stop
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(at), pa.array(before.astype(np.int8)), pa.array(odd.astype(np.int8)), pa.array(header)],
                names=["value", "file", "start", "at", "before", "odd", "header"],
            )

    return source.mapInArrow(run, "value string, file string, start bigint, at bigint, before tinyint, odd tinyint, header boolean")


def _ranges(lines: DataFrame) -> DataFrame:
    """Per range of a file: whether it begins inside a cell; and whether the file's quotes are odd in number."""
    counts = lines.groupBy("file", "start").agg(F.sum("odd").alias("quotes"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.sum("quotes").over(Window.partitionBy("file"))
    return counts.select(
        F.col("file").alias("r_file"),
        F.col("start").alias("r_start"),
        F.pmod(F.coalesce(F.sum("quotes").over(earlier), F.lit(0)), F.lit(2)).alias("inside_at_start"),
        (whole % 2).alias("unclosed"),
    )


def _regular(line: Column, inside: Column, ends_inside: Column) -> Column:
    """Whether quotes of a line stand around whole cells only, and no carriage return but one at the end stands outside."""
    closed = F.concat(F.when(inside, QUOTE).otherwise(""), F.regexp_replace(line, r"\r\z", ""), F.when(ends_inside, QUOTE).otherwise(""))
    marked = F.regexp_replace(closed, r'"[^"]*+"', MARK)
    strange = marked.rlike(rf"[^,{MARK}]{MARK}|{MARK}[^,{MARK}]|\r")
    return ~strange & ~F.contains(line, F.lit(MARK)) & ~F.contains(line, F.lit(BOM))


def _records(lines: DataFrame) -> DataFrame:
    """``record`` and ``header`` of every record: whole lines as they are, pieces put together."""
    whole = lines.filter("NOT inside AND odd = 0").select(F.col("value").alias("record"), "header")
    pieces = lines.filter("inside OR odd = 1").select("value", "file", "start", "at", "header", (~F.col("inside")).alias("opens"))
    pieces = staged(pieces, "csv_pieces")
    order = Window.partitionBy("file", "start").orderBy("at")
    numbered = pieces.withColumn("opened", F.sum(F.col("opens").cast("int")).over(order))
    # pieces at the head of a range go on with the last record that an earlier range opened
    ranges = numbered.groupBy("file", "start").agg(F.max("opened").alias("last"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    home = F.last(F.when(F.col("last") > 0, F.struct("start", "last")), ignorenulls=True).over(earlier)
    homes = ranges.select(F.col("file").alias("h_file"), F.col("start").alias("h_start"), home.alias("home"))
    met = (F.col("file") == F.col("h_file")) & (F.col("start") == F.col("h_start"))
    owned = numbered.join(small_or_whole(homes), met).select(
        "file",
        F.when(F.col("opened") > 0, F.col("start")).otherwise(F.col("home.start")).alias("first"),
        F.when(F.col("opened") > 0, F.col("opened")).otherwise(F.col("home.last")).alias("number"),
        "start",
        "at",
        "value",
        "header",
    )
    joined = owned.groupBy("file", "first", "number").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("start", "at", "value")))["value"], "\n").alias("record"),
        F.max("header").alias("header"),
    )
    return whole.unionByName(joined.select("record", "header"))


def read_split_csv(spark: SparkSession, path: str) -> DataFrame:
    """The rows ``whole_file_reader`` gives, in any order, read by as many tasks as there are byte ranges."""
    columns = whole_file_reader(spark, path).schema
    lines = _lines(spark, path)
    ranges = staged(_ranges(lines), "csv_ranges")
    met = (F.col("file") == F.col("r_file")) & (F.col("start") == F.col("r_start"))
    placed = lines.join(small_or_whole(ranges), met).withColumn("inside", (F.col("before") + F.col("inside_at_start")) % 2 == 1)
    ends_inside = (F.col("inside").cast("int") + F.col("odd")) % 2 == 1
    ends_record = ~ends_inside & (F.length("value") > 0)
    returned = F.substring("value", -1, 1) == "\r"
    files = placed.groupBy("file").agg(
        F.coalesce(F.bool_and(_regular(F.col("value"), F.col("inside"), ends_inside)), F.lit(True)).alias("regular"),
        F.count_if(ends_record & returned).alias("with_return"),
        F.count_if(ends_record & ~returned).alias("without"),
        F.count_if(F.col("header")).alias("headers"),
        F.max("unclosed").alias("unclosed"),
    )
    fits = F.col("regular") & ((F.col("with_return") == 0) | (F.col("without") <= 1)) & (F.col("headers") == 1) & (F.col("unclosed") == 0)
    files = staged(files.select(F.col("file").alias("f_file"), fits.alias("fits"), (F.col("with_return") > 0).alias("returns")), "csv_files")
    odd_files = [r["f_file"] for r in files.filter("NOT fits").collect()]  # names of files, which the driver lists anyway
    # where carriage returns end the records, those before line breaks in cells belong to the breaks, too
    placed = placed.join(small_or_whole(files.filter("fits")), F.col("file") == F.col("f_file"))
    placed = placed.withColumn("value", F.when(F.col("returns"), F.regexp_replace("value", r"\r\z", "")).otherwise(F.col("value")))
    records = _records(placed).filter("NOT header AND record <> ''")
    ddl = ", ".join(f"`{c.replace('`', '``')}` STRING" for c in columns.names)
    parsed = F.from_csv("record", F.lit(ddl), OPTIONS)
    rows = records.select(parsed.alias("row")).select([F.col("row").getField(c).alias(c) for c in columns.names])
    return rows.unionByName(whole_file_reader(spark, odd_files)) if odd_files else rows
