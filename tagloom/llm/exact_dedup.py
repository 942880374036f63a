"""Exact dedup by content sort, in DataFrame operations only.

Rows are range-partitioned by sampled splitters over their normalised content, sorted by Spark's external sort so
that equal contents lie next to each other, and numbered where the whole content of neighbours is equal.

* Splitters are the first ``LEAD`` characters and a 64-bit hash of the content. Equal contents always share them,
  and the driver's sample holds short keys instead of whole texts. Contents are still compared in full.
* A content with more than 1 in ``HOT_PARTS`` of all rows, of which there are fewer than ``HOT_PARTS``, is dealt out
  over slices that are sorted apart. Its size and the row that stays come from a count that is combined before its
  shuffle, one row per content and task.

Empty tables give empty results. Null texts count as empty. A null key sorts after all others. Of rows that repeat a
key and a content at the head of a group, one is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAD = 32
HOT_PARTS = 256
MIN_HOT_ROWS = 64
BLANKS = "[ \\x09-\\x0D]"
ADDED = ("keep_id", "group_size", "kept", "text_sha256")


def normalised(text: Column) -> Column:
    """The text without its ``[\\x20\\x09-\\x0D]`` characters; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, "")


def _first(key: Column) -> list[Column]:
    """Order in which the first row of a group is the one that stays."""
    return [F.col("_chars").desc(), key.asc_nulls_last()]


def _hot(rows: DataFrame, key: Column, content: Column, min_rows: int) -> tuple[DataFrame, DataFrame] | None:
    """Hashes that need slices, and size and head of each of their groups; None where there are no such hashes."""
    total = rows.count()
    counts = rows.groupBy("_hash").agg(F.count("*").alias("_n")).filter(F.col("_n") >= max(min_rows, total // HOT_PARTS + 1))
    found = counts.collect()  # fewer than HOT_PARTS hashes, each stands for more than one in HOT_PARTS of the rows
    if not found:
        return None
    spark = rows.sparkSession
    slices = [(r["_hash"], max(2, -(-r["_n"] * HOT_PARTS // total))) for r in found]
    hashes = F.broadcast(spark.createDataFrame(slices, "_hash bigint, _slices int"))
    # the largest of (length, rank of the key) comes as the smallest of (-length, key is null, key)
    best = F.min(F.struct((-F.col("_chars")).alias("c"), key.isNull().alias("z"), key.alias("k")))
    groups = (
        rows.join(hashes, "_hash")
        .groupBy("_hash", content.alias("_content"))
        .agg(F.count("*").alias("_size"), best.alias("_best"))
    )
    return hashes, groups.select(
        "_hash",
        F.sha2("_content", 256).alias("_digest"),
        "_size",
        F.col("_best.k").alias("_head"),
        (-F.col("_best.c")).alias("_head_chars"),
    )


def mark_copies(df: DataFrame, key: str = "doc_id", text: str = "text", min_hot_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """All rows with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of their group of equal contents.

    The row with the most code points stays, then the one with the smallest key. Columns of these names in ``df`` are
    replaced. ``_`` names are reserved for work columns.
    """
    added = {c.lower() for c in ADDED}
    own = [c for c in df.columns if c.lower() not in added and not c.startswith("_")]
    if key not in own or text not in own:
        raise ValueError(f"the table needs its columns {key} and {text}")
    body = F.col(f"`{text}`").cast("string")
    content = normalised(body)
    rows = df.select(
        *[df[f"`{c}`"] for c in own],
        F.coalesce(F.length(body), F.lit(0)).alias("_chars"),
        F.substring(content, 1, LEAD).alias("_lead"),
        F.xxhash64(content).alias("_hash"),
    )
    id_ = F.col(f"`{key}`")
    hot = _hot(rows, id_, content, min_hot_rows)
    if hot is None:
        sliced, parts = rows, ["_lead", "_hash"]
    else:
        hashes, groups = hot
        slot = F.pmod(F.xxhash64(id_.cast("string")), F.col("_slices")).cast("int")
        parts = ["_lead", "_hash", "_slice"]
        sliced = rows.join(hashes, "_hash", "left").withColumn("_slice", F.coalesce(slot, F.lit(-1))).drop("_slices")

    # ranges of these columns hold whole groups of them and the content, so the sort needs no other shuffle
    placed = sliced.repartitionByRange(*parts).withColumn("_content", content)
    group = Window.partitionBy(*parts, "_content").orderBy(*_first(id_))
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marked = placed.select(
        *[f"`{c}`" for c in own],
        "_hash",
        "_chars",
        F.first(id_).over(whole).alias("keep_id"),
        F.count(F.lit(1)).over(whole).alias("group_size"),
        F.row_number().over(group).alias("_place"),
        F.sha2("_content", 256).alias("text_sha256"),
    )
    kept = F.col("_place") == 1
    if hot is not None:
        whole_group = F.broadcast(groups.withColumnRenamed("_digest", "text_sha256"))
        marked = marked.join(whole_group, ["_hash", "text_sha256"], "left")
        sliced_away = F.col("_size").isNotNull()
        heads = (F.col("_chars") == F.col("_head_chars")) & id_.eqNullSafe(F.col("_head"))
        kept = kept & (~sliced_away | heads)
        marked = marked.withColumn("keep_id", F.when(sliced_away, F.col("_head")).otherwise(F.col("keep_id"))).withColumn(
            "group_size", F.coalesce("_size", "group_size")
        )
    return marked.withColumn("kept", kept).select(*[f"`{c}`" for c in own], *ADDED)


def drop_copies(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with the columns they came with (columns named as those of ``mark_copies`` go)."""
    return mark_copies(df, key, text).filter("kept").drop(*ADDED)
