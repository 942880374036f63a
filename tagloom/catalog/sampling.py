"""Queries on balancing, resampling, shuffling and sharding."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tagloom.catalog.registry import query
from tagloom.catalog.views import LAB, lab, table
from tagloom.functions.vectors import is_valid_vector
from tagloom.operators import sampling as ops
from tagloom.operators.labels import class_counts
from tagloom.operators.neighbors import vector_width
from tagloom.operators.selection import nth_values, top_n_selected
from tagloom.operators.sizing import staging_path

SHARDS = 8
SIZES = LAB + ", sizes AS (SELECT label, count(*) AS n FROM lab GROUP BY 1)"


@query("downsample_random")
def downsample_random(spark, sf):
    return ops.downsample(lab(spark, sf).select("doc_id", "label", "text"), "label", "doc_id")


@query("downsample_counts", f"WITH {SIZES} SELECT label, (SELECT min(n) FROM sizes) AS n FROM sizes")
def downsample_counts(spark, sf):
    return class_counts(ops.downsample(lab(spark, sf).select("doc_id", "label"), "label", "doc_id"))


@query("upsample_random")
def upsample_random(spark, sf):
    return ops.upsample(lab(spark, sf).select("doc_id", "label", "text"), "label", "doc_id")


@query(
    "upsample_counts",
    f"WITH {SIZES} SELECT CAST(max(n) * count(*) AS BIGINT) AS rows, count(*) AS classes FROM sizes",
)
def upsample_counts(spark, sf):
    drawn = ops.upsample(lab(spark, sf).select("doc_id", "label"), "label", "doc_id")
    return drawn.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("label").alias("classes"))


@query("shuffle_rows", f"WITH {LAB} SELECT doc_id, label FROM lab")
def shuffle_rows(spark, sf):
    return ops.shuffled(lab(spark, sf).select("doc_id", "label"), "doc_id")


ASSIGNED = f"""assigned AS (
  SELECT doc_id, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / ceil(count(*) OVER () / {SHARDS}.0)) AS INTEGER) AS shard_id
  FROM documents)"""


def _assigned(spark, sf):
    return ops.assign_shards(table(spark, sf, "documents").select("doc_id", "text"), SHARDS, "doc_id")


@query("shard_assignment", f"WITH {ASSIGNED} SELECT doc_id, shard_id FROM assigned")
def shard_assignment(spark, sf):
    return _assigned(spark, sf).select("doc_id", "shard_id")


@query(
    "sharded_write",
    f"WITH {ASSIGNED} SELECT shard_id, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id FROM assigned GROUP BY 1",
)
def sharded_write(spark, sf):
    """Write half of the shards, resume with the whole table, and read back what the folder then holds."""
    path = staging_path(spark, "shards")
    assigned = _assigned(spark, sf)
    ops.write_shards(assigned.filter(F.col("shard_id") < SHARDS // 2), path)
    ops.write_shards(assigned, path, resume=True)
    return spark.read.parquet(path).groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")
    )


@query("resume_pending", f"WITH {ASSIGNED} SELECT doc_id, shard_id FROM assigned WHERE shard_id >= {SHARDS // 2}")
def resume_pending(spark, sf):
    path = staging_path(spark, "finished")
    assigned = _assigned(spark, sf)
    ops.write_shards(assigned.filter(F.col("shard_id") < SHARDS // 2), path)
    return ops.pending_shards(assigned, spark.read.parquet(path)).select("doc_id", "shard_id")


@query("sample_limit", "SELECT vec_id, label FROM embeddings WHERE embedding IS NOT NULL ORDER BY vec_id LIMIT 300")
def sample_limit(spark, sf):
    """Fitting stops after a given number of valid vectors; the limit is the operator."""
    rows = table(spark, sf, "embeddings")
    valid = rows.filter(is_valid_vector(F.col("embedding"), vector_width(rows, "embedding")))
    return ops.first_n(valid, 300, "vec_id").select("vec_id", "label")


@query(
    "downsample_is_a_subset",
    f"""WITH {SIZES} SELECT CAST((SELECT min(n) * count(*) FROM sizes) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS repeated, CAST(0 AS BIGINT) AS altered""",
)
def downsample_is_a_subset(spark, sf):
    """Kept rows are rows of the table, once each and unchanged."""
    rows = lab(spark, sf).select("doc_id", "label")
    kept = ops.downsample(rows, "label", "doc_id").groupBy("doc_id", "label").agg(F.count(F.lit(1)).alias("n"))
    met = kept.join(rows.withColumn("there", F.lit(True)), ["doc_id", "label"], "left")
    return met.agg(F.sum("n").alias("rows"), F.sum(F.col("n") - 1).alias("repeated"), F.count_if(F.col("there").isNull()).alias("altered"))


@query(
    "upsample_is_fair",
    f"""WITH {SIZES} SELECT label, TRUE AS near_its_share, CAST(0 AS BIGINT) AS altered FROM sizes""",
)
def upsample_is_fair(spark, sf):
    """Each class gets its share of draws within five standard deviations, all of them rows of the table."""
    rows = lab(spark, sf).select("doc_id", "label")
    drawn = ops.upsample(rows, "label", "doc_id").groupBy("doc_id", "label").agg(F.count(F.lit(1)).alias("n"))
    met = drawn.join(rows.withColumn("there", F.lit(True)), ["doc_id", "label"], "left")
    by_label = met.groupBy("label").agg(F.sum("n").alias("n"), F.count_if(F.col("there").isNull()).alias("altered"))
    whole = Window.partitionBy(F.lit(1))  # a row for each class
    share, total = 1 / F.count(F.lit(1)).over(whole), F.sum("n").over(whole)
    near = F.abs(F.col("n") - share * total) <= 5 * F.sqrt(total * share * (1 - share))
    return by_label.select("label", near.alias("near_its_share"), "altered")


@query(
    "top_n_selected",
    """SELECT doc_id, source, n_chars FROM documents
    QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) <= 20""",
)
def longest_of_sources(spark, sf):
    """The twenty longest documents of each source, by cut-offs found without sorting; the limit is the operator."""
    rows = table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    return top_n_selected(rows, "source", 20, "n_chars", "doc_id", last=10)


@query(
    "median_lengths",
    """SELECT source, (count(*) + 1) // 2 AS rank, CAST(quantile_disc(n_chars, 0.5) AS BIGINT) AS value FROM documents GROUP BY source""",
)
def median_lengths(spark, sf):
    rows = table(spark, sf, "documents").select("source", F.col("n_chars").cast("bigint").alias("n_chars"))
    ranks = rows.groupBy("source").agg(F.expr("(count(*) + 1) div 2").alias("rank"))
    return nth_values(rows, ranks, "source", "n_chars", last=10).select("source", "rank", "value")
