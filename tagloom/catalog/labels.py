"""Queries on cluster purity, label maps, dictionaries and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.catalog.registry import query
from tagloom.catalog.views import LAB, clustered_documents, lab, table
from tagloom.functions.casts import as_integer
from tagloom.operators import labels as ops
from tagloom.plans.clusters import label_map_job, purity_job
from tagloom.sources.tables import concat_tables

COUNTS = LAB + ", counts AS (SELECT cluster_id, label, count(*) AS n FROM lab WHERE cluster_id IS NOT NULL GROUP BY 1, 2)"
PURITY = COUNTS + ", purity AS (SELECT cluster_id, max(n) / CAST(sum(n) AS DOUBLE) AS purity FROM counts GROUP BY 1)"
MAJORITY = (
    COUNTS
    + """, majority AS (
  SELECT cluster_id, label FROM counts
  QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, label) = 1)"""
)
CENTROIDS = """, cents AS (
  SELECT TRY_CAST(substr(source, 4) AS BIGINT) AS cluster_id, avg(n_chars) AS mean_chars FROM documents GROUP BY 1)"""


def document_centroids(spark, sf):
    documents = table(spark, sf, "documents")
    cluster = F.substring("source", 4, 10).try_cast("bigint")
    return documents.groupBy(cluster.alias("cluster_id")).agg(F.avg("n_chars").alias("mean_chars"))


@query("cluster_label_counts", f"WITH {COUNTS} SELECT cluster_id, CAST(label AS BIGINT) AS label, n FROM counts")
def cluster_label_counts(spark, sf):
    return ops.cluster_label_counts(lab(spark, sf), whole_labels=True)


@query(
    "incomplete_rows",
    """SELECT count(*) AS total_rows, count(*) FILTER (l.quality IS NULL) AS dropped_rows
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def incomplete_rows(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    documents = clustered_documents(table(spark, sf, "documents")).select("doc_id", "cluster_id")
    return ops.incomplete_rows(documents.join(labels, "doc_id", "left"))


@query("cluster_purity", f"WITH {PURITY} SELECT cluster_id, round(purity, 6) AS purity FROM purity")
def cluster_purity(spark, sf):
    return ops.cluster_purity(lab(spark, sf)).withColumn("purity", F.round("purity", 6))


@query(
    "centroid_purity",
    f"""WITH {PURITY} {CENTROIDS}
    SELECT cents.cluster_id, round(mean_chars, 4) AS mean_chars, round(purity, 6) AS purity
    FROM cents LEFT JOIN purity ON cents.cluster_id = purity.cluster_id""",
)
def centroid_purity(spark, sf):
    rated = purity_job(lab(spark, sf), document_centroids(spark, sf), label="label")
    return rated.select("cluster_id", F.round("mean_chars", 4).alias("mean_chars"), F.round("purity", 6).alias("purity"))


@query(
    "centroids_without_purity",
    f"""WITH {LAB} {CENTROIDS}
    SELECT cluster_id FROM cents
    WHERE NOT EXISTS (SELECT 1 FROM lab WHERE lab.toxic = 1 AND lab.cluster_id = cents.cluster_id)""",
)
def centroids_without_purity(spark, sf):
    purity = ops.cluster_purity(lab(spark, sf).filter("toxic = 1"))
    return ops.centroids_without_purity(document_centroids(spark, sf), purity)


@query("cluster_label_map", f"WITH {MAJORITY} SELECT cluster_id, CAST(label AS BIGINT) AS label FROM majority")
def cluster_label_map(spark, sf):
    return label_map_job(lab(spark, sf))


@query(
    "cluster_label_lookup",
    f"""WITH {MAJORITY}
    SELECT d.doc_id, TRY_CAST(substr(d.source, 4) AS BIGINT) AS cluster_id, CAST(m.label AS BIGINT) AS label
    FROM documents d LEFT JOIN majority m ON m.cluster_id = TRY_CAST(substr(d.source, 4) AS BIGINT)""",
)
def cluster_label_lookup(spark, sf):
    rows = clustered_documents(table(spark, sf, "documents")).select("doc_id", "cluster_id")
    return ops.label_lookup(rows, ops.majority_labels(lab(spark, sf))).select("doc_id", "cluster_id", "label")


@query("class_distribution", "SELECT event_type AS label, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def class_distribution(spark, sf):
    return ops.class_counts(table(spark, sf, "events").withColumnRenamed("event_type", "label"))


@query(
    "min_class_size",
    "SELECT min(n) AS smallest, max(n) AS largest, count(*) AS classes FROM (SELECT count(*) AS n FROM events GROUP BY event_type)",
)
def min_class_size(spark, sf):
    sizes = ops.class_counts(table(spark, sf, "events"), "event_type")
    return sizes.agg(F.min("n").alias("smallest"), F.max("n").alias("largest"), F.count(F.lit(1)).alias("classes"))


@query(
    "label_dictionary",
    """SELECT label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS label_id
    FROM (SELECT DISTINCT event_type AS label FROM events)""",
)
def label_dictionary(spark, sf):
    return ops.label_dictionary([table(spark, sf, "events").withColumnRenamed("event_type", "label")])


@query(
    "label_dictionary_whole",
    """SELECT label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS label_id
    FROM (SELECT CAST(label AS BIGINT) AS label FROM embeddings UNION SELECT TRY_CAST(substr(source, 4) AS BIGINT) FROM documents)""",
)
def label_dictionary_whole(spark, sf):
    clusters = clustered_documents(table(spark, sf, "documents")).withColumnRenamed("cluster_id", "label")
    return ops.label_dictionary([table(spark, sf, "embeddings"), clusters], whole=True)


DICTIONARY = """dict AS (
  SELECT label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS label_id
  FROM (SELECT DISTINCT event_type AS label FROM events))"""


@query(
    "encode_labels",
    f"WITH {DICTIONARY} SELECT event_id, label, label_id FROM events JOIN dict ON event_type = label",
)
def encode_labels(spark, sf):
    events = table(spark, sf, "events").select("event_id", F.col("event_type").alias("label"))
    return ops.encode_labels(events, ops.label_dictionary([events])).select("event_id", "label", "label_id")


@query(
    "decode_labels",
    f"WITH {DICTIONARY} SELECT label_id, label, count(*) AS n FROM events JOIN dict ON event_type = label GROUP BY 1, 2",
)
def decode_labels(spark, sf):
    events = table(spark, sf, "events").select(F.col("event_type").alias("label"))
    dictionary = ops.label_dictionary([events])
    ids = ops.encode_labels(events, dictionary).select("label_id")
    return ops.decode_labels(ids, dictionary).groupBy("label_id", "label").agg(F.count(F.lit(1)).alias("n"))


@query("num_classes", "SELECT count(DISTINCT event_type) AS num_classes FROM events")
def num_classes(spark, sf):
    dictionary = ops.label_dictionary([table(spark, sf, "events").withColumnRenamed("event_type", "label")])
    return dictionary.agg(F.count_distinct("label").alias("num_classes"))


@query(
    "remap_predictions",
    """SELECT vec_id, label, CAST(mapped AS BIGINT) AS mapped FROM embeddings JOIN (VALUES
      (0, 2), (1, 0), (2, 0), (3, 1), (4, 1), (5, 2), (6, 0), (7, 1), (8, 2), (9, 0)) m(pred, mapped) ON label = pred""",
)
def remap_predictions(spark, sf):
    mapping = {0: 2, 1: 0, 2: 0, 3: 1, 4: 1, 5: 2, 6: 0, 7: 1, 8: 2, 9: 0}
    rows = table(spark, sf, "embeddings").select("vec_id", "label")
    return ops.remap_predictions(rows, mapping, "label")


@query(
    "whole_number_casts",
    """SELECT page_id, TRY_CAST(seg AS BIGINT) AS number
    FROM (SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS seg FROM pages) WHERE TRY_CAST(seg AS BIGINT) IS NOT NULL""",
)
def whole_number_casts(spark, sf):
    last = F.regexp_extract("url", "([^/]*)$", 1)
    numbers = table(spark, sf, "pages").select("page_id", as_integer(last).alias("number"))
    return numbers.filter(F.col("number").isNotNull())


@query(
    "all_labels",
    """SELECT label, count(*) AS n FROM (
      SELECT quality AS label FROM labels UNION ALL SELECT label FROM embeddings) GROUP BY 1""",
)
def all_labels(spark, sf):
    parts = [table(spark, sf, "labels").select(F.col("quality").alias("label")), table(spark, sf, "embeddings").select("label")]
    return ops.class_counts(concat_tables(parts))
