"""Queries on vectors, probabilities, centroids and neighbours."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tagloom.catalog.metrics import scores_sql
from tagloom.catalog.registry import query
from tagloom.catalog.views import BANK, CENTERS, EMBEDDING_PROBS, bank_and_validation, class_centers, embedding_probs, table
from tagloom.functions import vectors as vec
from tagloom.operators import neighbors as ops
from tagloom.operators.pivots import pivot_neighbors
from tagloom.operators.scoring import prediction_record
from tagloom.operators.sizing import staging_path
from tagloom.plans.clusters import fit_clusters, fit_pca, label_map_job, purity_job, transform_pca
from tagloom.plans.evaluate import evaluate_embeddings
from tagloom.sources.tables import centroid_table, read_shards, rows_in_shards, write_table

CLASSES = [f"class_{i}" for i in range(10)]


@query(
    "vector_valid_counts",
    """SELECT len(embedding) AS width, count(*) AS n, count(*) FILTER (len(list_filter(embedding, lambda x: x IS NULL)) = 0) AS valid
    FROM embeddings GROUP BY 1""",
)
def vector_valid_counts(spark, sf):
    rows = table(spark, sf, "embeddings")
    valid = vec.is_valid_vector(F.col("embedding"), ops.vector_width(rows, "embedding"))
    return rows.groupBy(F.size("embedding").cast("bigint").alias("width")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(valid).alias("valid")
    )


@query(
    "l2_normalized",
    """SELECT vec_id, CAST(i - 1 AS BIGINT) AS dim, round(x, 6) AS x FROM (
      SELECT vec_id, generate_subscripts(v, 1) AS i, unnest(list_transform(v, lambda x: x / greatest(norm, 1e-12))) AS x FROM (
        SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm
        FROM (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * (vec_id + 1)) AS v FROM embeddings)))""",
)
def l2_normalized(spark, sf):
    stretched = F.transform("embedding", lambda x: x.cast("double") * (F.col("vec_id") + 1))
    unit = table(spark, sf, "embeddings").select("vec_id", F.posexplode(vec.l2_normalize(stretched)).alias("dim", "x"))
    return unit.select("vec_id", F.col("dim").cast("bigint").alias("dim"), F.round("x", 6).alias("x"))


@query(
    "vector_scores",
    f"""WITH {CENTERS}
    SELECT vec_id, round(list_inner_product(CAST(embedding AS DOUBLE[]), center), 6) AS dot,
           round(list_distance(CAST(embedding AS DOUBLE[]), center), 6) AS distance
    FROM embeddings JOIN cen ON label = cluster_id""",
)
def vector_scores(spark, sf):
    own = table(spark, sf, "embeddings").join(class_centers(spark, sf), F.col("label") == F.col("cluster_id"))
    a, b = F.col("embedding"), F.col("center")
    return own.select("vec_id", F.round(vec.dot(a, b), 6).alias("dot"), F.round(vec.l2_distance(a, b), 6).alias("distance"))


@query(
    "softmax_probs",
    f"""WITH {EMBEDDING_PROBS}
    SELECT vec_id, CAST(i - 1 AS BIGINT) AS class, round(p, 6) AS p
    FROM (SELECT vec_id, generate_subscripts(probs, 1) AS i, unnest(probs) AS p FROM probs)""",
)
def softmax_probs(spark, sf):
    rows = embedding_probs(spark, sf).select("vec_id", F.posexplode("probs").alias("class", "p"))
    return rows.select("vec_id", F.col("class").cast("bigint").alias("class"), F.round("p", 6).alias("p"))


@query("max_prob", f"WITH {EMBEDDING_PROBS} SELECT vec_id, round(list_max(probs), 6) AS max_prob FROM probs")
def max_prob(spark, sf):
    return embedding_probs(spark, sf).select("vec_id", F.round(vec.max_prob(F.col("probs")), 6).alias("max_prob"))


@query(
    "argmax_label",
    f"""WITH {EMBEDDING_PROBS}
    SELECT vec_id, CAST(list_position(probs, list_max(probs)) - 1 AS BIGINT) AS label,
           'class_' || (list_position(probs, list_max(probs)) - 1) AS name FROM probs""",
)
def argmax_label(spark, sf):
    index = vec.argmax(F.col("probs"))
    return embedding_probs(spark, sf).select("vec_id", index.alias("label"), vec.class_name(index, CLASSES).alias("name"))


_CELLS = ", ".join(f"round(probs[{i + 1}], 4) AS {c}" for i, c in enumerate(CLASSES))


@query(
    "prediction_record",
    f"WITH {EMBEDDING_PROBS} SELECT vec_id, 'class_' || (list_position(probs, list_max(probs)) - 1) AS prediction, {_CELLS} FROM probs",
)
def prediction_records(spark, sf):
    return prediction_record(embedding_probs(spark, sf), CLASSES, keep=["vec_id"])


@query(
    "nearest_centroid",
    f"""WITH {CENTERS}
    SELECT vec_id, cluster_id FROM (
      SELECT vec_id, cluster_id, row_number() OVER (
        PARTITION BY vec_id ORDER BY list_distance(CAST(embedding AS DOUBLE[]), center), cluster_id) AS r
      FROM embeddings CROSS JOIN cen) WHERE r = 1""",
)
def nearest_centroid(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return ops.assign_nearest_centroid(rows, class_centers(spark, sf), vector="embedding").select("vec_id", "cluster_id")


@query(
    "nearest_centroid_tiny",
    f"""WITH {CENTERS}
    SELECT vec_id, cluster_id FROM (
      SELECT vec_id, cluster_id, row_number() OVER (
        PARTITION BY vec_id ORDER BY list_distance(CAST(embedding AS DOUBLE[]), center), cluster_id) AS r
      FROM embeddings CROSS JOIN cen) WHERE r = 1""",
)
def nearest_centroid_tiny(spark, sf):
    """Vectors and centroids a ten-millionth as long have the same neighbours."""
    shrunk = lambda c: F.transform(c, lambda x: x.cast("double") * 1e-7)
    rows = table(spark, sf, "embeddings").select("vec_id", shrunk("embedding").alias("embedding"))
    centers = class_centers(spark, sf).withColumn("center", shrunk("center"))
    return ops.assign_nearest_centroid(rows, centers, vector="embedding").select("vec_id", "cluster_id")


@query(
    "invalid_vectors",
    f"""WITH {CENTERS},
    near AS (SELECT vec_id, cluster_id FROM (
      SELECT vec_id, cluster_id, row_number() OVER (
        PARTITION BY vec_id ORDER BY list_distance(CAST(embedding AS DOUBLE[]), center), cluster_id) AS r
      FROM embeddings CROSS JOIN cen) WHERE r = 1)
    SELECT CASE WHEN vec_id % 50 < 3 THEN -1 ELSE cluster_id END AS cluster_id, count(*) AS n FROM near GROUP BY 1""",
)
def invalid_vectors(spark, sf):
    """Every fiftieth vector gets an element that is no number, the next ones an infinite and a missing one."""
    odd = F.get(F.array(F.lit(float("nan")), F.lit(float("inf")), F.lit(None)), (F.col("vec_id") % 50).cast("int")).cast("float")
    spoilt = F.concat(F.array(odd), F.slice("embedding", 2, 1_000_000))
    vector = F.when(F.col("vec_id") % 50 < 3, spoilt).otherwise(F.col("embedding"))
    rows = table(spark, sf, "embeddings").select("vec_id", vector.alias("embedding"))
    near = ops.assign_nearest_centroid(rows, class_centers(spark, sf), vector="embedding")
    return near.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "cluster_chain",
    f"""WITH {CENTERS},
    near AS (SELECT vec_id, label, cluster_id FROM (
      SELECT vec_id, e.label, cluster_id, row_number() OVER (
        PARTITION BY vec_id ORDER BY list_distance(CAST(embedding AS DOUBLE[]), center), cluster_id) AS r
      FROM embeddings e CROSS JOIN cen) WHERE r = 1),
    counts AS (SELECT cluster_id, label, count(*) AS n FROM near GROUP BY 1, 2)
    SELECT cen.cluster_id, CAST(coalesce(sum(n), 0) AS BIGINT) AS n, round(max(n) / CAST(sum(n) AS DOUBLE), 6) AS purity,
      CAST(arg_max(label, n * 1000 - label) AS BIGINT) AS label
    FROM cen LEFT JOIN counts ON counts.cluster_id = cen.cluster_id GROUP BY 1""",
)
def cluster_chain(spark, sf):
    """The stages as they follow each other over files: shards, assignment, purity, label map, each read back."""
    root = staging_path(spark, "chain")
    write_table(table(spark, sf, "embeddings").select("vec_id", "embedding", "label"), f"{root}/shards")
    write_table(class_centers(spark, sf), f"{root}/centroids")
    rows = read_shards(spark, f"{root}/shards", ["vec_id", "embedding", "label"])
    assigned = ops.assign_nearest_centroid(rows, read_shards(spark, f"{root}/centroids"), vector="embedding")
    write_table(assigned.select("vec_id", "label", "cluster_id"), f"{root}/assigned")
    if rows_in_shards(spark, f"{root}/assigned") != rows_in_shards(spark, f"{root}/shards"):
        raise RuntimeError("the assignment lost rows")
    clustered = read_shards(spark, f"{root}/assigned")
    purity_job(clustered, read_shards(spark, f"{root}/centroids"), label="label", output_path=f"{root}/purity")
    rated = read_shards(spark, f"{root}/purity", ["cluster_id", "purity"])
    majority = label_map_job(clustered, exclude_invalid=True)
    sizes = clustered.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    joined = rated.join(sizes, "cluster_id", "left").join(majority, "cluster_id", "left")
    return joined.select(
        "cluster_id",
        F.coalesce("n", F.lit(0)).alias("n"),
        F.round("purity", 6).alias("purity"),
        F.col("label").cast("bigint").alias("label"),
    )


def topk_sql(k: int, score: str, order: str) -> str:
    return f"""near AS (
      SELECT * FROM (
        SELECT val.val_id, bank.vec_id, val.label AS query_label, bank.label AS bank_label, {score} AS score,
               row_number() OVER (PARTITION BY val.val_id ORDER BY {score} {order}, bank.vec_id) AS rank
        FROM val CROSS JOIN bank) WHERE rank <= {k})"""


COS = ("list_inner_product(val.embedding, bank.embedding)", "DESC")
L2 = ("list_distance(val.embedding, bank.embedding)", "ASC")


def _neighbors(spark, sf, k, distance="cos"):
    bank, val = bank_and_validation(spark, sf)
    return ops.neighbor_labels(val, bank, k, distance=distance)


@query("knn_topk", f"WITH {BANK}, {topk_sql(10, *COS)} SELECT val_id, vec_id, rank, round(score, 6) AS score FROM near")
def knn_topk(spark, sf):
    bank, val = bank_and_validation(spark, sf)
    near = ops.nearest_neighbors(val, bank, 10)
    return near.select("val_id", "vec_id", "rank", F.round("score", 6).alias("score"))


@query("knn_topk_l2", f"WITH {BANK}, {topk_sql(10, *L2)} SELECT val_id, vec_id, rank, round(score, 6) AS score FROM near")
def knn_topk_l2(spark, sf):
    bank, val = bank_and_validation(spark, sf)
    near = ops.nearest_neighbors(val, bank, 10, distance="l2")
    return near.select("val_id", "vec_id", "rank", F.round("score", 6).alias("score"))


@query("knn_pivots", f"WITH {BANK}, {topk_sql(10, *L2)} SELECT val_id, vec_id, rank, round(score, 6) AS score FROM near")
def knn_pivots(spark, sf):
    bank, val = bank_and_validation(spark, sf)
    return pivot_neighbors(val, bank, 10).neighbors.select("val_id", "vec_id", "rank", F.round("score", 6).alias("score"))


@query(
    "recall_at_k",
    f"""WITH {BANK}, {topk_sql(100, *COS)},
    first AS (SELECT val_id, min(CASE WHEN query_label = bank_label THEN rank END) AS first FROM near GROUP BY 1)
    SELECT CAST(k AS BIGINT) AS k, round(avg(CASE WHEN first <= k THEN 1.0 ELSE 0.0 END), 6) AS recall
    FROM first CROSS JOIN (VALUES (1), (10), (100)) ks(k) GROUP BY k""",
)
def recall_at_k(spark, sf):
    return ops.recall_at_k(_neighbors(spark, sf, 100), [1, 10, 100]).withColumn("recall", F.round("recall", 6))


VOTES = """votes AS (
  SELECT query_label AS label, bank_label AS pred FROM (
    SELECT val_id, query_label, bank_label, count(*) AS n FROM near GROUP BY 1, 2, 3)
  QUALIFY row_number() OVER (PARTITION BY val_id ORDER BY n DESC, bank_label) = 1)"""


@query(
    "knn_macro_f1",
    f"WITH {BANK}, {topk_sql(10, *COS)}, {VOTES}, {scores_sql('votes')} SELECT round(f1, 6) AS knn_macro_f1 FROM macro",
)
def knn_macro_f1(spark, sf):
    f1 = ops.knn_macro_f1(_neighbors(spark, sf, 10), 10)
    return f1.withColumn("knn_macro_f1", F.round("knn_macro_f1", 6))


@query(
    "embedding_bank_last_n",
    f"""WITH {BANK}
    SELECT vec_id, batch_id, label FROM bank
    WHERE batch_id IN (SELECT DISTINCT batch_id FROM bank ORDER BY batch_id DESC LIMIT 3)""",
)
def embedding_bank_last_n(spark, sf):
    """Retention of the last batches; the limit is the operator."""
    bank, _ = bank_and_validation(spark, sf)
    return ops.last_batches(bank, 3).select("vec_id", "batch_id", "label")


@query(
    "embedding_evaluation",
    f"""WITH {BANK.replace("bank AS (", "whole_bank AS (")},
    bank AS (SELECT * FROM whole_bank
      WHERE batch_id IN (SELECT DISTINCT batch_id FROM whole_bank ORDER BY batch_id DESC LIMIT 10)),
    {topk_sql(10, *COS)}, {VOTES}, {scores_sql('votes')},
    first AS (SELECT val_id, min(CASE WHEN query_label = bank_label THEN rank END) AS first FROM near GROUP BY 1)
    SELECT 'recall_at_' || k AS name, round(avg(CASE WHEN first <= k THEN 1.0 ELSE 0.0 END), 6) AS value
    FROM first CROSS JOIN (VALUES (1), (10)) ks(k) GROUP BY k
    UNION ALL SELECT 'knn_macro_f1', round(f1, 6) FROM macro""",
)
def embedding_evaluation(spark, sf):
    bank, val = (side.withColumn("metric_mask", F.lit(1)) for side in bank_and_validation(spark, sf))
    return evaluate_embeddings(val, bank, ks=[1, 10]).withColumn("value", F.round("value", 6))


@query("pca_transform")
def pca_transform(spark, sf):
    rows = table(spark, sf, "embeddings")
    return transform_pca(rows, fit_pca(rows, "embedding", 50), "embedding").select("vec_id", "label", "pca")


@query(
    "pca_total_variance",
    """SELECT count(*) AS n, round(sum(v), 6) AS total_variance FROM (
      SELECT i, var_samp(x) AS v FROM (
        SELECT generate_subscripts(embedding, 1) AS i, unnest(list_transform(CAST(embedding AS DOUBLE[]),
          lambda x: x / sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda y: y * y))))) AS x FROM embeddings) GROUP BY i)""",
)
def pca_total_variance(spark, sf):
    """With every component kept, the components carry the whole variance of the normalised vectors."""
    rows = table(spark, sf, "embeddings")
    model = fit_pca(rows, "embedding", ops.vector_width(rows, "embedding"))
    coords = transform_pca(rows, model, "embedding").select(F.posexplode("pca").alias("i", "x"))
    variances = coords.groupBy("i").agg(F.var_samp("x").alias("v"))
    return variances.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("v"), 6).alias("total_variance"))


@query("kmeans_assign")
def kmeans_assign(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").alias("pca"))
    centers = fit_clusters(rows, "pca", n_clusters=10, max_iter=20).clusterCenters()
    return ops.assign_nearest_centroid(rows, centroid_table(spark, centers)).select("vec_id", "label", "cluster_id")


@query("kmeans_nearest", "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS closer_elsewhere FROM embeddings")
def kmeans_nearest(spark, sf):
    """Of fitted clusters it holds that no vector lies closer to another centre than to its own."""
    rows = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("pca"))
    centers = centroid_table(spark, fit_clusters(rows, "pca", n_clusters=10, max_iter=20).clusterCenters())
    assigned = ops.assign_nearest_centroid(rows, centers)
    own = F.broadcast(centers.select("cluster_id", F.col("center").alias("own")))  # ten rows, as asked for
    every = F.broadcast(centers.agg(F.collect_list("center").alias("centers")).withColumn("one", F.lit(1)))
    met = assigned.join(own, "cluster_id", "left").withColumn("one", F.lit(1)).join(every, "one")
    gaps = F.transform("centers", lambda c: vec.l2_distance(F.col("pca"), c))
    closer = F.array_min(gaps) < vec.l2_distance(F.col("pca"), F.col("own")) - 1e-9
    return met.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce(closer, F.lit(True))).alias("closer_elsewhere"))


@query(
    "pca_centred",
    "SELECT CAST(i AS BIGINT) AS component, count(*) AS n, 0.0::DOUBLE AS mean, TRUE AS in_order FROM embeddings, range(50) r(i) GROUP BY 1",
)
def pca_centred(spark, sf):
    """Every component has mean zero, and none varies more than the one before it."""
    rows = table(spark, sf, "embeddings")
    reduced = transform_pca(rows, fit_pca(rows, "embedding", 50), "embedding").select(F.posexplode("pca").alias("i", "x"))
    sums = reduced.groupBy("i").agg(F.count("x").alias("n"), F.avg("x").alias("mean"), F.var_samp("x").alias("v"))
    before = F.lag("v").over(Window.partitionBy(F.lit(1)).orderBy("i"))  # fifty rows, one for each component
    in_order = F.coalesce(F.col("v") <= before + 1e-12, F.lit(True))
    return sums.select(F.col("i").cast("bigint").alias("component"), "n", (F.round("mean", 6) + 0.0).alias("mean"), in_order.alias("in_order"))
