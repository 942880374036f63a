"""Queries on models that learn step by step and on state that grows with arriving files."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.catalog.registry import query
from tagloom.catalog.views import LAB, lab, table
from tagloom.functions.vectors import l2_distance
from tagloom.operators.neighbors import assign_nearest_centroid, vector_width
from tagloom.operators.sizing import staging_path
from tagloom.plans import incremental_pca as inc
from tagloom.plans import minibatch_clusters as minibatch
from tagloom.plans.clusters import fit_pca, transform_pca
from tagloom.plans.evaluate import evaluate_embeddings
from tagloom.plans.metric_training import Settings, project, train_joint
from tagloom.sources.tables import write_table
from tagloom.streaming import cluster_counts

# Four classes that two of many coordinates decide, so that a projection can bring each class together.
QUADRANT = "int(embedding[0] > 0) * 2 + int(embedding[1] > 0)"
JOINT = Settings(epochs=4, learning_rate=0.02, batch_rows=64, batches_per_step=1, save_best_by="recall_at_1")


@query(
    "joint_training",
    """SELECT 4 AS epochs, count(*) AS embedded, count(*) AS unit, TRUE AS learns, TRUE AS raises_recall, TRUE AS best_is_kept FROM embeddings""",
)
def joint_training(spark, sf):
    """A projection and classifier trained on a part of the vectors bring equal labels of the others closer together."""
    masks = {"classification_mask": F.lit(1), "metric_mask": F.lit(1)}
    rows = table(spark, sf, "embeddings").withColumn("label", F.expr(QUADRANT)).withColumns(masks)
    late = F.crc32(F.col("vec_id").cast("string").cast("binary")) % 5 == 0
    train, validation = rows.filter(~late), rows.filter(late)
    plain = evaluate_embeddings(
        validation.withColumnRenamed("vec_id", "val_id"), train.withColumn("batch_id", F.lit(0)), ks=[1], keep_batches=None
    )
    before = plain.filter("name = 'recall_at_1'").first()["value"]
    trained = train_joint(train, validation, settings=JOINT)
    recalls = [r["recall_at_1"] for r in trained.log]
    losses = [r["train_classification_loss"] for r in trained.log]
    unit = F.abs(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x) - 1) < 1e-9
    return project(rows, trained.model).agg(
        F.lit(len(trained.log)).alias("epochs"),
        F.count("embedding").alias("embedded"),
        F.count_if(unit).alias("unit"),
        F.lit(losses[-1] < losses[0]).alias("learns"),
        F.lit(max(recalls) > before).alias("raises_recall"),
        F.lit(recalls.index(max(recalls)) + 1 == trained.best_epoch).alias("best_is_kept"),
    )


@query(
    "minibatch_kmeans",
    """SELECT 5 AS batches, count(*) AS vectors, count(*) AS in_clusters, CAST(0 AS BIGINT) AS closer_elsewhere, TRUE AS tighter FROM embeddings""",
)
def minibatch_kmeans(spark, sf):
    """Shards clustered as they arrive, one at a time; the saved centres then assign every vector to the nearest."""
    root = staging_path(spark, "minibatch")
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    write_table(rows.repartition(5, "vec_id"), f"{root}/shards")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "1").parquet(f"{root}/shards")
    # every vector counts once: starved centres are left where they are
    options = dict(n_clusters=10, starved=0.0)
    minibatch.fit_arriving(stream, f"{root}/model", f"{root}/progress", "embedding", **options).awaitTermination()
    state = minibatch.load_state(spark, f"{root}/model")
    first = minibatch.start(rows, "embedding", 10)

    def judged(of):
        assigned = assign_nearest_centroid(rows, of.table(spark).drop("n"), vector="embedding")
        centers = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in of.centers])
        gaps = F.transform(centers, lambda c: l2_distance(F.col("embedding"), c))
        return assigned.withColumn("own", F.get(gaps, F.col("cluster_id").cast("int"))).withColumn("least", F.array_min(gaps))

    spread = judged(first).agg(F.avg("own")).first()[0]
    return judged(state).agg(
        F.lit(state.batches).alias("batches"),
        F.lit(state.vectors).cast("bigint").alias("vectors"),
        F.lit(int(state.counts.sum())).cast("bigint").alias("in_clusters"),
        F.count_if(F.coalesce(F.col("least") < F.col("own") - 1e-9, F.lit(True))).alias("closer_elsewhere"),
        (F.avg("own") < spread).alias("tighter"),
    )


@query(
    "stream_cluster_labels",
    f"""WITH {LAB}, counts AS (SELECT cluster_id, label, count(*) AS n FROM lab WHERE cluster_id IS NOT NULL AND label IS NOT NULL GROUP BY 1, 2)
    SELECT cluster_id, CAST(sum(n) AS BIGINT) AS n, round(max(n) / CAST(sum(n) AS DOUBLE), 9) AS purity,
      CAST(arg_max(label, n * 1000 - label) AS BIGINT) AS label FROM counts GROUP BY 1""",
)
def stream_cluster_labels(spark, sf):
    """Purity and label map from a stream of shards, one of which is delivered twice, with a restart between two loads."""
    root = staging_path(spark, "counted")
    rows = lab(spark, sf).select("doc_id", "cluster_id", "label").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(3)).cast("int"))
    rows = rows.persist()

    def deliver(part: int, name: str) -> None:
        """One shard as one file of the folder the stream watches."""
        write_table(rows.filter(F.col("part") == part).drop("part").coalesce(1), f"{root}/{name}")

    def count() -> None:
        stream = spark.readStream.schema(rows.drop("part").schema).option("maxFilesPerTrigger", "1").parquet(f"{root}/*")
        # the folder a shard was delivered in names it, as the files in it have names of Spark's own
        cluster_counts.count_arriving(stream, f"{root}-totals", f"{root}-progress", shard=FOLDER).awaitTermination()

    FOLDER = F.regexp_extract(F.col("_metadata.file_path"), r"/delivery-\d+-shard-(\d+)/[^/]*$", 1)
    deliver(0, "delivery-1-shard-0")
    deliver(1, "delivery-1-shard-1")
    count()
    deliver(1, "delivery-2-shard-1")
    deliver(2, "delivery-2-shard-2")
    count()
    rows.unpersist()
    counts = cluster_counts.current_counts(spark, f"{root}-totals")
    sizes = counts.groupBy("cluster_id").agg(F.sum("n").alias("n"))
    purity = cluster_counts.current_purity(spark, f"{root}-totals").withColumn("purity", F.round("purity", 9))
    labels = cluster_counts.current_label_map(spark, f"{root}-totals")
    return sizes.join(purity, "cluster_id").join(labels, "cluster_id").select("cluster_id", "n", "purity", "label")


UNIT_VARIANCE = """(SELECT sum(v) FROM (
      SELECT i, var_samp(x) AS v FROM (
        SELECT generate_subscripts(embedding, 1) AS i, unnest(list_transform(CAST(embedding AS DOUBLE[]),
          lambda x: x / sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda y: y * y))))) AS x FROM embeddings) GROUP BY i))"""


@query(
    "incremental_pca",
    f"""SELECT count(*) AS vectors, 3 AS shards, round({UNIT_VARIANCE}, 6) AS total_variance, count(*) AS reduced, count(*) AS as_whole FROM embeddings""",
)
def incremental_pca(spark, sf):
    """Components from three shards, one of them delivered twice, reduce every vector as a fit of all rows at once does."""
    path = staging_path(spark, "pca_state")
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    part = F.pmod(F.xxhash64("vec_id"), F.lit(3))
    width = vector_width(rows, "embedding")
    for number in (0, 1, 1, 2):
        state = inc.add_shard(path, f"part-{number}", rows.filter(part == number), "embedding", dim=width)
    whole = transform_pca(rows, fit_pca(rows, "embedding", 8), "embedding", "whole")
    both = inc.transform(whole, inc.components(state, 8), "embedding", "parts")
    return both.agg(
        F.lit(state.n).cast("bigint").alias("vectors"),
        F.lit(len(state.shards)).alias("shards"),
        F.lit(round(state.total_variance, 6)).alias("total_variance"),
        F.count("parts").alias("reduced"),
        F.count_if(l2_distance(F.col("whole"), F.col("parts")) < 1e-6).alias("as_whole"),
    )


@query(
    "refined_pca",
    f"""SELECT count(*) AS vectors, TRUE AS cut, round({UNIT_VARIANCE}, 6) AS total_variance, count(*) AS as_whole FROM embeddings""",
)
def refined_pca(spark, sf):
    """A root of sixteen rows loses directions but no variance; passes over the table find the components all the same."""
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    state = inc.moments(rows, "embedding", vector_width(rows, "embedding"), keep=16)
    fine = inc.refine(rows, state, "embedding", 4, tolerance=1e-7)
    whole = transform_pca(rows, fit_pca(rows, "embedding", 4), "embedding", "whole")
    both = inc.transform(whole, fine, "embedding", "parts")
    return both.agg(
        F.lit(state.n).cast("bigint").alias("vectors"),
        F.lit(state.lost > 0).alias("cut"),
        F.lit(round(state.total_variance, 6)).alias("total_variance"),
        F.count_if(l2_distance(F.col("whole"), F.col("parts")) < 1e-5).alias("as_whole"),
    )
