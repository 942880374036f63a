"""Inputs shared by several queries, in Spark and in SQL."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.binding import bind
from tagloom.functions.vectors import l2_normalize, max_prob, softmax
from tagloom.operators.sizing import MAX_LOOKUP_ROWS, small_rows, spread, staged

# How sharply class scores of embeddings and texts differ.
EMBEDDING_SCALE = 10.0
SYMBOL_WEIGHT, LENGTH_WEIGHT, BIAS = 20.0, 0.4, -2.0
BLANKS = " \t\n\r\f"
TEXT_CLASSES = ["junk", "clean"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table whose rows take real work each, so every core should get some."""
    return spread(table(spark, sf, name).select(*columns))


# --- labelled documents with a cluster id -----------------------------------------------------------------

LAB = """
lab AS (
  SELECT d.doc_id, d.text, d.lang, TRY_CAST(substr(d.source, 4) AS BIGINT) AS cluster_id, l.quality AS label, l.toxic
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def clustered_documents(documents: DataFrame) -> DataFrame:
    cluster = F.substring("source", 4, 10).try_cast("bigint")
    return documents.select("doc_id", "text", "lang", cluster.alias("cluster_id"))


def _labelled(spark: SparkSession, sf: str, documents: DataFrame) -> DataFrame:
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"), "toxic")
    return clustered_documents(documents).join(labels, "doc_id")


def lab(spark: SparkSession, sf: str) -> DataFrame:
    return _labelled(spark, sf, table(spark, sf, "documents"))


def lab_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows, dealt out to every core for work on their texts."""
    documents = table(spark, sf, "documents")
    return spread(_labelled(spark, sf, documents), documents)


# --- a two-class text model on the share of symbols and the mean word length ------------------------------

TEXT_LOGIT = f"""(
  {SYMBOL_WEIGHT} * length(regexp_replace(TEXT, '[\\p{{L}} \\t\\n\\r\\f]', '', 'g')) / greatest(length(TEXT), 1)
  + {LENGTH_WEIGHT} * (length(regexp_replace(TEXT, '[ \\t\\n\\r\\f]', '', 'g'))
      / (1.0 + length(regexp_replace(TEXT, '[^ \\t\\n\\r\\f]', '', 'g'))) - 5.0)
  + {BIAS})"""


def text_logit_sql(column: str) -> str:
    """Score of class 0 against class 1, whose score is 0."""
    return TEXT_LOGIT.replace("TEXT", column)


def text_probs_sql(column: str) -> str:
    z = text_logit_sql(column)
    return f"[1.0 / (1.0 + exp(-{z})), 1.0 / (1.0 + exp({z}))]"


def text_logits(text: Column) -> Column:
    symbols = F.length(F.regexp_replace(text, r"[\p{L} \t\n\r\f]++", ""))
    letters = F.length(F.translate(text, BLANKS, ""))
    share = symbols / F.greatest(F.length(text), F.lit(1))
    word_length = bind(letters, lambda n: n / (1.0 + F.length(text) - n))
    return F.array(SYMBOL_WEIGHT * share + LENGTH_WEIGHT * (word_length - 5.0) + BIAS, F.lit(0.0))


def text_model():
    """The same model as a scorer plug-in; its embedding of a text is the pair of features."""
    weights = (SYMBOL_WEIGHT, LENGTH_WEIGHT, BIAS)

    def load():
        import regex

        plain = regex.compile(r"[\p{L} \t\n\r\f]+")

        def scorer(texts):
            symbols = np.array([len(plain.sub("", t)) for t in texts], dtype=float)
            sizes = np.array([len(t) for t in texts], dtype=float)
            letters = sizes - np.array([sum(map(t.count, BLANKS)) for t in texts], dtype=float)
            features = np.stack([symbols / np.maximum(sizes, 1), letters / (1 + sizes - letters)], axis=1)
            score = weights[0] * features[:, 0] + weights[1] * (features[:, 1] - 5.0) + weights[2]
            return features, np.stack([score, np.zeros(len(texts))], axis=1)

        return scorer

    return load


def scored_lab(spark: SparkSession, sf: str, stored: bool = True) -> DataFrame:
    """Labelled documents with the class probabilities of the text model.

    ``stored`` writes them down for jobs that read them several times; a single pass needs no copy.
    """
    scored = lab_texts(spark, sf).withColumn("probs", softmax(text_logits(F.col("text"))))
    return staged(scored, "scored") if stored else scored


# --- class centroids of the embeddings and the probabilities they give ------------------------------------

CENTERS = """
coords AS (
  SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
means AS (SELECT label, i, avg(x) AS m FROM coords GROUP BY label, i),
cen AS (SELECT CAST(label AS BIGINT) AS cluster_id, list(m ORDER BY i) AS center FROM means GROUP BY label),
unit_cen AS (
  SELECT cluster_id, list_transform(center, lambda x: x / sqrt(list_sum(list_transform(center, lambda y: y * y)))) AS center
  FROM cen)"""

EMBEDDING_PROBS = (
    CENTERS
    + f""",
logits AS (
  SELECT e.vec_id, c.cluster_id, {EMBEDDING_SCALE} * list_inner_product(CAST(e.embedding AS DOUBLE[]), c.center) AS z
  FROM embeddings e CROSS JOIN unit_cen c),
raised AS (SELECT vec_id, cluster_id, exp(z - max(z) OVER (PARTITION BY vec_id)) AS w FROM logits),
probs AS (
  SELECT vec_id, list(p ORDER BY cluster_id) AS probs
  FROM (SELECT vec_id, cluster_id, w / sum(w) OVER (PARTITION BY vec_id) AS p FROM raised)
  GROUP BY vec_id)"""
)


def class_centers(spark: SparkSession, sf: str) -> DataFrame:
    mean = vector_to_array(Summarizer.mean(array_to_vector(F.col("embedding").cast("array<double>"))))
    centers = table(spark, sf, "embeddings").groupBy("label").agg(mean.alias("center"))
    return centers.select(F.col("label").cast("bigint").alias("cluster_id"), "center")


def embedding_probs(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings with a softmax over their scaled inner products with the unit class centroids."""
    centers = class_centers(spark, sf).select("cluster_id", l2_normalize(F.col("center")).alias("center"))
    rows = small_rows(centers, MAX_LOOKUP_ROWS)
    if rows is None:
        raise ValueError("too many classes for one probability array")
    weights = np.array(rows.sort_by("cluster_id")["center"].to_pylist()) * EMBEDDING_SCALE

    @F.arrow_udf("array<double>")
    def logits(vectors: pa.Array) -> pa.Array:
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        scores = flat.reshape(len(vectors), weights.shape[1]) @ weights.T
        offsets = np.arange(0, scores.size + 1, weights.shape[0], dtype=np.int32)
        return pa.ListArray.from_arrays(offsets, scores.ravel())

    scored = table(spark, sf, "embeddings").withColumn("logits", logits("embedding"))
    return scored.withColumn("probs", softmax(F.col("logits"))).drop("logits")


# --- training bank and validation set of the embeddings ---------------------------------------------------

# A row is sure enough for the bank when its top probability reaches this.
BANK_MAX_PROB = 0.3

BANK = (
    EMBEDDING_PROBS
    + f""",
judged AS (
  SELECT e.vec_id, CAST(floor(e.vec_id / 50) AS BIGINT) AS batch_id, CAST(e.embedding AS DOUBLE[]) AS embedding, e.label,
         list_max(p.probs) AS max_prob
  FROM embeddings e JOIN probs p ON e.vec_id = p.vec_id),
bank AS (SELECT * FROM judged WHERE max_prob >= {BANK_MAX_PROB}),
val AS (SELECT vec_id AS val_id, embedding, label FROM judged WHERE max_prob < {BANK_MAX_PROB})"""
)


def bank_and_validation(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    judged = embedding_probs(spark, sf).select(
        "vec_id",
        F.floor(F.col("vec_id") / 50).alias("batch_id"),
        "embedding",
        "label",
        max_prob(F.col("probs")).alias("max_prob"),
    )
    judged = staged(judged, "judged")
    sure = F.col("max_prob") >= BANK_MAX_PROB
    return judged.filter(sure), judged.filter(~sure).withColumnRenamed("vec_id", "val_id")
