"""Queries on classification metrics, losses and metric logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.catalog.labels import MAJORITY
from tagloom.catalog.registry import query
from tagloom.catalog.views import EMBEDDING_PROBS, embedding_probs, lab, table
from tagloom.functions.vectors import argmax, max_prob
from tagloom.operators import metrics as ops
from tagloom.operators.labels import label_lookup, majority_labels
from tagloom.operators.neighbors import contrastive_loss
from tagloom.operators.ranking import best_so_far, running_mean
from tagloom.operators.sizing import staged
from tagloom.plans.evaluate import evaluate_batches

# Judged pairs: the label of an embedding against the class its probabilities favour.
PAIRS = """
probed AS (
  SELECT p.vec_id, CAST(floor(p.vec_id / 50) AS BIGINT) AS batch_id, e.label,
         list_position(p.probs, list_max(p.probs)) - 1 AS pred, list_max(p.probs) AS max_prob, p.probs
  FROM probs p JOIN embeddings e ON e.vec_id = p.vec_id)"""


def probed(spark, sf):
    """Embeddings with the class their probabilities favour."""
    return embedding_probs(spark, sf).select(
        "vec_id", F.floor(F.col("vec_id") / 50).alias("batch_id"), "embedding", "label", "probs",
        argmax(F.col("probs")).alias("pred"), max_prob(F.col("probs")).alias("max_prob"),
    )


def scores_sql(pairs: str, by: str = "") -> str:
    """Per-class and macro scores of ``pairs(label, pred)`` as further CTEs ``classes`` and ``macro``."""
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
sides AS (
  SELECT {keys} label AS class, CASE WHEN label = pred THEN 1 ELSE 0 END AS tp, 1 AS actual, 0 AS predicted FROM {pairs}
  UNION ALL SELECT {keys} pred, 0, 0, 1 FROM {pairs}),
totals AS (
  SELECT {keys} class, CAST(sum(tp) AS DOUBLE) AS tp, CAST(sum(actual) AS DOUBLE) AS actual,
         CAST(sum(predicted) AS DOUBLE) AS predicted FROM sides GROUP BY {keys} class),
classes AS (
  SELECT {keys} class, tp, actual, predicted,
         CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
         CASE WHEN actual > 0 THEN tp / actual ELSE 0 END AS recall FROM totals),
scored AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1
  FROM classes),
macro AS (
  SELECT {keys} sum(tp) / sum(actual) AS accuracy, avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1
  FROM scored {group})"""


ROUNDED = ", ".join(f"round({m}, 6) AS {m}" for m in ops.METRICS)
DOC_PAIRS = MAJORITY + """, pairs AS (
  SELECT lab.label, majority.label AS pred FROM lab JOIN majority ON lab.cluster_id = majority.cluster_id)"""


def rounded(df, names=tuple(ops.METRICS)):
    return df.withColumns({m: F.round(m, 6) for m in names})


def document_pairs(spark, sf):
    rows = lab(spark, sf).select("cluster_id", F.col("label").cast("bigint").alias("truth"))
    return label_lookup(rows, majority_labels(lab(spark, sf))).select(F.col("truth").alias("label"), F.col("label").alias("pred"))


@query("classification_metrics", f"WITH {EMBEDDING_PROBS}, {PAIRS}, {scores_sql('probed')} SELECT {ROUNDED} FROM macro")
def classification_metrics(spark, sf):
    return rounded(ops.classification_metrics(probed(spark, sf)))


@query("cluster_vote_metrics", f"WITH {DOC_PAIRS}, {scores_sql('pairs')} SELECT {ROUNDED} FROM macro")
def cluster_vote_metrics(spark, sf):
    return rounded(ops.classification_metrics(document_pairs(spark, sf)))


@query("accuracy", f"WITH {EMBEDDING_PROBS}, {PAIRS} SELECT round(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM probed")
def accuracy(spark, sf):
    return rounded(ops.classification_metrics(probed(spark, sf)).select("accuracy"), ["accuracy"])


for _name in ops.METRICS[1:]:

    def _macro(spark, sf, name=_name):
        return rounded(ops.classification_metrics(probed(spark, sf)).select(name), [name])

    query(f"macro_{_name}", f"WITH {EMBEDDING_PROBS}, {PAIRS}, {scores_sql('probed')} SELECT round({_name}, 6) AS {_name} FROM macro")(_macro)


@query(
    "per_class_scores",
    f"""WITH {EMBEDDING_PROBS}, {PAIRS}, {scores_sql('probed')}
    SELECT CAST(class AS BIGINT) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM scored""",
)
def per_class_scores(spark, sf):
    names = ops.METRICS[1:]
    return rounded(ops.per_class_scores(probed(spark, sf)), names).select("class", *names)


@query(
    "metrics_by_batch",
    f"""WITH {EMBEDDING_PROBS}, {PAIRS}, masked AS (SELECT * FROM probed WHERE max_prob >= 0.4), {scores_sql('masked', 'batch_id')}
    SELECT b.batch_id, {", ".join(f"round(coalesce({m}, 0), 6) AS {m}" for m in ops.METRICS)}
    FROM (SELECT DISTINCT batch_id FROM probed) b LEFT JOIN macro ON macro.batch_id = b.batch_id""",
)
def metrics_by_batch(spark, sf):
    rows = probed(spark, sf).withColumn("mask", (F.col("max_prob") >= 0.4).cast("bigint"))
    return rounded(ops.masked_metrics_by_batch(rows, "batch_id", "mask"))


GRID = """grid AS (
  SELECT l.c AS label, p.c AS pred, coalesce(n, 0) AS n
  FROM (SELECT unnest(range(10)) AS c) l CROSS JOIN (SELECT unnest(range(10)) AS c) p
  LEFT JOIN (SELECT label, pred, count(*) AS n FROM probed GROUP BY 1, 2) k ON k.label = l.c AND k.pred = p.c)"""


@query("confusion_counts", f"WITH {EMBEDDING_PROBS}, {PAIRS}, {GRID} SELECT label, pred, n FROM grid")
def confusion_counts(spark, sf):
    return ops.confusion_counts(probed(spark, sf), 10)


@query(
    "confusion_normalized",
    f"""WITH {EMBEDDING_PROBS}, {PAIRS}, {GRID},
    shares AS (SELECT label, pred, coalesce(n / nullif(CAST(sum(n) OVER (PARTITION BY label) AS DOUBLE), 0), 0) AS share FROM grid)
    SELECT label, pred, round(share, 6) AS share, printf('%.1f%%', share * 100) AS shown FROM shares""",
)
def confusion_normalized(spark, sf):
    return ops.confusion_normalized(ops.confusion_counts(probed(spark, sf), 10)).withColumn("share", F.round("share", 6))


SMOOTHED = """(0.9 * -ln(probs[label + 1]) + 0.1 / len(probs) * list_sum(list_transform(probs, lambda p: -ln(p))))"""


@query(
    "masked_cross_entropy",
    f"""WITH {EMBEDDING_PROBS}, {PAIRS}
    SELECT batch_id, round(coalesce(avg(-ln(probs[label + 1])) FILTER (max_prob >= 0.4), 0), 6) AS classification_loss
    FROM probed GROUP BY batch_id""",
)
def masked_cross_entropy(spark, sf):
    rows = probed(spark, sf).withColumn("mask", (F.col("max_prob") >= 0.4).cast("bigint"))
    return rounded(ops.masked_cross_entropy(rows, by=["batch_id"]), ["classification_loss"])


@query(
    "smoothed_cross_entropy",
    f"WITH {EMBEDDING_PROBS}, {PAIRS} SELECT round(avg({SMOOTHED}), 6) AS classification_loss FROM probed",
)
def smoothed_cross_entropy(spark, sf):
    rows = probed(spark, sf).withColumn("mask", F.lit(1))
    return rounded(ops.masked_cross_entropy(rows, smoothing=0.1), ["classification_loss"])


SUPCON = """
rowsums AS (
  SELECT a.batch_id, a.vec_id,
         sum(CASE WHEN a.label = b.label THEN exp(list_inner_product(a.embedding, b.embedding) / 0.1) ELSE 0 END) AS p,
         sum(exp(list_inner_product(a.embedding, b.embedding) / 0.1)) AS a,
         sum(CASE WHEN a.label = b.label THEN 1 ELSE 0 END) AS n
  FROM vecs a JOIN vecs b ON a.batch_id = b.batch_id AND a.vec_id <> b.vec_id GROUP BY 1, 2),
supcon AS (
  SELECT batch_id, -sum(ln((p + 1e-12) / (a + 1e-12))) FILTER (n > 0) / nullif(sum(n), 0) AS metric_loss
  FROM rowsums GROUP BY 1)"""
VECS = "vecs AS (SELECT vec_id, CAST(floor(vec_id / 50) AS BIGINT) AS batch_id, CAST(embedding AS DOUBLE[]) AS embedding, label FROM embeddings)"


@query("supcon_loss", f"WITH {VECS}, {SUPCON} SELECT batch_id, round(coalesce(metric_loss, 0), 6) AS metric_loss FROM supcon")
def supcon_loss(spark, sf):
    rows = table(spark, sf, "embeddings").withColumns({"batch_id": F.floor(F.col("vec_id") / 50), "mask": F.lit(1)})
    return rounded(contrastive_loss(rows), ["metric_loss"])


@query(
    "total_loss",
    f"""WITH {EMBEDDING_PROBS}, {PAIRS}, {VECS}, {SUPCON},
    ce AS (SELECT batch_id, avg(-ln(probs[label + 1])) AS c FROM probed GROUP BY 1)
    SELECT ce.batch_id, round(1.0 * c + 0.5 * coalesce(metric_loss, 0), 6) AS total_loss
    FROM ce LEFT JOIN supcon ON supcon.batch_id = ce.batch_id""",
)
def total_loss(spark, sf):
    rows = probed(spark, sf).withColumn("mask", F.lit(1))
    both = ops.masked_cross_entropy(rows, by=["batch_id"]).join(contrastive_loss(rows), "batch_id")
    loss = ops.total_loss(F.col("classification_loss"), F.col("metric_loss"), 1.0, 0.5)
    return both.select("batch_id", F.round(loss, 6).alias("total_loss"))


@query(
    "joint_evaluation",
    f"""WITH {EMBEDDING_PROBS}, {PAIRS}, {VECS}, {SUPCON},
    masked AS (SELECT * FROM probed WHERE max_prob >= 0.4), {scores_sql('masked')},
    ce AS (SELECT batch_id, coalesce(avg(-ln(probs[label + 1])) FILTER (max_prob >= 0.4), 0) AS c FROM probed GROUP BY 1),
    losses AS (SELECT avg(c) AS c, avg(coalesce(metric_loss, 0)) AS m FROM ce LEFT JOIN supcon ON supcon.batch_id = ce.batch_id)
    SELECT 'classification_loss' AS name, round(c, 6) AS value FROM losses
    UNION ALL SELECT 'metric_loss', round(m, 6) FROM losses
    UNION ALL SELECT 'total_loss', round(c + 0.5 * m, 6) FROM losses
    {" ".join(f"UNION ALL SELECT '{m}', round({m}, 6) FROM macro" for m in ops.METRICS)}""",
)
def joint_evaluation(spark, sf):
    sure = (F.col("max_prob") >= 0.4).cast("bigint")
    rows = staged(probed(spark, sf).withColumns({"classification_mask": sure, "metric_mask": F.lit(1)}), "judged")
    return rounded(evaluate_batches(rows, metric_weight=0.5), ["value"])


@query(
    "running_mean",
    """SELECT event_id, event_type, round(avg(ln(1 + value)) OVER (
      PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING), 6) AS running FROM events""",
)
def running_means(spark, sf):
    log = table(spark, sf, "events").select("event_id", "event_type", F.log(1 + F.col("value")).alias("value"))
    means = running_mean(log, ["event_type"], "event_id", "value", "running")
    return means.select("event_id", "event_type", F.round("running", 6).alias("running"))


def _best(minimize: bool):
    def run(spark, sf):
        log = table(spark, sf, "events").select("event_id", "event_type", "value")
        flagged = best_so_far(log, ["event_type"], "event_id", "value", "is_best", minimize=minimize)
        return flagged.select("event_id", "event_type", "is_best")

    return run


for _name, _minimize, _agg, _sign, _start in [
    ("best_so_far", True, "min", "<", "'inf'"), ("best_so_far_highest", False, "max", ">", "'-inf'"),
]:
    query(
        _name,
        f"""SELECT event_id, event_type, value {_sign} coalesce({_agg}(value) OVER (
          PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
          CAST({_start} AS DOUBLE)) AS is_best FROM events""",
    )(_best(_minimize))


@query(
    "epoch_means",
    "SELECT event_type, CAST(floor(event_id / 1000) AS BIGINT) AS epoch, round(avg(ln(1 + value)), 6) AS epoch_value FROM events GROUP BY 1, 2",
)
def epoch_means(spark, sf):
    log = table(spark, sf, "events").withColumns(
        {"epoch": F.floor(F.col("event_id") / 1000), "value": F.log(1 + F.col("value"))}
    )
    return rounded(ops.epoch_means(log, ["event_type", "epoch"]), ["epoch_value"])
