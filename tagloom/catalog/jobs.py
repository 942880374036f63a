"""Whole jobs: refresh, scoring, validation, preparation, training and the stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.catalog.registry import query
from tagloom.catalog.labels import PURITY
from tagloom.catalog.metrics import scores_sql
from tagloom.catalog.views import (
    LAB,
    TEXT_CLASSES,
    lab,
    lab_texts,
    scored_lab,
    table,
    text_logit_sql,
    text_model,
    text_probs_sql,
    texts,
)
from tagloom.operators.labels import class_counts, cluster_purity
from tagloom.operators.sampling import balance_by_score
from tagloom.operators.scoring import prediction_record, score_texts, without_failures
from tagloom.operators.sizing import staged, staging_path
from tagloom.plans import refresh as refresh_plan
from tagloom.plans.csv_scoring import label_texts, score_csv
from tagloom.plans.evaluate import run_validation, validate_predictions
from tagloom.plans.prepare import prepare
from tagloom.plans.training import train_classifier
from tagloom.sources import manifest
from tagloom.sources.tables import read_scoring_csv, write_csv, write_metrics
from tagloom.streaming.incremental import arriving_files, score_arriving

LIMITS = refresh_plan.Thresholds(
    metric_purity=0.85, metric_max_prob=0.8, classification_purity=0.8, classification_max_prob=0.84
)

JUDGED = f"""{PURITY},
scored AS (SELECT lab.*, {text_probs_sql('text')} AS probs FROM lab),
judged AS (
  SELECT scored.*, purity, list_max(probs) AS max_prob FROM scored LEFT JOIN purity ON purity.cluster_id = scored.cluster_id),
kept AS (
  SELECT doc_id, text, label, max_prob,
         CAST(purity >= 0.85 AND max_prob >= 0.8 AS BIGINT) AS metric_mask,
         CAST(purity >= 0.8 AND max_prob >= 0.84 AS BIGINT) AS classification_mask
  FROM judged WHERE purity >= 0.8 AND max_prob >= 0.8),
sizes AS (SELECT label, count(*) AS n FROM kept GROUP BY label),
balanced AS (
  SELECT doc_id, text, label, metric_mask, classification_mask FROM kept
  QUALIFY row_number() OVER (PARTITION BY label ORDER BY max_prob DESC, doc_id) <= (SELECT min(n) FROM sizes))"""


def _refreshed(spark, sf, balance=True, **options):
    purity = cluster_purity(lab(spark, sf))
    rows = scored_lab(spark, sf, stored=balance)
    return refresh_plan.refresh(rows, purity, LIMITS, key="doc_id", balance=balance, **options)


@query("pseudo_label_refresh", f"WITH {JUDGED} SELECT text, label, metric_mask, classification_mask FROM balanced")
def pseudo_label_refresh(spark, sf):
    return _refreshed(spark, sf)


@query(
    "pseudo_label_refresh_unbalanced",
    f"WITH {JUDGED} SELECT doc_id, text, label, metric_mask, classification_mask FROM kept",
)
def pseudo_label_refresh_unbalanced(spark, sf):
    return _refreshed(spark, sf, balance=False, keep_key=True)


@query(
    "refresh_audit",
    f"""WITH {JUDGED}
    SELECT count(*) AS total_rows, count(*) FILTER (NOT coalesce(purity >= 0.8, FALSE)) AS dropped_purity,
           count(*) FILTER (purity >= 0.8 AND NOT coalesce(max_prob >= 0.8, FALSE)) AS dropped_max_prob,
           count(*) FILTER (purity >= 0.8 AND max_prob >= 0.8) AS rows_kept FROM judged""",
)
def refresh_audit(spark, sf):
    judged = refresh_plan.judge_rows(scored_lab(spark, sf, stored=False), cluster_purity(lab(spark, sf)), LIMITS)
    return refresh_plan.refresh_audit(judged)


@query(
    "mask_fractions",
    f"""WITH {JUDGED}
    SELECT count(*) AS rows, round(coalesce(avg(metric_mask), 0), 6) AS metric_fraction,
           round(coalesce(avg(classification_mask), 0), 6) AS classification_fraction FROM balanced""",
)
def mask_fractions(spark, sf):
    fractions = refresh_plan.mask_fractions(_refreshed(spark, sf))
    return fractions.withColumns({f"{m}_fraction": F.round(f"{m}_fraction", 6) for m in ("metric", "classification")})


@query(
    "refresh_class_counts",
    f"""WITH {JUDGED}
    SELECT label, count(*) AS before, (SELECT min(n) FROM sizes) AS after FROM kept WHERE label IS NOT NULL GROUP BY label""",
)
def refresh_class_counts(spark, sf):
    """Rows per class before and after balancing."""
    rows = scored_lab(spark, sf)
    judged = refresh_plan.judge_rows(rows, cluster_purity(lab(spark, sf)), LIMITS)
    kept = refresh_plan.mask_rows(judged, LIMITS)
    before = class_counts(kept).withColumnRenamed("n", "before")
    after = class_counts(balance_by_score(kept, "label", "max_prob", "doc_id")).withColumnRenamed("n", "after")
    return before.join(after, "label")


LABEL = f"CASE WHEN {text_logit_sql('text')} >= 0 THEN 0 ELSE 1 END"
NAME = f"CASE WHEN {text_logit_sql('text')} >= 0 THEN '{TEXT_CLASSES[0]}' ELSE '{TEXT_CLASSES[1]}' END"


@query(
    "score_texts",
    f"SELECT doc_id, CAST({LABEL} AS BIGINT) AS label, round({text_probs_sql('text')}[1], 6) AS p0, round({text_probs_sql('text')}[2], 6) AS p1 FROM documents",
)
def scored_documents(spark, sf):
    scored = without_failures(score_texts(texts(spark, sf, "documents", "doc_id", "text"), text_model()))
    p = F.col("probs")
    return scored.select("doc_id", "label", F.round(p[0], 6).alias("p0"), F.round(p[1], 6).alias("p1"))


@query(
    "text_prediction_record",
    f"""SELECT conv_id, turn, {NAME} AS prediction,
      round({text_probs_sql('text')}[1], 4) AS junk, round({text_probs_sql('text')}[2], 4) AS clean FROM conversations""",
)
def text_prediction_record(spark, sf):
    rows = texts(spark, sf, "conversations", "conv_id", "turn", "text")
    return prediction_record(without_failures(score_texts(rows, text_model())), TEXT_CLASSES, keep=["conv_id", "turn"])


CSV_SQL = f"SELECT conv_id || '-' || turn AS \"ID\", {NAME} AS label FROM conversations"


def _csv_rows(spark, sf):
    rows = texts(spark, sf, "conversations", "conv_id", "turn", "text")
    return rows.select(F.concat_ws("-", "conv_id", "turn").alias("ID"), "text")


@query("predict_labels", CSV_SQL)
def predict_labels(spark, sf):
    return label_texts(_csv_rows(spark, sf), text_model(), TEXT_CLASSES)


@query("csv_scoring", CSV_SQL)
def csv_scoring(spark, sf):
    """Conversations written as CSV, read back, scored, and written as a CSV again."""
    source, target = staging_path(spark, "in") + ".csv", staging_path(spark, "out") + ".csv"
    write_csv(_csv_rows(spark, sf), source)
    score_csv(spark, source, text_model(), TEXT_CLASSES, output_path=target)
    return spark.read.schema("ID string, label string").csv(target, header=True)


BROKEN = """text || ' "' || chr(10) || turn || '", ' || chr(10) || chr(10)"""


@query("csv_byte_ranges", f"SELECT conv_id || '-' || turn AS \"ID\", md5({BROKEN}) AS text FROM conversations")
def csv_byte_ranges(spark, sf):
    """One CSV with quotes and line breaks in every cell, read by ranges much smaller than the file."""
    path = staging_path(spark, "ranges") + ".csv"
    # ranges stay small while a file grows; a task then reads many of them
    settings = {"spark.sql.files.maxPartitionBytes": "16k", "spark.sql.files.maxPartitionNum": str(4 * spark.sparkContext.defaultParallelism)}
    rows = table(spark, sf, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("ID"), F.expr(BROKEN).alias("text"))
    write_csv(rows.coalesce(1), path)
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        found = staged(read_scoring_csv(spark, path), "records")
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    return found.select("ID", F.md5("text").alias("text"))


@query(
    "table_manifest",
    f"""WITH {LAB}, loads AS (
      SELECT 1 AS version, doc_id % 7 AS shard_id, label FROM lab UNION ALL
      SELECT 2, doc_id % 7, CASE WHEN doc_id % 7 = 3 THEN 1 - label ELSE label END FROM lab)
    SELECT version, shard_id, count(*) AS n, CAST(sum(label) AS BIGINT) AS good, version = 1 OR shard_id = 3 AS written
    FROM loads GROUP BY version, shard_id""",
)
def table_manifest(spark, sf):
    """Two versions of labelled texts; the second has other labels in one shard, and only that one is written again."""
    root = staging_path(spark, "versions")
    rows = lab(spark, sf).select("doc_id", "text", "label", (F.col("doc_id") % 7).alias("shard_id"))
    turned = F.when(F.col("shard_id") == 3, 1 - F.col("label")).otherwise(F.col("label"))
    out = None
    for relabelled in (rows, rows.withColumn("label", turned)):
        version = manifest.load_version(spark, root, manifest.publish(root, {"texts": relabelled}))
        before = manifest.load_version(spark, root, version.number - 1) if version.number > 1 else manifest.Version(0, None, {})
        earlier = manifest.entries(spark, root, before).select("load").distinct()
        fresh = manifest.entries(spark, root, version).join(earlier, "load", "left_anti").select("shard", F.lit(True).alias("written"))
        found = manifest.read_version(spark, root, "texts", version.number).groupBy("shard_id").agg(
            F.count(F.lit(1)).alias("n"), F.sum("label").alias("good")
        )
        judged = found.join(fresh, F.col("shard") == F.col("shard_id"), "left").select(
            F.lit(version.number).alias("version"), "shard_id", "n", "good", F.coalesce("written", F.lit(False)).alias("written")
        )
        out = judged if out is None else out.unionByName(judged)
    return out


VALIDATION = f"""{LAB}, pairs AS (SELECT label, {LABEL} AS pred FROM lab)"""


@query(
    "validate_model",
    f"WITH {VALIDATION}, {scores_sql('pairs')} SELECT round(accuracy, 6) AS accuracy, round(f1, 6) AS macro_f1 FROM macro",
)
def validate_model(spark, sf):
    """The metrics travel through their JSON sink."""
    path = staging_path(spark, "metrics")
    write_metrics(validate_predictions(lab_texts(spark, sf), text_model()), path)
    return spark.read.schema("accuracy double, macro_f1 double").json(path).select(
        F.round("accuracy", 6).alias("accuracy"), F.round("macro_f1", 6).alias("macro_f1")
    )


@query(
    "validate_model_remapped",
    f"""WITH {LAB}, pairs AS (SELECT label, 1 - {LABEL} AS pred FROM lab), {scores_sql('pairs')}
    SELECT round(accuracy, 6) AS accuracy, round(f1, 6) AS macro_f1 FROM macro""",
)
def validate_model_remapped(spark, sf):
    metrics = validate_predictions(lab_texts(spark, sf), text_model(), mapping={"0": 1, "1": 0})
    return metrics.select(F.round("accuracy", 6).alias("accuracy"), F.round("macro_f1", 6).alias("macro_f1"))


MARKED = "CASE WHEN doc_id % 4 = 0 THEN 'NA' WHEN doc_id % 4 = 1 THEN '  ' || text || ' ' ELSE text END"


@query(
    "validate_csv",
    f"""WITH {LAB}, cells AS (SELECT label, CASE WHEN doc_id % 4 = 0 THEN 'nan' ELSE {MARKED} END AS text FROM lab),
    pairs AS (SELECT label, {LABEL} AS pred FROM cells), {scores_sql('pairs')}
    SELECT round(accuracy, 6) AS accuracy, round(f1, 6) AS macro_f1 FROM macro""",
)
def validate_csv(spark, sf):
    """Labelled texts in a CSV: every fourth one is marked as missing, every fourth has blanks around it."""
    path = staging_path(spark, "validation") + ".csv"
    write_csv(lab_texts(spark, sf).select(F.expr(MARKED).alias("text"), "label"), path)
    metrics = run_validation(spark, path, text_model())
    return metrics.select(F.round("accuracy", 6).alias("accuracy"), F.round("macro_f1", 6).alias("macro_f1"))


def _train_and_validation(spark, sf):
    rows = lab_texts(spark, sf).select("doc_id", "text", "label", "lang")
    english = F.col("lang") == "en"
    return rows.filter(english).drop("lang"), rows.filter(~english).drop("lang")


@query(
    "prepare_dataset",
    f"""WITH {LAB} SELECT doc_id, lang <> 'en' AS validation, CAST(label AS BIGINT) AS label,
      CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS label_id FROM lab""",
)
def prepare_dataset(spark, sf):
    """English documents train, the others validate."""
    ready = prepare(*_train_and_validation(spark, sf), key="doc_id")
    columns = ["doc_id", "validation", F.col("label").cast("bigint").alias("label"), "label_id"]
    sides = [(ready.train, False), (ready.validation, True)]
    train, validation = (side.withColumn("validation", F.lit(late)).select(*columns) for side, late in sides)
    return train.unionByName(validation)


@query(
    "prepare_dataset_balanced",
    f"""WITH {LAB}, ids AS (SELECT *, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS label_id FROM lab),
    sizes AS (SELECT label_id, count(*) AS n FROM ids WHERE lang = 'en' GROUP BY 1)
    SELECT label_id, FALSE AS validation, (SELECT min(n) FROM sizes) AS n FROM sizes
    UNION ALL SELECT label_id, TRUE, count(*) FROM ids WHERE lang <> 'en' GROUP BY 1""",
)
def prepare_dataset_balanced(spark, sf):
    ready = prepare(*_train_and_validation(spark, sf), key="doc_id", balance="down")
    sides = [(ready.train, False), (ready.validation, True)]
    train, validation = (side.select("label_id", F.lit(late).alias("validation")) for side, late in sides)
    return train.unionByName(validation).groupBy("label_id", "validation").agg(F.count(F.lit(1)).alias("n"))


@query(
    "prepare_dataset_masked",
    f"""WITH {LAB}, rows AS (SELECT doc_id, label, lang, CAST(doc_id % 2 AS BIGINT) AS metric_mask, toxic FROM lab)
    SELECT doc_id, lang <> 'en' AS validation, CAST(label AS BIGINT) AS label, metric_mask, CAST(toxic AS BIGINT) AS classification_mask,
      CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS label_id FROM rows""",
)
def prepare_dataset_masked(spark, sf):
    """Both tables with their masks; labels come as text and are read as whole numbers."""
    rows = lab_texts(spark, sf).withColumns(
        {"label": F.col("label").cast("string"), "metric_mask": F.col("doc_id") % 2, "classification_mask": F.col("toxic").cast("bigint")}
    )
    ready = prepare(rows.filter("lang = 'en'"), rows.filter("lang <> 'en'"), key="doc_id", masked=True)
    columns = ["doc_id", "validation", "label", "metric_mask", "classification_mask", "label_id"]
    sides = [(ready.train, False), (ready.validation, True)]
    train, validation = (side.withColumn("validation", F.lit(late)).select(*columns) for side, late in sides)
    return train.unionByName(validation)


@query("train_classifier")
def trained_classifier(spark, sf):
    """Validation scores of each candidate; the best by macro F1 is marked."""
    train, validation = _train_and_validation(spark, sf)
    ready = prepare(train, validation, key="doc_id", shuffle=False)
    trained = train_classifier(ready.train, ready.validation, num_features=2**12, max_iter=10)
    rows = [{**entry, "best": entry["regParam"] == trained.settings["regParam"]} for entry in trained.log]
    return spark.createDataFrame(rows)


@query("stream_scoring", f"SELECT conv_id, turn, CAST({LABEL} AS BIGINT) AS label FROM conversations")
def stream_scoring(spark, sf):
    """Score the files present now as a stream and read back what it appended."""
    output, checkpoint = staging_path(spark, "stream"), staging_path(spark, "progress")
    schema = table(spark, sf, "conversations").schema
    # a table is one file or a folder of part files; a stream takes either one by a pattern, but no path of a single file
    stream = arriving_files(spark, f"{sf}/conversations.parque[t]", schema).select("conv_id", "turn", "text")
    score_arriving(stream, text_model(), output, checkpoint).awaitTermination()
    return spark.read.parquet(output).select("conv_id", "turn", "label")
