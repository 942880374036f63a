"""Stages that turn raw documents into encoded training texts; each works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.catalog.views import table
from tagloom.llm import decontaminate, exact_dedup, pieces, simhash, toxicity
from tagloom.llm.catalog import PIECE_MODEL
from tagloom.operators.sizing import staged

OWN = ("doc_id", "text")


def packed(docs: DataFrame) -> DataFrame:
    """Id and text, and all other columns as one, so that none can clash with a column an operator adds."""
    others = [docs[f"`{c}`"] for c in docs.columns if c not in OWN]
    return docs.select(*OWN, F.struct(F.lit(0).alias("none"), *others).alias("carried"))


def unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col(c) if c in OWN else F.col("carried").getField(c).alias(c) for c in columns])


def toxic_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text scores below one half; the model learns from all labelled documents of its input."""
    rows = packed(docs)
    model = toxicity.fit(rows, table(spark, sf_dir, "labels"))
    return unpacked(toxicity.score(rows, model).filter("score < 0.5"), docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return unpacked(exact_dedup.drop_copies(packed(docs)), docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return unpacked(simhash.keep_one(packed(docs)), docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return unpacked(decontaminate.decontaminate(packed(docs), table(spark, sf_dir, "benchmark")), docs.columns)


def encoded_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their pieces in place of their texts; a ``pieces`` they came with goes too."""
    rows = pieces.encode(packed(docs), PIECE_MODEL)
    kept = [c for c in docs.columns if c != "text" and c.lower() != "pieces"]
    return unpacked(rows.withColumn("carried", F.col("carried").withField("pieces", F.col("pieces"))), [*kept, "pieces"])


STAGES = [
    ("toxicity", toxic_texts),
    ("exact_dedup", exact_copies),
    ("simhash", near_copies),
    ("decontaminate", benchmark_leaks),
    ("sentencepiece", encoded_texts),
]
#: SQL can't express learned scores, fingerprints or merge-dropout.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each keeps is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
