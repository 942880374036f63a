"""Scoring with a plugged-in model, records, CSV, validation and the stream."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.catalog import jobs
from tagloom.operators import scoring as ops
from tagloom.plans.csv_scoring import score_csv
from tagloom.plans.evaluate import run_validation, validate_predictions
from tagloom.sources.tables import dense_mapping, write_csv
from tagloom.streaming.incremental import arriving_files, score_arriving


def length_model():
    """Built inside a function, so that it travels to the workers by value."""

    def load():
        def scorer(texts):
            if any("boom" in t for t in texts):
                raise RuntimeError("cannot read boom")
            size = np.array([float(len(t)) for t in texts])
            return size[:, None], np.stack([size, np.full(len(texts), 5.0)], axis=1)

        return scorer

    return load


load_model = length_model()


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(1, "long enough"), (2, "hi"), (3, "a boom"), (4, "fives")], "id bigint, text string")


@pytest.mark.parametrize("batch_size", [1, 2, 64])
def test_scores_and_failures(texts, batch_size):
    scored = ops.score_texts(texts.coalesce(1), load_model, batch_size=batch_size)
    good = {r.id: r for r in ops.without_failures(scored).collect()}
    assert {k: r.label for k, r in good.items()} == {1: 0, 2: 1, 4: 0}
    assert good[2].cls == [2.0] and sum(good[2].probs) == pytest.approx(1) and good[4].probs == [0.5, 0.5]
    assert [tuple(r) for r in ops.failures(scored, "id").collect()] == [(3, "RuntimeError: cannot read boom")]


def test_prediction_record(spark):
    rows = spark.createDataFrame([(1, [0.123449, 0.876551])], "id int, probs array<double>")
    record = ops.prediction_record(rows, ["neg", "pos"], keep=["id"])
    assert record.first().asDict() == {"id": 1, "prediction": "pos", "neg": 0.1234, "pos": 0.8766}
    with pytest.raises(Exception, match="expected 3 probabilities"):
        ops.prediction_record(rows, ["a", "b", "c"]).collect()
    for bad in ([], ["a", " "]):
        with pytest.raises(ValueError):
            ops.prediction_record(rows, bad)


def test_csv_job(spark, tmp_path):
    source, target = str(tmp_path / "in.csv"), str(tmp_path / "out.csv")
    rows = [("1", 'say "hi",\nthen leave'), ("2", None), ("3", "x"), ("4", "NA")]
    write_csv(spark.createDataFrame(rows, "ID string, text string"), source)
    score_csv(spark, source, load_model, ["long", "short"], output_path=target)
    out = spark.read.csv(target, header=True)
    assert out.columns == ["ID", "label"]
    assert {r.ID: r.label for r in out.collect()} == {"1": "long", "2": "short", "3": "short", "4": "short"}


def test_csv_checks(spark, tmp_path):
    with pytest.raises(ValueError, match="end in .csv"):
        score_csv(spark, str(tmp_path / "x.parquet"), load_model, ["a"])
    (tmp_path / "cols.csv").write_text("ID,words\n1,a\n")
    with pytest.raises(ValueError, match="text"):
        score_csv(spark, str(tmp_path / "cols.csv"), load_model, ["a"])
    (tmp_path / "none.csv").write_text("ID,text\n")
    with pytest.raises(ValueError, match="no rows"):
        score_csv(spark, str(tmp_path / "none.csv"), load_model, ["a"])


def test_validation_job(spark, tmp_path):
    path = str(tmp_path / "data.parquet")
    spark.createDataFrame([("long enough", 0), ("hi", 1), ("ho", 0)], "text string, label int").write.parquet(path)
    metrics = run_validation(spark, path, load_model, output_json=str(tmp_path / "m")).first()
    assert metrics.accuracy == pytest.approx(2 / 3) and metrics.macro_f1 == pytest.approx(2 / 3)
    line = next((tmp_path / "m").glob("part-*")).read_text()
    assert json.loads(line)["accuracy"] == pytest.approx(2 / 3)
    turned = validate_predictions(spark.read.parquet(path), load_model, mapping={"0": 1, "1": 0}).first()
    assert turned.accuracy == pytest.approx(1 / 3)
    with pytest.raises(ValueError, match="not from"):
        run_validation(spark, "x.json", load_model)
    with pytest.raises(ValueError, match="label"):
        validate_predictions(spark.read.parquet(path).drop("label"), load_model)


def test_mapping_keys_must_be_dense():
    with pytest.raises(ValueError, match=r"\[1\]"):
        dense_mapping({"0": 1, "2": 1})


def test_stream_goes_on_where_it_stopped(spark, texts, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def run():
        stream = arriving_files(spark, source, texts.schema)
        score_arriving(stream, load_model, out, progress).awaitTermination()
        return sorted((r.id, r.label) for r in spark.read.parquet(out).collect() if r.error is None)

    texts.coalesce(1).write.parquet(source)
    assert run() == [(1, 0), (2, 1), (4, 0)]
    texts.select((F.col("id") + 10).alias("id"), "text").coalesce(1).write.mode("append").parquet(source)
    assert run() == [(1, 0), (2, 1), (4, 0), (11, 0), (12, 1), (14, 0)]
    assert len(run()) == 6


def test_csv_stream(spark, tmp_path):
    source = tmp_path / "csv"
    source.mkdir()
    (source / "a.csv").write_text('ID,text\n1,"a\nb"\n2,long enough\n')
    stream = arriving_files(spark, str(source), spark.createDataFrame([], "ID string, text string").schema, fmt="csv")
    score_arriving(stream, load_model, str(tmp_path / "o"), str(tmp_path / "p")).awaitTermination()
    assert {r.ID: r.label for r in spark.read.parquet(str(tmp_path / "o")).collect()} == {"1": 1, "2": 0}


def test_csv_validation_knows_missing_cells(spark, tmp_path):
    path = tmp_path / "v.csv"
    path.write_text('text,label\nNA,1\nlong enough,0\n"  hi    ",0\n,1\n')
    assert run_validation(spark, str(path), load_model).first().accuracy == 1.0


def test_the_stream_scores_missing_texts_as_the_batch_job_does(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([(1, None), (2, "long enough")], "id bigint, text string").write.parquet(source)
    stream = arriving_files(spark, source, spark.read.parquet(source).schema)
    score_arriving(stream, load_model, str(tmp_path / "o"), str(tmp_path / "p")).awaitTermination()
    got = {r.id: (r.text, r.label, r.error) for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    assert got == {1: ("nan", 1, None), 2: ("long enough", 0, None)}


def test_stream_query_reads_a_table_in_one_file_or_many(spark, tmp_path):
    """A table of one file and one that is a folder of part files give the same rows."""
    rows = [(i, i % 3, "user", f"some words {i}!") for i in range(40)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    parts, single = tmp_path / "parts", tmp_path / "single"
    table.repartition(3).write.parquet(str(parts / "conversations.parquet"))
    table.coalesce(1).write.parquet(str(tmp_path / "whole"))
    single.mkdir()
    next((tmp_path / "whole").glob("part-*.parquet")).rename(single / "conversations.parquet")
    found = [sorted(map(tuple, jobs.stream_scoring(spark, str(sf)).collect())) for sf in (parts, single)]
    assert found[0] == found[1] and [r[:2] for r in found[0]] == sorted(r[:2] for r in rows)
