"""Cluster purity, label maps, dictionaries and lookups."""

import pytest
from pyspark.sql import functions as F

from tagloom.operators import labels as ops
from tagloom.plans.clusters import label_map_job, purity_job


@pytest.fixture(scope="module")
def clustered(spark):
    rows = [(0, 1), (0, 1), (0, 0), (1, 0), (1, 1), (-1, 1), (None, 1), (0, None)]
    return spark.createDataFrame(rows, "cluster_id bigint, label bigint")


@pytest.fixture(scope="module")
def centroids(spark):
    return spark.createDataFrame([(0, [0.0], 9.0), (1, [1.0], 9.0), (2, [2.0], 9.0)], "cluster_id bigint, center array<double>, purity double")


def as_dict(df):
    return {r[0]: r[1] for r in df.collect()}


def test_purity_counts_cluster_minus_one(clustered):
    """T10: the cluster of invalid vectors takes part."""
    assert as_dict(ops.cluster_purity(clustered)) == pytest.approx({0: 2 / 3, 1: 0.5, -1: 1.0})


def test_purity_joins_centroids_and_replaces(clustered, centroids):
    rated = purity_job(clustered, centroids, label="label")
    assert rated.columns == ["cluster_id", "center", "purity"]
    assert as_dict(rated.select("cluster_id", "purity")) == {0: pytest.approx(2 / 3), 1: 0.5, 2: None}
    missing = ops.centroids_without_purity(centroids, ops.cluster_purity(clustered))
    assert [r[0] for r in missing.collect()] == [2]


def test_missing_column_is_named(clustered, centroids):
    with pytest.raises(ValueError, match="teacher"):
        purity_job(clustered, centroids, label="teacher")


def test_label_map_ties_take_smaller_label(clustered, tmp_path):
    assert as_dict(ops.majority_labels(clustered)) == {0: 1, 1: 0, -1: 1}
    assert as_dict(ops.majority_labels(clustered, exclude_invalid=True)) == {0: 1, 1: 0}
    label_map_job(clustered, output_path=str(tmp_path / "m.yaml"))
    assert (tmp_path / "m.yaml").read_text() == "-1: 1\n0: 1\n1: 0\n"
    label_map_job(clustered, output_path=str(tmp_path / "m.json"))
    assert '"-1": 1' in (tmp_path / "m.json").read_text()
    with pytest.raises(ValueError, match="empty map"):
        label_map_job(clustered.limit(0), output_path=str(tmp_path / "e.json"))


def test_label_map_skips_values_that_are_no_integers(spark):
    rows = spark.createDataFrame([("1", "3"), ("1", "3"), ("x", "3"), ("1", "1.7"), ("1", "abc")], "cluster_id string, label string")
    assert as_dict(ops.majority_labels(rows)) == {1: 3}
    assert {tuple(r) for r in ops.cluster_label_counts(rows).collect()} == {(1, "3", 2), (1, "1.7", 1), (1, "abc", 1)}


def test_lookup_must_be_unique(spark, clustered):
    twice = spark.createDataFrame([(0, 1), (0, 2)], "cluster_id bigint, other bigint")
    for limit in (100, 1):
        with pytest.raises(ValueError, match="more than one row"):
            ops.lookup_join(clustered, twice, "cluster_id", max_rows=limit)


def test_lookup_gives_the_same_rows_whatever_its_size(clustered):
    labels = ops.majority_labels(clustered).withColumnRenamed("label", "mapped")
    small = ops.lookup_join(clustered, labels, "cluster_id")
    large = ops.lookup_join(clustered, labels, "cluster_id", max_rows=1)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_label_lookup_leaves_unknown_clusters_empty(spark, clustered):
    rows = spark.createDataFrame([(0,), (7,)], "cluster_id bigint")
    assert as_dict(ops.label_lookup(rows, ops.majority_labels(clustered))) == {0: 1, 7: None}


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_dictionary_sorts_by_native_type(spark, limit):
    """T5: 10 comes after 2."""
    ints = spark.createDataFrame([(10,), (2,), (1,), (2,)], "label int")
    assert as_dict(ops.label_dictionary([ints], max_group_rows=limit)) == {1: 0, 2: 1, 10: 2}
    texts = spark.createDataFrame([("b",), ("a",)], "label string")
    assert as_dict(ops.label_dictionary([texts, texts], max_group_rows=limit)) == {"a": 0, "b": 1}


def test_encoding_round_trip_and_unknown_labels(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("b",)], "label string")
    dictionary = ops.label_dictionary([rows])
    coded = ops.encode_labels(rows, dictionary)
    assert sorted(r.label_id for r in coded.collect()) == [0, 1, 1]
    assert sorted(r.label for r in ops.decode_labels(coded.select("label_id"), dictionary).collect()) == ["a", "b", "b"]
    assert ops.num_classes(dictionary) == 2
    with pytest.raises(Exception, match="unknown label: c"):
        ops.encode_labels(spark.createDataFrame([("c",)], "label string"), dictionary).collect()


def test_whole_labels_reject_other_values(spark):
    bad = spark.createDataFrame([("x",)], "label string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ops.label_dictionary([bad], whole=True).collect()


def test_remap(spark):
    rows = spark.createDataFrame([(0,), (1,)], "pred int")
    assert as_dict(ops.remap_predictions(rows, {0: 5, 1: 6})) == {0: 5, 1: 6}
    with pytest.raises(Exception, match="no mapping for prediction 1"):
        ops.remap_predictions(rows, {0: 5}).collect()


def test_class_sizes(spark):
    rows = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [(None,)], "label string")
    assert ops.class_size_range(rows) == (2, 5, 2)
    assert ops.class_size_range(rows.filter(F.lit(False))) == (0, 0, 0)
