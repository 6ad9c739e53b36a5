"""Exact ranks, dictionaries without a bound, components of wide tables, permutation importance."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelwright.operators import components as C
from labelwright.operators.dictionary import decode_labels, encode_labels, label_dictionary
from labelwright.operators.importance import permutation_importance, shifted
from labelwright.operators.ranks import ranked
from tests.conftest import CLUSTERS, clusters


def test_ranks_are_places_in_the_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit("x").alias("rank_of")).repartition(9)
    got = ranked(df, ["k"]).collect()
    assert all(r["rank"] == r.k + 1 for r in got) and len(got) == 5000
    assert ranked(df.limit(0), ["k"]).count() == 0


def test_a_hundred_thousand_classes_encode(spark):
    df = spark.range(130_000).select(F.concat(F.lit("c"), (F.col("id") % 100_000).cast("string")).alias("label"), "id")
    dictionary = label_dictionary(df, label_col="label")
    encoded = encode_labels(df, "label", dictionary)
    facts = encoded.agg(F.count_distinct("label_idx").alias("n"), F.min("label_idx").alias("low"), F.max("label_idx").alias("high")).first()
    assert tuple(facts) == (100_000, 0, 99_999)
    back = decode_labels(encoded, "label_idx", dictionary, "again")
    assert back.where("label != again or again is null").isEmpty()
    first = {r.label: r.label_idx for r in dictionary.where("label_idx < 3").collect()}
    assert list(first) == sorted(first, key=first.get) and first == {"c0": 0, "c1": 1, "c10": 2}


def test_nulls_new_labels_and_several_versions(spark):
    one = spark.createDataFrame([("b",), (None,), ("é",)], "label string")
    two = spark.createDataFrame([("a",), ("b",)], "label string")
    dictionary = label_dictionary(one, two, label_col="label")
    assert [(r.label, r.label_idx) for r in dictionary.orderBy("label_idx").collect()] == [("a", 0), ("b", 1), ("é", 2)]
    assert {(r.label, r.label_idx) for r in encode_labels(one, "label", dictionary).collect()} == {("b", 1), (None, None), ("é", 2)}
    with pytest.raises(Exception, match="not in the vocabulary"):
        encode_labels(one, "label", label_dictionary(two, label_col="label")).collect()
    assert label_dictionary(one.limit(0), label_col="label").count() == 0
    with pytest.raises(ValueError):
        label_dictionary(label_col="label")


@pytest.mark.parametrize("dims, k", [(3, 2), (40, 5), (200, 3)])
def test_components_equal_numpy(spark, dims, k):
    rng = np.random.default_rng(dims)
    x = rng.normal(size=(500, dims)) @ np.diag(np.linspace(3, 0.5, dims)) + rng.normal(size=dims) * 10
    df = spark.createDataFrame([([float(v) for v in row],) for row in x], "x array<double>").repartition(4)
    found = C.principal_components(df, k)
    centred = x - x.mean(axis=0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    assert np.allclose(found.variances, s[:k] ** 2 / 499, rtol=1e-8)
    assert np.allclose(np.abs((found.axes * vt[:k]).sum(axis=1)), 1.0, atol=1e-6)
    assert found.total_variance == pytest.approx((s**2).sum() / 499)
    assert found.residual <= C.TOLERANCE and found.skew < 1e-9
    assert sum(found.ratios) < 1.0 + 1e-9
    got = np.array([r.p for r in df.select("x", found.project(F.col("x")).alias("p")).collect()])
    assert np.allclose(sorted(np.abs(got[:, 0])), sorted(np.abs(centred @ found.axes[0])), atol=1e-9)


def test_components_of_flat_and_empty_tables(spark):
    same = spark.createDataFrame([([1.0, 2.0, 3.0],)] * 9, "x array<double>")
    found = C.principal_components(same, 2)
    assert np.allclose(found.variances, 0) and found.ratios == [0.0, 0.0]
    with pytest.raises(ValueError):
        C.principal_components(same.limit(0), 1)
    with pytest.raises(ValueError):
        C.principal_components(same, 4)


def test_shift_keeps_the_values(spark):
    df = spark.createDataFrame(clusters())
    moved = shifted(df, "id", "feature1").toPandas().set_index("id")["feature1"]
    own = clusters().set_index("id")["feature1"]
    assert sorted(moved) == sorted(own) and (moved.sort_index().to_numpy() != own.to_numpy()).all()
    again = shifted(df.repartition(7), "id", "feature1").toPandas().set_index("id")["feature1"]
    assert moved.sort_index().equals(again.sort_index())


def test_importance_falls_on_the_feature_that_is_used(spark):
    df = spark.createDataFrame(clusters())
    rule = lambda d: d.withColumn("prediction", F.when(F.col("feature2") > 2.5, F.when(F.col("feature1") > 2.5, "B").otherwise("C")).otherwise("A"))
    got = {r.feature: r for r in permutation_importance(rule, df, CLUSTERS).collect()}
    assert got["feature1"].accuracy > 0.99
    assert got["feature2"].importance > 0.2 and got["feature1"].importance > 0.1
    blind = permutation_importance(lambda d: d.withColumn("prediction", F.lit("A")), df, CLUSTERS).collect()
    assert all(r.importance == 0 for r in blind)
