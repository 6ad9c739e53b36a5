import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from labelwright.functions.labels import encode, vocabulary
from labelwright.functions.scaling import fit_scaler
from labelwright.operators import checks as K
from labelwright.operators import metrics as M
from labelwright.operators.centroid import fit_centroids
from labelwright.operators.split import class_quotas, stratified_folds, train_test_split
from labelwright.spec import LabelledSpec
from tests.conftest import CLUSTERS


def test_split_is_exact_and_in_proportion(clean):
    split = train_test_split(clean, CLUSTERS)
    counts = {(r.target, r.is_test): r["count"] for r in split.groupBy("target", "is_test").count().collect()}
    assert counts == {(c, t): 10 if t else 40 for c in "ABC" for t in (True, False)}


def test_test_rows_round_up():
    assert class_quotas({"a": 5, "b": 5, "c": 5}, 4) == {"a": 2, "b": 1, "c": 1}
    assert sum(class_quotas({"a": 7, "b": 1}, 2).values()) == 2


def test_plain_split_has_the_exact_size(clean):
    assert train_test_split(clean, CLUSTERS, 0.33, stratify=False).where("is_test").count() == 50


def test_split_and_folds_ignore_partitioning(clean):
    spread = clean.repartition(9)
    for build in (train_test_split, stratified_folds):
        a, b = build(clean, CLUSTERS), build(spread, CLUSTERS)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_folds_of_small_and_sparse_classes(spark):
    ids = [5, 9, 2**40, -7, 13, 21, 22]
    df = spark.createDataFrame([(i, 1.0, "a" if n < 3 else "b") for n, i in enumerate(ids)], "id bigint, f double, label string")
    spec = LabelledSpec.of(df, "id")
    ours = {(r.id, r.fold) for r in stratified_folds(df, spec).collect()}
    theirs = {
        (r.id, r.fold)
        for r in df.selectExpr("id", "ntile(5) over (partition by label order by id) as fold").collect()
    }
    assert ours == theirs


def test_scaled_columns_are_centred_with_population_spread(clean):
    scaled = fit_scaler(clean, CLUSTERS.feature_cols).transform(clean)
    row = scaled.agg(F.avg("feature1").alias("m"), F.stddev_pop("feature1").alias("s")).first()
    assert abs(row.m) < 1e-9 and abs(row.s - 1) < 1e-9


def test_constant_column_scales_to_zero(spark):
    df = spark.range(10).select("id", F.lit(3.0).alias("f"))
    assert fit_scaler(df, ("f",)).transform(df).where("f <> 0").isEmpty()


def test_unseen_label_is_an_error(spark, clean):
    labels = vocabulary(clean, "target")
    assert labels == ["A", "B", "C"]
    with pytest.raises(Exception, match="vocabulary"):
        spark.createDataFrame([("Z",)], "t string").select(encode(F.col("t"), labels)).collect()


def scored(spark, rows):
    return spark.createDataFrame(rows, "id bigint, label string, prediction string, probs array<double>")


def test_averages_by_hand(spark):
    rows = [(1, "a", "a"), (2, "a", "b"), (3, "b", "b"), (4, "c", "b")]
    df = scored(spark, [(i, t, p, [1.0, 0.0, 0.0]) for i, t, p in rows])
    got = {r.metric: r.value for r in M.classification_metrics(df).collect()}
    assert got["accuracy"] == got["precision_micro"] == got["recall_micro"] == got["f1_micro"] == 0.5
    assert got["precision_macro"] == pytest.approx((1 + 1 / 3 + 0) / 3)
    assert got["recall_macro"] == pytest.approx((0.5 + 1 + 0) / 3)
    assert got["f1_macro"] == pytest.approx((2 / 3 + 0.5 + 0) / 3)
    assert got["f1_weighted"] == pytest.approx((2 * 2 / 3 + 0.5 + 0) / 4)


def test_confusion_keeps_empty_cells(spark):
    df = scored(spark, [(1, "a", "a", [1.0])])
    cells = {(r.label, r.prediction): r.n for r in M.confusion_matrix(df, ["a", "b"]).collect()}
    assert cells == {("a", "a"): 1, ("a", "b"): 0, ("b", "a"): 0, ("b", "b"): 0}


def pairwise_auc(score, positive):
    pos, neg = score[positive], score[~positive]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("places", [1, 6])
def test_auc_equals_all_pairs(spark, places):
    rng = np.random.default_rng(places)
    truth = rng.choice(["a", "b", "c"], 400)
    probs = np.round(rng.dirichlet(np.ones(3), 400), places)
    df = scored(spark, [(i, str(t), "a", [float(v) for v in p]) for i, (t, p) in enumerate(zip(truth, probs))])
    got = {r["class"]: r.auc for r in M.roc_auc_ovr(df, ["a", "b", "c"]).collect()}
    want = [pairwise_auc(probs[:, i], truth == c) for i, c in enumerate("abc")]
    assert [got[c] for c in "abc"] == pytest.approx(want)
    assert got["macro"] == pytest.approx(np.mean(want))


def test_auc_needs_three_classes(spark):
    df = scored(spark, [(1, "a", "a", [0.9, 0.1]), (2, "b", "b", [0.2, 0.8])])
    assert M.roc_auc_ovr(df, ["a", "b"]).isEmpty()


def test_low_confidence_bound_is_strict(spark):
    df = scored(spark, [(1, "a", "a", [0.6, 0.4]), (2, "a", "a", [0.5, 0.5])])
    row = M.low_confidence(df).first()
    assert (row["count"], row.percentage, row.threshold) == (1, 50.0, 0.6)


def test_centroids_of_held_out_runs_equal_a_fit_without_them(clean):
    folded = stratified_folds(clean, CLUSTERS)
    together = fit_centroids(folded, CLUSTERS, by="fold", held_out=True)
    alone = fit_centroids(folded.where("fold <> 2"), CLUSTERS)
    for a, b in zip(together.runs["2"], alone.runs[""]):
        assert np.allclose(a, b)


def test_checks(spark, clean):
    passed = lambda df: {r["column"]: r.passed for r in df.collect()}
    assert all(passed(K.check_nulls(clean)).values())
    assert passed(K.check_columns(clean, ["id", "feature1", "feature2", "target"])) == {
        c: True for c in clean.columns
    }
    assert passed(K.check_columns(clean, ["id", "other"]))["other"] is False
    assert all(passed(K.check_numeric(clean, CLUSTERS)).values())
    assert passed(K.check_cardinality(clean, CLUSTERS, 4)) == {"target": False}
    assert all(passed(K.check_balance(clean, CLUSTERS)).values())
    holes = clean.withColumn("feature1", F.expr("if(id = 1, null, feature1)"))
    assert passed(K.check_nulls(holes))["feature1"] is False


def test_correlation_of_awkward_columns(spark):
    rng = np.random.default_rng(1)
    data = pd.DataFrame(rng.normal(size=(200, 25)), columns=[f"f{i}" for i in range(25)])
    data["f1"] = 1e6 + data["f0"] * 2 + data["f1"] * 0.1
    data["f2"] = 7.5
    data.loc[::3, "f3"] = np.nan
    df = spark.createDataFrame(data).withColumn("f4", F.when(F.col("f5") > 0, F.col("f4")))
    for names in (tuple(data.columns[:6]), tuple(data.columns)):
        got = {(r.feature_a, r.feature_b): r for r in K.correlation_matrix(df, names).collect()}
        assert len(got) == len(names) ** 2
        want = df.select(*names).toPandas().corr(min_periods=2)
        for (a, b), r in got.items():
            if "f2" in (a, b):
                assert r["corr"] is None and not r.well_formed
            else:
                assert abs(r["corr"] - want.loc[a, b]) < 1e-9 and r.well_formed


def test_missing_values_are_seen(spark):
    passed = lambda df: {r["column"]: r.passed for r in df.collect()}
    df = spark.createDataFrame([(1, 1.0, "a"), (2, 5.0, "a"), (3, float("nan"), "a"), (4, None, "b")], "id long, x double, label string")
    assert passed(K.check_nulls(df)) == {"id": True, "x": False, "label": True}
    with pytest.raises(ValueError, match="missing"):
        fit_scaler(df.where("id < 4"), ("x",))
    bins = {(r.label, r.bin): r.n for r in K.class_histogram(df, "x", "label", 4).collect()}
    assert bins == {("a", 0): 1, ("a", 3): 1, ("a", None): 1, ("b", None): 1}


def test_histogram_of_a_constant_class(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 0.0), ("b", 2.0)], "label string, x double")
    bins = {(r.label, r.bin): r.n for r in K.class_histogram(df, "x", "label").collect()}
    assert bins == {("a", 10): 2, ("b", 0): 1, ("b", 19): 1}
