import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelwright.operators import models as M
from labelwright.operators.compare import best_model, model_comparison, robustness, worst_metric
from labelwright.operators.metrics import classification_metrics
from labelwright.operators.noise import fit_label_noise
from labelwright.operators.split import train_test_split
from labelwright.sources import scratch
from labelwright.sources import tables as S
from labelwright.spec import LabelledSpec, Params
from tests.conftest import CLUSTERS, clusters

QUICK = Params(trees=10, max_depth=5, max_iter=30, svm_iter=10, folds=2)


def accuracy(metrics):
    return metrics.where("metric = 'accuracy'").first().value


@pytest.mark.parametrize("name", M.MODELS)
def test_each_model_learns_the_clusters(clean, name):
    split = scratch.store(train_test_split(clean, CLUSTERS), "split")
    _, metrics = M.train_single(name, split, CLUSTERS, QUICK, cv=False)
    assert accuracy(metrics) > 0.9


def test_unknown_model(clean):
    with pytest.raises(ValueError, match="unknown"):
        M.fit_model("tree", clean, CLUSTERS)


def test_train_all_records_failures(clean, monkeypatch):
    models, metrics, errors = M.train_all(
        clean, CLUSTERS, QUICK, names=(M.LOGISTIC, "missing"), cv=True
    )
    assert list(models) == [M.LOGISTIC] and list(errors) == ["missing"]
    names = {r.metric for r in metrics.collect()}
    assert {"accuracy", "f1_macro", "cv_mean", "cv_std"} <= names
    assert best_model(metrics).first().model == M.LOGISTIC
    assert {r.title for r in model_comparison(metrics).collect()} >= {"Accuracy", "F1 Macro", "Cv Mean"}


def test_saved_model_scores_alike_with_its_own_scaler(clean, tmp_path):
    model = M.fit_model(M.LOGISTIC, clean.where("id % 2 = 0"), CLUSTERS, QUICK)
    M.save_model(model, str(tmp_path / "m"))
    loaded = M.load_model(str(tmp_path / "m"))
    a, b = (M.score_model(m, clean, CLUSTERS) for m in (model, loaded))
    assert M.vocabulary_of(loaded) == ["A", "B", "C"]
    assert a.exceptAll(b).isEmpty()
    assert a.where("abs(aggregate(probs, 0D, (s, p) -> s + p) - 1) > 1e-9").isEmpty()


def test_noise_in_training_costs_little_at_five_percent(clean):
    split = scratch.store(train_test_split(clean, CLUSTERS), "split")
    noisy = scratch.store(fit_label_noise(split, CLUSTERS, (0.05,)).flip(split, 0.05), "noisy")
    test = split.where("is_test")
    scores = []
    for train in (split, noisy):
        model = M.fit_model(M.RANDOM_FOREST, train.where("not is_test"), CLUSTERS, QUICK)
        scores.append(accuracy(classification_metrics(M.score_model(model, test, CLUSTERS))))
    assert scores[0] > 1 / 3 + 0.2 and -0.1 <= scores[0] - scores[1] < 0.4


def test_pca_equals_numpy(clean):
    pdf = clusters()
    x = pdf[["feature1", "feature2"]].to_numpy()
    centred = x - x.mean(axis=0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    projected, ratio = M.pca_projection(clean, {}, CLUSTERS)
    got = projected.orderBy("id").toPandas()[["pc1", "pc2"]].to_numpy()
    assert np.allclose(np.abs(got), np.abs(centred @ vt.T), atol=1e-8)
    assert ratio == pytest.approx(list(s**2 / (s**2).sum()))


def test_csv_round_trip_takes_the_last_column_as_label(spark, clean, tmp_path):
    path = str(tmp_path / "c.csv")
    clean.write.option("header", True).csv(path)
    df, spec = S.scan_labelled(
        spark, path, "id", schema="id bigint, feature1 double, feature2 double, target string", fmt="csv"
    )
    assert spec == CLUSTERS and df.count() == 150
    inferred, _ = S.scan_labelled(spark, path, "id", fmt="csv")
    assert dict(inferred.dtypes)["feature1"] == "double"


def test_missing_file_and_bad_columns(spark, clean):
    with pytest.raises(Exception):
        S.scan_labelled(spark, "/nowhere.parquet", "id")
    with pytest.raises(ValueError):
        LabelledSpec.of(clean, "nothing")
    with pytest.raises(ValueError, match="numeric"):
        LabelledSpec("id", ("target",), "feature1").check(clean)


def test_noise_run_writes_levels_and_metadata(spark, clean, tmp_path):
    noise = fit_label_noise(clean, CLUSTERS, (0.001, 0.1, 0.5))
    metadata = S.noise_run(clean, noise, str(tmp_path / "run"), "clusters")
    assert {(r.noise_level, r.noisy_rows) for r in metadata.collect()} == {(0.001, 0), (0.1, 15), (0.5, 75)}
    folders = os.listdir(tmp_path / "run" / "data")
    assert {"noise_level=0.001", "noise_level=0.1", "noise_level=0.5"} <= set(folders)
    one = spark.read.parquet(str(tmp_path / "run" / "data")).where("noise_level = 0.1")
    assert one.count() == 150 and "PartitionFilters: [isnotnull(noise_level" in one._jdf.queryExecution().toString()


def test_dataset_names_come_from_files(spark, clean, tmp_path):
    clean.toPandas().to_parquet(tmp_path / "first.set.parquet")
    df = S.with_dataset_name(spark.read.parquet(str(tmp_path / "first.set.parquet")))
    assert df.first().dataset == "first.set"


def test_run_log_appends(spark, tmp_path):
    path = str(tmp_path / "runs")
    metrics = spark.createDataFrame([("accuracy", 0.5)], "metric string, value double")
    for run in ("r1", "r2"):
        S.log_run(spark, path, run, "svm", "clean", {"train_size": 120, "model_c": 1.0}, metrics)
    rows = S.read_runs(spark, path)
    assert rows.count() == 6 and rows.where("kind = 'metric' and cast(value as double) = 0.5").count() == 2


def test_results_skip_missing_levels(spark, tmp_path):
    for level in (0.1, 0.5):
        (tmp_path / f"noise_{level}.json").write_text(json.dumps({"noise_level": level, "accuracy": 1 - level}))
    assert [r.accuracy for r in S.read_results(spark, str(tmp_path)).orderBy("noise_level").collect()] == [0.9, 0.5]


def test_report_has_time_results_and_summary(spark, tmp_path):
    drops = spark.createDataFrame([("accuracy", 5.0), ("f1_macro", 7.0)], "metric string, relative_drop_pct double")
    S.write_report(drops, worst_metric(drops), str(tmp_path / "report"))
    rows = spark.read.json(str(tmp_path / "report")).collect()
    assert {r.section for r in rows} == {"results", "summary"} and all(r.evaluation_timestamp for r in rows)
    summary = json.loads([r.body for r in rows if r.section == "summary"][0])
    assert summary == {"metric": "f1_macro", "drop_percentage": 7.0}


def test_robustness_of_a_zero_metric(spark):
    df = spark.createDataFrame([("accuracy", 0.0), ("accuracy", 0.0)], "metric string, value double")
    assert robustness(df).first().coefficient_of_variation == 0.0


class FakeSession:
    """Stands for a cluster session; the real setting is fixed when a session starts."""

    def __init__(self, folder, master):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})()


def test_scratch_takes_the_named_folder():
    assert scratch.root(FakeSession("hdfs://shared/tmp/", "yarn")) == "hdfs://shared/tmp"


def test_scratch_refuses_a_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.root(FakeSession(None, "yarn"))


def test_scratch_forgets_what_it_stored(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "root", lambda spark: str(tmp_path))
    scratch.discard(spark)
    stored = scratch.store(spark.range(3), "numbers")
    assert stored.inputFiles()[0].startswith(f"file://{tmp_path}/numbers-")
    assert scratch.discard(spark) == 1 and not [f for f in os.listdir(tmp_path) if "numbers" in f]
