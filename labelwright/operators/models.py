"""Trained classifiers.

The whole preparation is part of the saved model: the label index is fitted in
label order, the scaling uses the population deviation, and both come from the
training rows only. All folds of a model are fitted together: the linear models and the kernel
machine with one scan of the table per step, forests with one per level.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass
from functools import partial

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from labelwright.functions.labels import literal_array, vocabulary
from labelwright.functions.scaling import Scaler, fit_scaler
from labelwright.operators.compare import cv_summary
from labelwright.operators import parallel as P
from labelwright.operators.components import principal_components
from labelwright.operators.forest import ForestModel, StoredForest, grow_forests, row_key
from labelwright.operators.metrics import classification_metrics
from labelwright.operators.split import stratified_folds, train_test_split
from labelwright.sources.scratch import store
from labelwright.sources.tables import log_run
from labelwright.spec import LabelledSpec, Params

RANDOM_FOREST = "random_forest"
KERNEL_SVM = "svm"
LOGISTIC = "logistic_regression"
MODELS = (RANDOM_FOREST, KERNEL_SVM, LOGISTIC)


#: What is fitted: a pipeline, or a forest with the same use; those of folds stay tables.
Model = PipelineModel | ForestModel | StoredForest


def scaling_stage(scaler: Scaler) -> SQLTransformer:
    """The fitted scaler as a persistable stage; columns z_0, z_1, …"""
    parts = [
        f"(CAST(`{c}` AS DOUBLE) - CAST({m!r} AS DOUBLE)) / CAST({s!r} AS DOUBLE) AS z_{i}"
        for i, (c, m, s) in enumerate(zip(scaler.cols, scaler.means, scaler.stds))
    ]
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def _numbers(values: np.ndarray) -> str:
    """An array literal of any depth; every digit is kept."""
    depth = np.ndim(values)
    return f"from_json('{json.dumps(np.asarray(values).tolist())}', '{'array<' * depth}double{'>' * depth}')"


def _select(*columns: str) -> SQLTransformer:
    return SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")


def _scores(inputs: list[str], weights: np.ndarray) -> list[SQLTransformer]:
    """Probabilities and prediction from linear scores of the input columns and the constant."""
    array = f"array({', '.join(inputs)})"
    dot = "aggregate(zip_with({x}, {w}, (a, b) -> a * b), {c!r}D, (s, v) -> s + v)"
    logits = ", ".join(dot.format(x=array, w=_numbers(w[:-1]), c=float(w[-1])) for w in weights)
    shares = "transform(logits_, v -> exp(v - array_max(logits_)))"
    total = "aggregate(weights_, 0D, (s, v) -> s + v)"
    each = [f"weights_[{k}] / {total} AS p_{k}" for k in range(len(weights))]
    best = "CAST(array_position(logits_, array_max(logits_)) - 1 AS DOUBLE) AS prediction_idx"
    return [_select(f"array({logits}) AS logits_"), _select(f"{shares} AS weights_"), _select(*each, best)]


def _pipeline(labels: list[str], spec: LabelledSpec, base: P.Standard, stages: list) -> PipelineModel:
    index = StringIndexerModel.from_labels(labels, inputCol=spec.label_col, outputCol="label_idx", handleInvalid="error")
    scaler = Scaler(spec.feature_cols, tuple(map(float, base.means)), tuple(map(float, base.stds)))
    probability = VectorAssembler(inputCols=[f"p_{k}" for k in range(len(labels))], outputCol="probability")
    return PipelineModel(stages=[index, scaling_stage(scaler), *stages, probability])


def _kernel_stages(landmarks: P.Landmarks, margins: np.ndarray) -> list[SQLTransformer]:
    """Margins of the kernel machine: the weights of the features become weights of the landmarks."""
    z = " + ".join(f"(z_{i} - l[{i}]) * (z_{i} - l[{i}])" for i in range(landmarks.points.shape[1]))
    near = f"transform({_numbers(landmarks.points)}, l -> exp(-{landmarks.gamma!r}D * ({z}))) AS kernel_"
    columns = [
        f"aggregate(zip_with(kernel_, {_numbers(landmarks.root @ w[:-1])}, (a, b) -> a * b), {float(w[-1])!r}D, (s, v) -> s + v) AS margin_{k}"
        for k, w in enumerate(margins)
    ]
    return [_select(near), _select(*columns)]


@dataclass(frozen=True)
class Run:
    """A fitted model, the softmax weights of its scores, and facts about the fit by name."""

    model: Model
    weights: np.ndarray | None = None
    facts: dict[str, float] | None = None


def _linear_runs(name: str, folded: DataFrame, spec: LabelledSpec, params: Params, runs: tuple[int, ...]) -> dict[int, Run]:
    """The logistic model or the kernel machine on every run of (…, fold), all at once."""
    labels = vocabulary(folded, spec.label_col, params.max_classes)
    if len(labels) < 2:
        raise ValueError(f"{name} needs at least two classes, found {labels}")
    table = _training(folded, spec, labels)
    maps, rows = P.standards(table, runs, len(spec.feature_cols))
    inputs = [f"z_{i}" for i in range(len(spec.feature_cols))]
    if name == LOGISTIC:
        penalty = {r: 1.0 / (params.c * rows[r]) for r in runs}
        fits = P.fit_softmax(table, maps, rows, len(labels), penalty, params.max_iter, params.slope)
        return {
            r: Run(_pipeline(labels, spec, maps[r], _scores(inputs, fits[r].weights)), fits[r].weights, {"slope": fits[r].slope}) for r in runs
        }
    share = min(1.0, P.LANDMARK_ROWS / max(1, max(rows.values())))
    picked = F.pmod(F.xxhash64("id", F.lit(params.seed)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
    sample = table.where(picked).select("x", "y", "fold", "id").limit(2 * P.LANDMARK_ROWS).toPandas().sort_values("id")
    points, y, fold = np.stack(sample["x"].to_numpy()), sample["y"].to_numpy(), sample["fold"].to_numpy()
    landmarks = {r: P.fit_landmarks(maps[r], points[fold != r] if r else points, params.kernel_tolerance) for r in runs}
    margins = P.fit_margins(table, landmarks, rows, len(labels), params.c, params.svm_iter, params.svm_gap, (points, y, fold))
    error = P.kernel_error(table, landmarks, rows)
    # Probabilities of the margins of one class against the rest, as Platt scaling gives them.
    scaled = {r: P.Margins(landmarks[r], margins[r].weights) for r in runs}
    held, columns = P.mapped(table, scaled)
    fits = P.fit_softmax(held, columns, rows, len(labels), {r: 1.0 / rows[r] for r in runs}, params.svm_iter, params.slope)
    out = {}
    for r in runs:
        stages = _kernel_stages(landmarks[r], margins[r].weights) + _scores([f"margin_{k}" for k in range(len(labels))], fits[r].weights)
        facts = {"gap": margins[r].gap, "kernel_error": error[r], "landmarks": float(len(landmarks[r].points))}
        out[r] = Run(_pipeline(labels, spec, maps[r], stages), fits[r].weights, facts)
    return out


def _training(folded: DataFrame, spec: LabelledSpec, labels: list[str]) -> DataFrame:
    """(x, y, fold, id), written once."""
    fit_scaler(folded, spec.feature_cols)  # a missing feature is an error
    x = F.array(*[F.col(c).cast("double") for c in spec.feature_cols])
    y = (F.array_position(literal_array(labels), F.col(spec.label_col).cast("string")) - 1).cast("int")
    return store(folded.select(x.alias("x"), y.alias("y"), F.col("fold").cast("int").alias("fold"), row_key(folded, spec).alias("id")), "training")


def _forest_runs(folded: DataFrame, spec: LabelledSpec, params: Params, runs: tuple[int, ...]) -> dict[int, Run]:
    """Forests of every run, grown together; columns need no scaling there."""
    labels = vocabulary(folded, spec.label_col, params.max_classes)
    table = _training(folded, spec, labels)
    found = grow_forests(table, labels, spec.feature_cols, runs, params.trees, params.max_depth, params.seed)
    return {r: Run(forest if r else forest.load()) for r, forest in found.items()}


def _known(name: str) -> None:
    if name not in MODELS:
        raise ValueError(f"unknown model: {name}")


def fit_runs(name: str, folded: DataFrame, spec: LabelledSpec, params: Params = Params(), whole: bool = True) -> dict[int, Run]:
    """Models by run of a table with a fold: run f has not seen fold f, run 0 (if asked) has seen all rows."""
    _known(name)
    runs = tuple(range(0 if whole else 1, params.folds + 1))
    fit = _forest_runs if name == RANDOM_FOREST else partial(_linear_runs, name)
    return fit(folded, spec, params, runs)


def fit_run(name: str, train: DataFrame, spec: LabelledSpec, params: Params = Params()) -> Run:
    """One model on all rows; an unknown name is an error."""
    _known(name)
    fit = _forest_runs if name == RANDOM_FOREST else partial(_linear_runs, name)
    return fit(train.withColumn("fold", F.lit(0)), spec, params, (0,))[0]


def fit_model(
    name: str, train: DataFrame, spec: LabelledSpec, params: Params = Params()
) -> Model:
    return fit_run(name, train, spec, params).model


def vocabulary_of(model: Model) -> list[str]:
    return list(model.labels if isinstance(model, ForestModel | StoredForest) else model.stages[0].labels)


def score_model(model: Model, df: DataFrame, spec: LabelledSpec) -> DataFrame:
    """Scored table with the training encoder and scaler; ``probs`` in vocabulary order."""
    if isinstance(model, ForestModel | StoredForest):
        return model.score(df, spec)
    labels = vocabulary_of(model)
    scored = model.transform(df)
    keep = [c for c in df.columns if c not in (spec.id_col, spec.label_col, *spec.feature_cols)]
    return scored.select(
        F.col(spec.id_col).alias("id"),
        F.col(spec.label_col).cast("string").alias("label"),
        F.element_at(
            literal_array(labels), (F.col("prediction_idx") + 1).cast("int")
        ).alias("prediction"),
        vector_to_array("probability").alias("probs"),
        *keep,
    )


def save_model(model: Model, path: str) -> None:
    """Replace what is at the path by the model."""
    if isinstance(model, StoredForest):
        model = model.load()
    if isinstance(model, ForestModel):
        model.save(SparkSession.active(), path)
    else:
        model.write().overwrite().save(path)


def load_model(path: str) -> Model:
    """A saved model of either kind; a forest has a folder of that name in it."""
    spark = SparkSession.active()
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/forest")
    if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return ForestModel.load(spark, path)
    return PipelineModel.load(path)


def folds_of(df: DataFrame, spec: LabelledSpec, params: Params = Params()) -> DataFrame:
    return store(stratified_folds(spec.project(df), spec, params.folds), "folds")


def _held_out_scores(name: str, folded: DataFrame, runs: dict[int, Run], spec: LabelledSpec) -> DataFrame:
    scores = None
    for fold in sorted(r for r in runs if r):
        held = score_model(runs[fold].model, folded.where(F.col("fold") == fold), spec)
        scores = held if scores is None else scores.unionByName(held)
    return scores.groupBy(F.lit(name).alias("model"), "fold").agg(
        F.count("*").alias("rows"),
        F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"),
    )


def fold_scores(
    name: str, df: DataFrame, spec: LabelledSpec, params: Params = Params()
) -> DataFrame:
    """(model, fold, rows, accuracy); scaling is fitted inside each fold."""
    folded = folds_of(df, spec, params)
    return _held_out_scores(name, folded, fit_runs(name, folded, spec, params, whole=False), spec)


def cross_validate(
    name: str, df: DataFrame, spec: LabelledSpec, params: Params = Params()
) -> DataFrame:
    """(model, cv_mean, cv_std, folds)."""
    return cv_summary(fold_scores(name, df, spec, params))


def fit_with_folds(name: str, df: DataFrame, spec: LabelledSpec, params: Params = Params()) -> tuple[Run, DataFrame]:
    """The model of all rows and the scores of its folds, fitted together where the model allows it."""
    folded = folds_of(df, spec, params)
    runs = fit_runs(name, folded, spec, params)
    return runs[0], _held_out_scores(name, folded, runs, spec)


def train_single(
    name: str,
    split: DataFrame,
    spec: LabelledSpec,
    params: Params = Params(),
    cv: bool = True,
) -> tuple[PipelineModel, DataFrame]:
    """Fit on the training rows, measure on the test rows, cross-validate.

    Returns the model and its long metrics (model, metric, value).
    """
    train, test = split.where("not is_test"), split.where("is_test")
    run, scores = fit_with_folds(name, train, spec, params) if cv else (fit_run(name, train, spec, params), None)
    metrics = classification_metrics(score_model(run.model, test, spec))
    if cv:
        folds = cv_summary(scores)
        metrics = metrics.unionByName(
            folds.unpivot([], ["cv_mean", "cv_std"], "metric", "value")
        )
    return run.model, metrics.select(F.lit(name).alias("model"), "metric", "value")


def train_all(
    df: DataFrame,
    spec: LabelledSpec,
    params: Params = Params(),
    names: tuple[str, ...] = MODELS,
    cv: bool = True,
    run_log: str | None = None,
    dataset: str = "",
) -> tuple[dict[str, PipelineModel], DataFrame, dict[str, str]]:
    """Every model on one split: models, long metrics, and errors by model.

    A model that fails is recorded and the others go on. With ``run_log`` the parameters, the
    sizes of the split and the metrics of each run are appended to that table of runs.
    """
    split = store(
        train_test_split(spec.project(df), spec, params.test_size, params.seed), "split"
    )
    sizes = dict(split.groupBy("is_test").count().collect())
    described = asdict(params) | {"train_rows": sizes.get(False, 0), "test_rows": sizes.get(True, 0)}
    models, errors, metrics = {}, {}, None
    for name in names:
        try:
            model, own = train_single(name, split, spec, params, cv)
            own = store(own, "metrics")
        except Exception as error:
            errors[name] = str(error)
            continue
        models[name] = model
        if run_log:
            log_run(df.sparkSession, run_log, uuid.uuid4().hex, name, dataset, described, own)
        metrics = own if metrics is None else metrics.unionByName(own)
    if metrics is None:
        raise RuntimeError(f"no model could be trained: {errors}")
    return models, metrics, errors


def pca_projection(
    clean: DataFrame, others: dict[str, DataFrame], spec: LabelledSpec, k: int = 2
) -> tuple[DataFrame, list[float]]:
    """Project every version on the components of the clean one, centred by its means."""
    x = F.array(*[F.col(c).cast("double") for c in spec.feature_cols])
    found = principal_components(store(clean.select(x.alias("x")), "vectors"), k)

    def projected(df: DataFrame, name: str) -> DataFrame:
        label = F.col(spec.label_col).cast("string")
        rows = df.select(F.lit(name).alias("dataset"), F.col(spec.id_col).alias("id"), label.alias("label"), found.project(x).alias("_pc"))
        return rows.select("dataset", "id", "label", *[F.col("_pc")[i].alias(f"pc{i + 1}") for i in range(k)])

    stacked = projected(clean, "clean")
    for name, df in others.items():
        stacked = stacked.unionByName(projected(df, name))
    return stacked, found.ratios


def feature_importances(model: ForestModel, spec: LabelledSpec) -> list[tuple[str, float]]:
    """(feature, importance) of a fitted random forest."""
    return list(zip(spec.feature_cols, [float(v) for v in model.importances()]))
