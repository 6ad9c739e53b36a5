"""Queries: comparison reports over models, noise levels and data sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from labelwright.operators import compare as C
from labelwright.operators.centroid import fit_centroids
from labelwright.operators.detect import neighbour_suspects, quarantine, suspicion_summary
from labelwright.operators.metrics import classification_metrics
from labelwright.operators.neighbours import feature_vectors, nearest_neighbours
from labelwright.operators.noise import fit_label_noise
from labelwright.operators.split import stratified_folds, train_test_split
from labelwright.plans import inputs as I
from labelwright.plans.catalog import query
from labelwright.plans.metrics import PAIR_SQL, clean_and_noisy
from labelwright.plans.neighbours import band_suspects, held_out_votes
from labelwright.sources.scratch import store
from labelwright.sources.tables import stack_datasets

LEVELS = I.CURVE_LEVELS
CURVE_SQL = (*[p.replace("[0.0, 0.1]", "[0.0, 0.05, 0.1, 0.5]") for p in PAIR_SQL], I.AVERAGES_SQL)
DEGRADATION_SQL = """drops AS (SELECT n.run AS noise_level, n.metric, c.value AS clean, n.value AS noisy,
  c.value - n.value AS absolute_drop, CASE WHEN c.value > 0 THEN (c.value - n.value) / c.value * 100 ELSE 0 END AS relative_drop_pct
  FROM metrics n JOIN metrics c ON c.metric = n.metric AND c.run = 0 AND n.run > 0
  WHERE n.metric IN ('accuracy', 'precision_macro', 'recall_macro', 'f1_macro'))"""


def level_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = clean_and_noisy(spark, sf_dir, LEVELS)
    return store(classification_metrics(scored, ("noise_level",)), "metrics")


def drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = level_metrics(spark, sf_dir)
    clean = metrics.where("noise_level = 0").drop("noise_level")
    return C.performance_degradation(clean, metrics.where("noise_level > 0"), ("noise_level",))


@query(
    "performance_degradation",
    I.with_sql(
        *CURVE_SQL,
        DEGRADATION_SQL,
        """SELECT noise_level, metric, round(clean, 6) AS clean, round(noisy, 6) AS noisy,
             round(absolute_drop, 6) AS absolute_drop, round(relative_drop_pct, 6) AS relative_drop_pct FROM drops""",
    ),
)
def performance_degradation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.rounded(drops(spark, sf_dir), "clean", "noisy", "absolute_drop", "relative_drop_pct")


@query(
    "worst_metric",
    I.with_sql(
        *CURVE_SQL,
        DEGRADATION_SQL,
        """SELECT noise_level, metric, round(relative_drop_pct, 6) AS drop_percentage FROM drops
           QUALIFY row_number() OVER (PARTITION BY noise_level ORDER BY round(relative_drop_pct, 9) DESC,
             list_position(['accuracy', 'precision_macro', 'recall_macro', 'f1_macro'], metric)) = 1""",
    ),
)
def worst_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.rounded(C.worst_metric(drops(spark, sf_dir), ("noise_level",)), "drop_percentage")


@query(
    "worst_level",
    I.with_sql(
        *CURVE_SQL,
        DEGRADATION_SQL,
        """SELECT noise_level, round(relative_drop_pct, 6) AS drop_percentage FROM drops WHERE metric = 'accuracy'
           ORDER BY round(relative_drop_pct, 9) DESC, noise_level LIMIT 1""",
    ),
)
def worst_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.rounded(C.worst_level(drops(spark, sf_dir)), "drop_percentage")


@query(
    "noise_level_curve",
    I.with_sql(
        *CURVE_SQL,
        """SELECT run AS noise_level, round(accuracy, 6) AS accuracy, round(precision_macro, 6) AS precision_macro,
             round(recall_macro, 6) AS recall_macro, round(f1_macro, 6) AS f1_macro FROM averages ORDER BY run""",
    ),
)
def noise_level_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.rounded(C.level_curve(level_metrics(spark, sf_dir)), *C.COMPARED)


GIVEN_SQL = tuple(
    p.replace("n.original_label AS label", "n.label") if p.startswith("te AS") else p for p in CURVE_SQL
)


@query(
    "noise_level_curve_given",
    I.with_sql(
        *GIVEN_SQL,
        """SELECT run AS noise_level, round(accuracy, 6) AS accuracy, round(precision_macro, 6) AS precision_macro,
             round(recall_macro, 6) AS recall_macro, round(f1_macro, 6) AS f1_macro FROM averages ORDER BY run""",
    ),
)
def noise_level_curve_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measured against the given, noisy test labels."""
    scored, _ = clean_and_noisy(spark, sf_dir, LEVELS, truth="label")
    metrics = classification_metrics(scored, ("noise_level",))
    return I.rounded(C.level_curve(metrics), *C.COMPARED)


@query(
    "baseline_drop",
    I.with_sql(
        *CURVE_SQL,
        """SELECT 'centroid' AS model, run AS noise_level, round(accuracy, 6) AS accuracy,
             round(first_value(accuracy) OVER (ORDER BY run) - accuracy, 6) AS drop FROM averages""",
    ),
)
def baseline_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = level_metrics(spark, sf_dir).withColumn("model", F.lit("centroid"))
    return I.rounded(C.baseline_drop(metrics), "accuracy", "drop")


# The clean model on four data sets: the test rows with their labels at each level.
ROBUST_SQL = (
    *PAIR_SQL[:2],
    I.noisy_sql(LEVELS, "q, p, c"),
    """tr AS (SELECT l.noise_level AS run, s.id, s.label, s.q, s.p, s.c
         FROM split s, (SELECT DISTINCT noise_level FROM noisy) l WHERE NOT s.is_test)""",
    "te AS (SELECT n.noise_level AS run, n.id, n.label, n.q, n.p, n.c FROM noisy n JOIN split s ON n.id = s.id AND s.is_test)",
    I.centroid_sql(),
    I.AVERAGES_SQL,
    """robust AS (SELECT metric, avg(value) AS mean, stddev_pop(value) AS std, min(value) AS min, max(value) AS max,
         CASE WHEN avg(value) > 0 THEN stddev_pop(value) / avg(value) ELSE 0 END AS cv, count(*) AS n
       FROM metrics WHERE metric IN ('accuracy', 'precision_macro', 'recall_macro', 'f1_macro') GROUP BY metric)""",
)


def dataset_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = store(train_test_split(I.part_bands(spark, sf_dir), I.BANDS), "split")
    model = fit_centroids(split.where("not is_test"), I.BANDS)
    noise = fit_label_noise(split, I.BANDS, LEVELS)
    test = split.where("is_test")
    swept = noise.sweep(test)
    stacked = swept.withColumn("dataset", F.concat(F.lit("noise_"), F.col("noise_level").cast("string")))
    return classification_metrics(model.score(stacked), ("dataset",))


@query(
    "robustness_metrics",
    I.with_sql(
        *ROBUST_SQL,
        """SELECT metric, round(mean, 6) AS mean, round(std, 6) AS std, round(min, 6) AS min, round(max, 6) AS max,
             round(cv, 6) AS coefficient_of_variation, n AS datasets_evaluated FROM robust""",
    ),
)
def robustness_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.rounded(
        C.robustness(dataset_metrics(spark, sf_dir)),
        "mean",
        "std",
        "min",
        "max",
        "coefficient_of_variation",
    )


@query(
    "stability_level",
    I.with_sql(
        *ROBUST_SQL,
        """SELECT metric, round(cv, 6) AS coefficient_of_variation,
             CASE WHEN cv < 0.1 THEN 'high' WHEN cv < 0.2 THEN 'medium' ELSE 'low' END AS stability_level FROM robust""",
    ),
)
def stability_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.rounded(
        C.stability(C.robustness(dataset_metrics(spark, sf_dir))), "coefficient_of_variation"
    )


FOLD_SQL = (
    I.ORDER_BANDS_SQL,
    "folds AS (SELECT *, ntile(5) OVER (PARTITION BY label ORDER BY id)::INT AS fold FROM base)",
    "tr AS (SELECT g.run, f.id, f.label, f.q, f.p, f.c FROM folds f JOIN (SELECT unnest([1,2,3,4,5]) AS run) g ON f.fold <> g.run)",
    "te AS (SELECT fold AS run, id, label, q, p, c FROM folds)",
    I.centroid_sql(),
    "accuracies AS (SELECT run AS fold, avg((label = prediction)::INT::DOUBLE) AS accuracy FROM scored GROUP BY run)",
)


def fold_scores(bands: DataFrame) -> DataFrame:
    """Held-out accuracy per fold; one aggregation fits the models of all folds."""
    folded = store(stratified_folds(bands, I.BANDS), "folds")
    model = fit_centroids(folded, I.BANDS, by="fold", held_out=True)
    hit = (F.col("label") == F.col("prediction")).cast("double")
    return (
        model.score(folded)
        .groupBy("fold")
        .agg(F.avg(hit).alias("accuracy"))
        .withColumn("model", F.lit("centroid"))
    )


@query(
    "fold_accuracy",
    I.with_sql(*FOLD_SQL, "SELECT 'centroid' AS model, fold, round(accuracy, 6) AS accuracy FROM accuracies"),
)
def fold_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.rounded(fold_scores(store(I.order_bands(spark, sf_dir), "bands")), "accuracy")


@query(
    "cv_summary",
    I.with_sql(
        *FOLD_SQL,
        """SELECT 'centroid' AS model, round(avg(accuracy), 6) AS cv_mean, round(stddev_pop(accuracy), 6) AS cv_std,
             count(*) AS folds FROM accuracies""",
    ),
)
def cv_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = fold_scores(store(I.order_bands(spark, sf_dir), "bands"))
    return I.rounded(C.cv_summary(scores), "cv_mean", "cv_std")


@query(
    "fold_stability",
    I.with_sql(
        *FOLD_SQL,
        """SELECT 'centroid' AS model, round(m, 6) AS cv_mean, round(s, 6) AS cv_std, n AS folds,
             round(CASE WHEN m > 0 THEN s / m ELSE 0 END, 6) AS coefficient_of_variation,
             CASE WHEN s < 0.1 * m OR m <= 0 THEN 'high' WHEN s < 0.2 * m THEN 'medium' ELSE 'low' END AS stability_level
           FROM (SELECT avg(accuracy) AS m, stddev_pop(accuracy) AS s, count(*) AS n FROM accuracies)""",
    ),
)
def fold_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = fold_scores(store(I.order_bands(spark, sf_dir), "bands"))
    return I.rounded(
        C.fold_stability(C.cv_summary(scores)), "cv_mean", "cv_std", "coefficient_of_variation"
    )


# Train on all noisy rows, and on those that are not suspicious; test on the original labels.
RETRAIN_SQL = (
    I.PART_BANDS_SQL,
    I.SPLIT_SQL,
    I.noisy_sql((0.5,), "q, p, c"),
    I.SCALED_SQL,
    I.near_sql(),
    I.LONG_SQL,
    I.SUSPECTS_SQL,
    """tr AS (SELECT r.run, n.id, n.label, n.q, n.p, n.c FROM noisy n JOIN split s ON n.id = s.id AND NOT s.is_test
         JOIN suspects u ON u.id = n.id JOIN (SELECT unnest(['all', 'kept']) AS run) r ON r.run = 'all' OR NOT u.suspicious)""",
    """te AS (SELECT r.run, s.id, s.label, s.q, s.p, s.c FROM split s, (SELECT unnest(['all', 'kept']) AS run) r WHERE s.is_test)""",
    I.centroid_sql(),
    I.AVERAGES_SQL,
)


@query(
    "quarantine_retrain",
    I.with_sql(*RETRAIN_SQL, "SELECT run AS training, metric, round(value, 6) AS value FROM metrics"),
)
def quarantine_retrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What setting suspects aside before training is worth."""
    split = store(train_test_split(I.part_bands(spark, sf_dir), I.BANDS), "split")
    noisy = store(fit_label_noise(split, I.BANDS, (0.5,)).flip(split, 0.5), "noisy")
    flags = neighbour_suspects(nearest_neighbours(feature_vectors(noisy, I.BANDS)))
    train = noisy.where("not is_test")
    stacked = stack_datasets({"all": train, "kept": quarantine(train, flags, "id")})
    model = fit_centroids(stacked, I.BANDS, by="dataset")
    test = split.where("is_test")
    scored = model.score(stack_datasets({"all": test, "kept": test}))
    metrics = classification_metrics(scored, ("dataset",))
    return I.rounded(metrics.withColumnRenamed("dataset", "training"), "value")


# Two classifiers on one split: class means and neighbours' votes.
MODELS_SQL = (
    I.PART_BANDS_SQL,
    I.SPLIT_SQL,
    "tr AS (SELECT 'centroid' AS run, id, label, q, p, c FROM split WHERE NOT is_test)",
    "te AS (SELECT 'centroid' AS run, id, label, q, p, c FROM split WHERE is_test)",
    I.centroid_sql("by_mean"),
    """zz AS MATERIALIZED (SELECT id, label, is_test, (q - mq) / sq AS z1, (p - mp) / sp AS z2, (c - mc) / sc AS z3
         FROM split, fit)""",
    """near AS (SELECT id, label, nl FROM (SELECT a.id, a.label, b.label AS nl, row_number() OVER (PARTITION BY a.id
         ORDER BY round(sqrt((a.z1-b.z1)**2 + (a.z2-b.z2)**2 + (a.z3-b.z3)**2), 9), b.id) AS place
         FROM zz a JOIN zz b ON a.is_test AND NOT b.is_test) WHERE place <= 5)""",
    "votes AS (SELECT id, label, nl, count(*) AS n FROM near GROUP BY ALL)",
    """scored AS (SELECT run, id, label, prediction FROM by_mean UNION ALL
         SELECT 'knn', id, label, arg_min(nl, {'n': -n, 'nl': nl}) FROM votes GROUP BY id, label)""",
    I.AVERAGES_SQL,
)


def two_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = store(train_test_split(I.part_bands(spark, sf_dir), I.BANDS), "split")
    model = fit_centroids(split.where("not is_test"), I.BANDS)
    by_mean = model.score(split.where("is_test")).select("label", "prediction")
    by_vote = held_out_votes(split).select("label", "prediction")
    both = by_mean.withColumn("model", F.lit("centroid")).unionByName(
        by_vote.withColumn("model", F.lit("knn"))
    )
    return classification_metrics(both, ("model",))


@query(
    "model_comparison",
    I.with_sql(
        *MODELS_SQL,
        """SELECT run AS model, list_aggregate(list_transform(string_split(metric, '_'), lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ') AS title,
             printf('%.4f', round(value, 4)) AS shown
           FROM metrics WHERE metric IN ('accuracy', 'precision_macro', 'recall_macro', 'f1_macro')""",
    ),
)
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.model_comparison(two_models(spark, sf_dir))


@query(
    "best_model",
    I.with_sql(
        *MODELS_SQL,
        """SELECT run AS model, round(accuracy, 4) AS accuracy FROM averages
           ORDER BY round(accuracy, 4) DESC, run LIMIT 1""",
    ),
)
def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.best_model(two_models(spark, sf_dir))


@query(
    "impact_summary",
    I.with_sql(
        *CURVE_SQL,
        I.SCALED_SQL,
        I.near_sql(),
        I.LONG_SQL.replace("row_number() OVER (PARTITION BY q.noise_level, q.id ORDER BY u.d, u.nid)", "0"),
        I.SUSPECTS_SQL,
        """found AS (SELECT noise_level, count(*) AS total_rows, count(*) FILTER (WHERE suspicious) AS suspicious_rows
             FROM suspects GROUP BY noise_level)""",
        """joined AS (SELECT a.run AS noise_level, b.accuracy AS clean, a.accuracy AS noisy, b.accuracy - a.accuracy AS ad,
             CASE WHEN b.accuracy > 0 THEN (b.accuracy - a.accuracy) / b.accuracy * 100 ELSE 0 END AS rd,
             f.suspicious_rows, f.total_rows, f.suspicious_rows / f.total_rows::DOUBLE * 100 AS rate
             FROM averages a JOIN averages b ON b.run = 0 AND a.run > 0 JOIN found f ON f.noise_level = a.run)""",
        """SELECT noise_level, round(clean, 6) AS clean_accuracy, round(noisy, 6) AS noisy_accuracy, round(ad, 6) AS absolute_drop,
             round(rd, 6) AS relative_drop_pct, suspicious_rows, round(rate, 6) AS suspicion_rate_pct,
             CASE WHEN ad > 0.05 THEN 'Yes' ELSE 'Limited' END AS noise_success,
             CASE WHEN suspicious_rows > noise_level * total_rows * 0.5 THEN 'Good' ELSE 'Poor' END AS detection_effectiveness,
             CASE WHEN rate > 70 THEN 'High' WHEN rate > 30 THEN 'Moderate' ELSE 'Low' END AS detection_band,
             CASE WHEN rd > 20 THEN 'High' WHEN rd > 10 THEN 'Medium' ELSE 'Low' END AS overall_impact FROM joined""",
    ),
)
def impact_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = level_metrics(spark, sf_dir)
    curve = metrics.where("metric = 'accuracy'").select("noise_level", F.col("value").alias("accuracy"))
    flags, _ = band_suspects(store(I.part_bands(spark, sf_dir), "bands"), LEVELS)
    return I.rounded(
        C.impact_summary(curve, suspicion_summary(flags, ("noise_level",))),
        "clean_accuracy",
        "noisy_accuracy",
        "absolute_drop",
        "relative_drop_pct",
        "suspicion_rate_pct",
    )
