"""Queries: classification metrics of the neighbours' votes on noisy labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from labelwright.operators import metrics as M
from labelwright.operators.centroid import fit_centroids
from labelwright.operators.noise import fit_label_noise
from labelwright.operators.split import train_test_split
from labelwright.plans import inputs as I
from labelwright.plans.catalog import query
from labelwright.plans.neighbours import ONE_LEVEL_SQL, knn_votes
from labelwright.sources.scratch import store

VOTES_SQL = (*ONE_LEVEL_SQL, I.SCORED_SQL.replace("scored AS", "voted AS"))
RUN_SQL = "scored AS (SELECT 0 AS run, id, label, prediction, probs, top FROM voted)"


def votes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    return knn_votes(I.part_bands(spark, sf_dir))


@query(
    "confusion_matrix",
    I.with_sql(
        *VOTES_SQL,
        """SELECT a.label, b.label AS prediction, count(s.id) AS n
           FROM (SELECT DISTINCT label FROM base) a JOIN (SELECT DISTINCT label FROM base) b ON true
           LEFT JOIN voted s ON s.label = a.label AND s.prediction = b.label GROUP BY ALL""",
    ),
)
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, labels = votes(spark, sf_dir)
    return M.confusion_matrix(scored, labels)


@query(
    "per_class_metrics",
    I.with_sql(
        *VOTES_SQL,
        RUN_SQL,
        I.AVERAGES_SQL,
        """SELECT cl AS class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support
           FROM rates""",
    ),
)
def per_class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = votes(spark, sf_dir)
    classes = M.per_class_metrics(M.confusion_cells(scored))
    return I.rounded(
        classes.select("class", "precision", "recall", "f1", "support"), "precision", "recall", "f1"
    )


@query(
    "classification_metrics",
    I.with_sql(*VOTES_SQL, RUN_SQL, I.AVERAGES_SQL, "SELECT metric, round(value, 6) AS value FROM metrics"),
)
def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = votes(spark, sf_dir)
    return I.rounded(M.classification_metrics(scored), "value")


@query(
    "classification_report",
    I.with_sql(
        *VOTES_SQL,
        RUN_SQL,
        I.AVERAGES_SQL,
        """SELECT cl AS class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rates
           UNION ALL SELECT 'accuracy', NULL, NULL, round(accuracy, 6), samples FROM averages
           UNION ALL SELECT 'macro avg', round(precision_macro, 6), round(recall_macro, 6), round(f1_macro, 6), samples FROM averages
           UNION ALL SELECT 'weighted avg', round(precision_weighted, 6), round(recall_weighted, 6), round(f1_weighted, 6), samples
             FROM averages""",
    ),
)
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = votes(spark, sf_dir)
    return I.rounded(M.classification_report(scored), "precision", "recall", "f1")


AUC_SQL = """auc AS (SELECT cl AS class, sum(pos * (below + neg / 2::DOUBLE)) / (max(p) * max(n))::DOUBLE AS auc FROM (
    SELECT cl, score, pos, neg, coalesce(sum(neg) OVER (PARTITION BY cl ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
      sum(pos) OVER (PARTITION BY cl) AS p, sum(neg) OVER (PARTITION BY cl) AS n
    FROM (SELECT cl, score, count(*) FILTER (WHERE label = cl) AS pos, count(*) FILTER (WHERE label <> cl) AS neg
          FROM flat GROUP BY cl, score)) GROUP BY cl)"""
AUC_END = """SELECT class, round(auc, 6) AS auc FROM auc UNION ALL SELECT 'macro', round(avg(auc), 6) FROM auc"""


@query(
    "roc_auc_ovr",
    I.with_sql(
        *VOTES_SQL,
        "flat AS (SELECT id, label, unnest(v) AS cl, unnest(probs) AS score FROM voted, vocab)",
        AUC_SQL,
        AUC_END,
    ),
)
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, labels = votes(spark, sf_dir)
    return I.rounded(M.roc_auc_ovr(scored, labels), "auc")


@query(
    "roc_auc_continuous",
    I.with_sql(
        I.ORDER_BANDS_SQL,
        I.noisy_sql((0.1,), "q, p, c"),
        "fit AS (SELECT avg(q) mq, stddev_pop(q) sq, avg(p) mp, stddev_pop(p) sp, avg(c) mc, stddev_pop(c) sc FROM noisy)",
        "centres AS (SELECT label AS cl, avg(q) q, avg(p) p, avg(c) c FROM noisy GROUP BY label)",
        """dist AS (SELECT b.id, b.label, k.cl, round(sqrt(((b.q - k.q) / sq)**2 + ((b.p - k.p) / sp)**2 + ((b.c - k.c) / sc)**2), 9) AS d
             FROM noisy b, fit, centres k)""",
        """flat AS (SELECT id, label, cl, round(exp(-d) / sum(exp(-d)) OVER (PARTITION BY id), 9) AS score FROM dist)""",
        AUC_SQL,
        AUC_END,
    ),
)
def roc_auc_continuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores that are nearly all distinct, over the larger table."""
    bands = store(I.order_bands(spark, sf_dir), "bands")
    noisy = fit_label_noise(bands, I.BANDS, (0.1,)).flip(bands, 0.1)
    model = fit_centroids(noisy, I.BANDS)
    scored = model.score(noisy).withColumn("probs", F.transform("probs", lambda p: F.round(p, 9)))
    return I.rounded(M.roc_auc_ovr(scored, list(model.labels)), "auc")


@query(
    "prediction_confidence",
    I.with_sql(
        *VOTES_SQL,
        """SELECT round(avg(top), 6) AS mean, round(stddev_pop(top), 6) AS std, min(top) AS min, max(top) AS max FROM voted""",
    ),
)
def prediction_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = votes(spark, sf_dir)
    return I.rounded(M.prediction_confidence(scored), "mean", "std")


@query(
    "low_confidence",
    I.with_sql(
        *VOTES_SQL,
        """SELECT count(*) FILTER (WHERE top < 0.6::DOUBLE) AS count,
             round(avg((top < 0.6::DOUBLE)::INT::DOUBLE) * 100, 6) AS percentage, 0.6::DOUBLE AS threshold FROM voted""",
    ),
)
def low_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = votes(spark, sf_dir)
    return I.rounded(M.low_confidence(scored), "percentage")


# Class means of the training rows, clean and at 10 % noise, on the clean test rows.
PAIR_SQL = (
    I.PART_BANDS_SQL,
    I.SPLIT_SQL,
    I.noisy_sql((0.0, 0.1), "q, p, c"),
    "tr AS (SELECT n.noise_level AS run, n.id, n.label, n.q, n.p, n.c FROM noisy n JOIN split s ON n.id = s.id AND NOT s.is_test)",
    "te AS (SELECT n.noise_level AS run, n.id, n.original_label AS label, n.q, n.p, n.c FROM noisy n JOIN split s ON n.id = s.id AND s.is_test)",
    I.centroid_sql(),
)


def clean_and_noisy(
    spark: SparkSession, sf_dir: str, levels: tuple[float, ...], truth: str = "original_label"
) -> tuple[DataFrame, list[str]]:
    """One model per noise level, all scored on the same test rows.

    The models are fitted by one aggregation over the stacked training rows.
    """
    split = store(train_test_split(I.part_bands(spark, sf_dir), I.BANDS), "split")
    noisy = fit_label_noise(split, I.BANDS, levels).sweep(split)
    model = fit_centroids(noisy.where("not is_test"), I.BANDS, by="noise_level")
    scored = model.score(noisy.where("is_test")).withColumn("label", F.col(truth))
    return scored, list(model.labels)


@query(
    "confusion_by_model",
    I.with_sql(
        *PAIR_SQL,
        """SELECT r.run AS noise_level, a.label, b.label AS prediction, count(s.id) AS n
           FROM (SELECT DISTINCT run FROM tr) r, (SELECT DISTINCT label FROM base) a
           JOIN (SELECT DISTINCT label FROM base) b ON true
           LEFT JOIN scored s ON s.run = r.run AND s.label = a.label AND s.prediction = b.label GROUP BY ALL""",
    ),
)
def confusion_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, labels = clean_and_noisy(spark, sf_dir, (0.0, 0.1))
    return M.confusion_matrix(scored, labels, ("noise_level",))
