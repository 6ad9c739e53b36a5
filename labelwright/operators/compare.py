"""Comparison reports over long metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from labelwright.functions.rules import (
    detection_grade,
    detection_band,
    four_decimals,
    impact_level,
    metric_title,
    noise_success,
    relative_drop,
    stability_level,
)

# The metrics that comparisons look at.
COMPARED = ("accuracy", "precision_macro", "recall_macro", "f1_macro")


def performance_degradation(clean: DataFrame, noisy: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Pair two runs per metric: values, absolute drop, drop in percent."""
    a = clean.where(F.col("metric").isin(*COMPARED)).select("metric", F.col("value").alias("clean"))
    b = noisy.where(F.col("metric").isin(*COMPARED)).select(
        *by, "metric", F.col("value").alias("noisy")
    )
    return b.join(F.broadcast(a), "metric").select(
        *by,
        "metric",
        "clean",
        "noisy",
        (F.col("clean") - F.col("noisy")).alias("absolute_drop"),
        relative_drop(F.col("clean"), F.col("noisy")).alias("relative_drop_pct"),
    )


def worst_metric(degradation: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The metric that lost most; equal drops go to the first of the compared ones."""
    listed = F.array(*[F.lit(m) for m in COMPARED])
    order = Window.partitionBy(*(by or [F.lit(1)])).orderBy(
        F.round("relative_drop_pct", 9).desc(), F.array_position(listed, F.col("metric"))
    )
    return (
        degradation.withColumn("_n", F.row_number().over(order))
        .where("_n = 1")
        .select(*by, "metric", F.col("relative_drop_pct").alias("drop_percentage"))
    )


def worst_level(degradation: DataFrame, metric: str = "accuracy") -> DataFrame:
    """The noise level with the largest relative drop of a metric."""
    order = Window.partitionBy("metric").orderBy(
        F.round("relative_drop_pct", 9).desc(), "noise_level"
    )
    return (
        degradation.where(F.col("metric") == metric)
        .withColumn("_n", F.row_number().over(order))
        .where("_n = 1")
        .select("noise_level", F.col("relative_drop_pct").alias("drop_percentage"))
    )


def robustness(metrics: DataFrame) -> DataFrame:
    """Spread of each compared metric over data sets (dataset, metric, value)."""
    mean, std = F.avg("value"), F.stddev_pop("value")
    return (
        metrics.where(F.col("metric").isin(*COMPARED))
        .groupBy("metric")
        .agg(
            mean.alias("mean"),
            std.alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.when(mean > 0, std / mean).otherwise(F.lit(0.0)).alias("coefficient_of_variation"),
            F.count("*").alias("datasets_evaluated"),
        )
    )


def stability(robust: DataFrame) -> DataFrame:
    return robust.select(
        "metric",
        "coefficient_of_variation",
        stability_level(F.col("coefficient_of_variation")).alias("stability_level"),
    )


def level_curve(metrics: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per noise level with the compared metrics as columns, by level."""
    return (
        metrics.groupBy(*by, "noise_level")
        .pivot("metric", list(COMPARED))
        .agg(F.first("value"))
        .orderBy("noise_level")
    )


def baseline_drop(metrics: DataFrame) -> DataFrame:
    """Accuracy lost against the lowest level, per model."""
    order = (
        Window.partitionBy("model")
        .orderBy("noise_level")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return metrics.where("metric = 'accuracy'").select(
        "model",
        "noise_level",
        F.col("value").alias("accuracy"),
        (F.first("value").over(order) - F.col("value")).alias("drop"),
    )


def impact_summary(curve: DataFrame, suspicion: DataFrame) -> DataFrame:
    """Per noise level: accuracy drop and suspect counts, with their grades.

    ``curve`` has (noise_level, accuracy) including level 0, ``suspicion`` has
    (noise_level, total_rows, suspicious_rows).
    """
    levels = Window.partitionBy(F.lit(1))
    clean = F.max(F.when(F.col("noise_level") == 0, F.col("accuracy"))).over(levels)
    rated = (
        curve.withColumn("clean_accuracy", clean)
        .where("noise_level > 0")
        .join(suspicion, "noise_level")
        .withColumn("absolute_drop", F.col("clean_accuracy") - F.col("accuracy"))
        .withColumn("relative_drop_pct", relative_drop(F.col("clean_accuracy"), F.col("accuracy")))
        .withColumn("suspicion_rate_pct", F.col("suspicious_rows") / F.col("total_rows") * 100)
    )
    return rated.select(
        "noise_level",
        "clean_accuracy",
        F.col("accuracy").alias("noisy_accuracy"),
        "absolute_drop",
        "relative_drop_pct",
        "suspicious_rows",
        "suspicion_rate_pct",
        noise_success(F.col("absolute_drop")).alias("noise_success"),
        detection_grade(
            F.col("suspicious_rows"), F.col("noise_level"), F.col("total_rows")
        ).alias("detection_effectiveness"),
        detection_band(F.col("suspicion_rate_pct")).alias("detection_band"),
        impact_level(F.col("relative_drop_pct")).alias("overall_impact"),
    )


def cv_summary(fold_scores: DataFrame) -> DataFrame:
    """(model, cv_mean, cv_std) from (model, fold, accuracy)."""
    return fold_scores.groupBy("model").agg(
        F.avg("accuracy").alias("cv_mean"),
        F.stddev_pop("accuracy").alias("cv_std"),
        F.count("*").alias("folds"),
    )


def fold_stability(summary: DataFrame) -> DataFrame:
    """Spread of the fold accuracies against their mean, with its level."""
    cv = F.when(F.col("cv_mean") > 0, F.col("cv_std") / F.col("cv_mean")).otherwise(F.lit(0.0))
    return summary.withColumn("coefficient_of_variation", cv).withColumn(
        "stability_level", stability_level(F.col("coefficient_of_variation"))
    )


def model_comparison(metrics: DataFrame) -> DataFrame:
    """Printable table: one row per model, four decimals, titled columns as rows' names."""
    shown = (*COMPARED, "cv_mean")
    return (
        metrics.where(F.col("metric").isin(*shown))
        .select(
            "model",
            metric_title(F.col("metric")).alias("title"),
            four_decimals(F.col("value")).alias("shown"),
        )
    )


def best_model(metrics: DataFrame) -> DataFrame:
    """Highest accuracy after rounding to four decimals; the first name wins ties."""
    order = Window.partitionBy("metric").orderBy(F.col("accuracy").desc(), "model")
    return (
        metrics.where("metric = 'accuracy'")
        .withColumn("accuracy", F.round("value", 4))
        .withColumn("_n", F.row_number().over(order))
        .where("_n = 1")
        .select("model", "accuracy")
    )
