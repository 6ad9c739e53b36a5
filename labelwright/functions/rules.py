"""Scalar report rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Report thresholds.
STABILITY_HIGH = 0.1
STABILITY_MEDIUM = 0.2
IMPACT_HIGH = 20.0
IMPACT_MEDIUM = 10.0
SUCCESS_DROP = 0.05
DETECTION_SHARE = 0.5
RATE_HIGH = 70.0
RATE_MEDIUM = 30.0


def relative_drop(before: Column, after: Column) -> Column:
    """Drop in percent of the first value; 0 where that value is not positive."""
    return F.when(before > 0, (before - after) / before * 100).otherwise(F.lit(0.0))


def stability_level(cv: Column) -> Column:
    return (
        F.when(cv < STABILITY_HIGH, "high").when(cv < STABILITY_MEDIUM, "medium").otherwise("low")
    )


def impact_level(drop_pct: Column) -> Column:
    return (
        F.when(drop_pct > IMPACT_HIGH, "High")
        .when(drop_pct > IMPACT_MEDIUM, "Medium")
        .otherwise("Low")
    )


def noise_success(absolute_drop: Column) -> Column:
    return F.when(absolute_drop > SUCCESS_DROP, "Yes").otherwise("Limited")


def detection_grade(suspects: Column, level: Column, rows: Column) -> Column:
    return F.when(suspects > level * rows * DETECTION_SHARE, "Good").otherwise("Poor")


def detection_band(rate_pct: Column) -> Column:
    return (
        F.when(rate_pct > RATE_HIGH, "High")
        .when(rate_pct > RATE_MEDIUM, "Moderate")
        .otherwise("Low")
    )


def metric_title(name: Column) -> Column:
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def four_decimals(value: Column) -> Column:
    return F.format_string("%.4f", F.round(value, 4))
