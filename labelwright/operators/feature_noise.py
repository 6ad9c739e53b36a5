"""Feature noise and outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from labelwright.functions.hashing import normal, row_hash
from labelwright.operators.sampling import hash_cuts, within_cut
from labelwright.spec import LabelledSpec


def _stats(df: DataFrame, spec: LabelledSpec) -> dict[str, tuple[float, float]]:
    aggs = []
    for i, c in enumerate(spec.feature_cols):
        aggs += [F.avg(F.col(c).cast("double")).alias(f"m{i}"), F.stddev_samp(F.col(c).cast("double")).alias(f"s{i}")]
    row = df.agg(F.count("*").alias("n"), *aggs).first()
    if row["n"] < 2:
        raise ValueError("a spread needs at least two rows")
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(spec.feature_cols)} | {"": (row["n"], 0.0)}


def add_feature_noise(
    df: DataFrame, spec: LabelledSpec, scale: float = 0.1, seed: int = 42
) -> DataFrame:
    """Add normal noise of ``scale`` sample standard deviations to every feature."""
    stats = _stats(df, spec)
    return df.withColumns(
        {
            c: F.col(c).cast("double")
            + F.lit(scale * stats[c][1]) * normal(row_hash(spec.id_col, f"{seed}:{c}"))
            for c in spec.feature_cols
        }
    )


def inject_outliers(
    df: DataFrame, spec: LabelledSpec, rows: int = 5, deviations: float = 5.0, seed: int = 42
) -> DataFrame:
    """Set every feature of ``min(rows, n)`` rows to mean + 5 sample deviations."""
    stats = _stats(df, spec)
    n = int(stats[""][0])
    cuts = hash_cuts(df, spec.id_col, seed, {"": [min(rows, n)]}, rows=n)
    hit = within_cut(spec.id_col, seed, cuts[0] if cuts else None)
    return df.withColumn("outlier", hit).withColumns(
        {
            c: F.when(F.col("outlier"), F.lit(stats[c][0] + deviations * stats[c][1])).otherwise(
                F.col(c).cast("double")
            )
            for c in spec.feature_cols
        }
    )
