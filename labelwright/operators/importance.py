"""Permutation importance: what a classifier loses when one feature is dealt to other rows.

A feature is permuted by an exact shift: in an order by a seeded hash of the ids, every row takes
the value of the next one, and the last that of the first. That is one join per feature, gives
the same result however the table is partitioned, and leaves the feature's distribution as it is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from labelwright.operators.ranks import ranked
from labelwright.sources.scratch import store
from labelwright.spec import LabelledSpec, Params


def shifted(df: DataFrame, id_col: str, column: str, seed: int = Params.seed) -> DataFrame:
    """(id, column): each row's id with the value of the next row in the hashed order."""
    h = F.md5(F.concat(F.lit(f"{seed}:{column}:"), F.col(id_col).cast("string")))
    rows = store(ranked(df.select(id_col, column, h.alias("_h")), ["_h", id_col], "_rank"), "shift")
    n = rows.count()
    giver = F.when(F.col("_rank") == 1, F.lit(n)).otherwise(F.col("_rank") - 1)
    values = rows.select(giver.alias("_to"), F.col(column))
    return rows.select(id_col, "_rank").join(values, F.col("_rank") == F.col("_to")).select(id_col, column)


def _accuracy(scored: DataFrame, spec: LabelledSpec, feature: str) -> DataFrame:
    right = (F.col(spec.label_col).cast("string") == F.col("prediction")).cast("double")
    return scored.agg(F.lit(feature).alias("feature"), F.avg(right).alias("accuracy"))


def permutation_importance(
    score: Callable[[DataFrame], DataFrame], df: DataFrame, spec: LabelledSpec, seed: int = Params.seed
) -> DataFrame:
    """(feature, accuracy, permuted_accuracy, importance) of a function that adds ``prediction``."""
    whole = _accuracy(score(df), spec, "").first()["accuracy"]
    each = None
    for feature in spec.feature_cols:
        moved = df.drop(feature).join(shifted(df, spec.id_col, feature, seed), spec.id_col)
        own = _accuracy(score(moved), spec, feature)
        each = own if each is None else each.unionByName(own)
    given = F.lit(whole).cast("double")
    return each.select(
        "feature",
        given.alias("accuracy"),
        F.col("accuracy").alias("permuted_accuracy"),
        (given - F.col("accuracy")).alias("importance"),
    )
