"""Exact train/test split and cross-validation folds."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from labelwright.functions.labels import class_counts
from labelwright.functions.local import local_table
from labelwright.operators.cuts import Cut, at_or_before, rank_cuts
from labelwright.operators.sampling import hash_cuts, hash_order
from labelwright.spec import LabelledSpec, Params


def class_quotas(counts: dict[str, int], test_rows: int) -> dict[str, int]:
    """Share the test rows over the classes by largest remainder, ties by label."""
    n = sum(counts.values())
    quotas = {c: m * test_rows // n for c, m in counts.items()}
    left = test_rows - sum(quotas.values())
    order = sorted(counts, key=lambda c: (-(counts[c] * test_rows % n), c))
    for c in order[:left]:
        quotas[c] += 1
    return quotas


def train_test_split(
    df: DataFrame,
    spec: LabelledSpec,
    test_size: float = Params.test_size,
    seed: int = Params.seed,
    stratify: bool = True,
    max_classes: int = Params.max_classes,
) -> DataFrame:
    """Add ``is_test``: exactly ``ceil(n * test_size)`` rows, in class proportion.

    Labels must not be null. The split is a comparison with one cut per class.
    """
    if not 0.0 < test_size < 1.0:
        raise ValueError(f"test size must be between 0 and 1, got {test_size}")
    counts = class_counts(df, spec.label_col, max_classes)
    test_rows = math.ceil(sum(counts.values()) * test_size)
    order = hash_order(spec.id_col, seed)
    label = F.col(spec.label_col).cast("string")
    if not stratify:
        cuts = hash_cuts(
            df.where(label.isNotNull()), spec.id_col, seed, {"": [test_rows]}, rows=sum(counts.values())
        )
        test = at_or_before(order, [F.lit(v) for v in cuts[0].values])
        return df.where(label.isNotNull()).withColumn("is_test", test)
    quotas = class_quotas(counts, test_rows)
    ranks = {c: [q] for c, q in quotas.items()}
    cuts = hash_cuts(df, spec.id_col, seed, ranks, label, max(counts.values()))
    table = _cut_table(df, spec, [(c.group, [c.values]) for c in cuts], list(counts), 2)
    marked = df.where(label.isNotNull()).join(
        F.broadcast(table), label == F.col("_label"), "left"
    )
    values = [F.col("_cuts")[0]["_v0"], F.col("_cuts")[0]["_v1"]]
    test = F.when(F.size("_cuts") > 0, at_or_before(order, values)).otherwise(F.lit(False))
    return marked.withColumn("is_test", test).drop("_label", "_cuts")


def stratified_folds(
    df: DataFrame,
    spec: LabelledSpec,
    folds: int = Params.folds,
    max_classes: int = Params.max_classes,
) -> DataFrame:
    """Add ``fold`` (1..folds): consecutive runs by id within each class, unshuffled.

    Within a class the fold sizes differ by at most one; the earlier folds are
    the larger ones. The id must be a whole number.
    """
    if folds < 2:
        raise ValueError("at least two folds are needed")
    counts = class_counts(df, spec.label_col, max_classes)
    label = F.col(spec.label_col).cast("string")
    ranks = {}
    for c, n in counts.items():
        ends = [(i * (n // folds)) + min(i, n % folds) for i in range(1, folds)]
        ranks[c] = [e for e in ends if e > 0]
    row_id = F.col(spec.id_col).cast("bigint")
    low, high = df.agg(F.min(row_id), F.max(row_id)).first()
    labelled = df.where(label.isNotNull())
    bits = max(1, int(high - low).bit_length())
    found = rank_cuts(
        labelled, row_id - F.lit(low), bits, [row_id], ranks, label, max(counts.values())
    )
    by_rank = {(c.group, c.rank): c for c in found}
    rows = []
    for c, n in counts.items():
        ends = [(i * (n // folds)) + min(i, n % folds) for i in range(1, folds)]
        rows.append((c, [by_rank[(c, e)].values for e in ends if e > 0]))
    table = _cut_table(df, spec, rows, list(counts), 1)
    passed = F.aggregate(
        "_cuts",
        F.lit(0),
        lambda acc, cut: acc + F.when(row_id > cut["_v0"], 1).otherwise(0),
    )
    return (
        labelled.join(F.broadcast(table), label == F.col("_label"))
        .withColumn("fold", passed + 1)
        .drop("_label", "_cuts")
    )


def _cut_table(
    df: DataFrame, spec: LabelledSpec, cuts: list, labels: list[str], width: int
) -> DataFrame:
    """One row per class with its cuts; classes without a cut get an empty list."""
    by_label = dict(cuts)
    id_type = "bigint" if width == 1 else df.schema[spec.id_col].dataType.simpleString()
    fields = f"_v0: {id_type}" if width == 1 else f"_v0: string, _v1: {id_type}"
    names = ["_v0", "_v1"]
    return local_table(
        df.sparkSession,
        [(c, [dict(zip(names, v)) for v in by_label.get(c, [])]) for c in labels],
        f"_label string, _cuts array<struct<{fields}>>",
    )
