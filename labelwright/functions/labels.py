"""Label vocabulary, encoding and decoding."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from labelwright.functions.local import local_table


def class_counts(df: DataFrame, label_col: str, max_classes: int = 10_000) -> dict[str, int]:
    """Rows per non-null label in label order.

    The result is held on the driver, so its size is checked: a column with
    more than ``max_classes`` values is not a class label.
    """
    rows = (
        df.where(F.col(label_col).isNotNull())
        .groupBy(F.col(label_col).cast("string").alias("label"))
        .count()
        .limit(max_classes + 1)
        .collect()
    )
    if len(rows) > max_classes:
        raise ValueError(f"{label_col} has more than {max_classes} classes")
    return dict(sorted((r["label"], r["count"]) for r in rows))


def vocabulary(df: DataFrame, label_col: str, max_classes: int = 10_000) -> list[str]:
    """Distinct labels, ascending."""
    return list(class_counts(df, label_col, max_classes))


def vocabulary_union(
    versions: list[DataFrame], label_col: str, max_classes: int = 10_000
) -> list[str]:
    """Distinct labels of several versions of a table, ascending, so that they share an index."""
    if not versions:
        raise ValueError("at least one table is needed")
    each = [df.select(F.col(label_col).cast("string").alias("label")) for df in versions]
    whole = each[0]
    for more in each[1:]:
        whole = whole.unionByName(more)
    return vocabulary(whole, "label", max_classes)


def literal_array(labels: list[str]) -> Column:
    """The vocabulary as one constant, however many labels there are."""
    return F.from_json(F.lit(json.dumps(labels)), "array<string>")


def encode(label: Column, labels: list[str]) -> Column:
    """Index of the label in the sorted vocabulary; an unseen label is an error."""
    place = F.array_position(literal_array(labels), label)
    return (
        F.when(label.isNull(), F.lit(None).cast("int"))
        .when(place > 0, (place - 1).cast("int"))
        .otherwise(F.raise_error(F.concat(F.lit("label not in the vocabulary: "), label)).cast("int"))
    )


def decode(index: Column, labels: list[str]) -> Column:
    return F.element_at(literal_array(labels), (index + 1).cast("int"))


def vocabulary_table(df: DataFrame, label_col: str, max_classes: int = 10_000) -> DataFrame:
    """The vocabulary as a table (label, label_idx)."""
    labels = vocabulary(df, label_col, max_classes)
    return local_table(
        df.sparkSession, [(label, i) for i, label in enumerate(labels)], "label string, label_idx int"
    )
