"""Label encoding for vocabularies of any size: the dictionary is a table, not a literal.

Indices are positions in the order of the labels, as for the small vocabularies that are held
on the driver. Nothing here is bounded by a number of classes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from labelwright.operators.ranks import ranked
from labelwright.sources.scratch import small, store


def label_dictionary(*versions: DataFrame, label_col: str) -> DataFrame:
    """(label, label_idx from 0 on) of all labels of one or more versions of a table; null is no label."""
    if not versions:
        raise ValueError("at least one table is needed")
    labels = None
    for df in versions:
        own = df.select(F.col(label_col).cast("string").alias("label")).where("label is not null").distinct()
        labels = own if labels is None else labels.unionByName(own)
    return store(ranked(labels.distinct(), ["label"], "label_idx").withColumn("label_idx", F.col("label_idx") - 1), "dictionary")


def encode_labels(df: DataFrame, label_col: str, dictionary: DataFrame, out: str = "label_idx") -> DataFrame:
    """Add the index of each label; a null label has none, a label that is not in the dictionary is an error."""
    entries = small(dictionary.select(F.col("label").alias("_label"), F.col("label_idx").alias("_idx")), 64)
    label = F.col(label_col).cast("string")
    unseen = F.raise_error(F.concat(F.lit("label not in the vocabulary: "), label)).cast("bigint")
    index = F.when(label.isNull() | F.col("_idx").isNotNull(), F.col("_idx")).otherwise(unseen)
    return df.join(entries, label == F.col("_label"), "left").withColumn(out, index).drop("_label", "_idx")


def decode_labels(df: DataFrame, index_col: str, dictionary: DataFrame, out: str = "label") -> DataFrame:
    """Add the label of each index; an index outside the dictionary has none."""
    entries = small(dictionary.select(F.col("label").alias("_label"), F.col("label_idx").alias("_idx")), 64)
    return df.join(entries, F.col(index_col) == F.col("_idx"), "left").withColumn(out, F.col("_label")).drop("_label", "_idx")
