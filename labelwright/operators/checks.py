"""Data-quality checks: rows (check, column, passed, observed, limit)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

from labelwright.functions.local import local_table
from labelwright.functions.scaling import missing
from labelwright.spec import LabelledSpec


def _all() -> WindowSpec:
    """Only for tables that are already aggregated: one row per class, level or ratio."""
    return Window.partitionBy(F.lit(1))


SCHEMA = "check string, column string, passed boolean, observed double, limit double"


def _entry(check: str, column: str | Column, passed: Column, observed: Column, limit: float | Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        (F.lit(column) if isinstance(column, str) else column).alias("column"),
        passed.alias("passed"),
        observed.cast("double").alias("observed"),
        (F.lit(float(limit)) if not isinstance(limit, Column) else limit).alias("limit"),
    )


def _entries(row: DataFrame, entries: list[Column]) -> DataFrame:
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def check_nulls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing values per column: nulls, and not-a-number in floating columns."""
    columns = columns or df.columns
    counts = df.agg(*[F.count_if(missing(df, c)).alias(f"n{i}") for i, c in enumerate(columns)])
    return _entries(
        counts,
        [_entry("no_nulls", c, F.col(f"n{i}") == 0, F.col(f"n{i}"), 0) for i, c in enumerate(columns)],
    )


def check_columns(df: DataFrame, expected: list[str]) -> DataFrame:
    """Missing and unexpected columns; no job."""
    rows = [
        ("expected_column", c, c in df.columns, float(c in df.columns), 1.0) for c in expected
    ] + [("unexpected_column", c, False, 1.0, 0.0) for c in df.columns if c not in expected]
    return local_table(df.sparkSession, rows, SCHEMA)


def check_numeric(df: DataFrame, spec: LabelledSpec) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    rows = [
        ("numeric_feature", c, isinstance(types[c], T.NumericType), float(isinstance(types[c], T.NumericType)), 1.0)
        for c in spec.feature_cols
    ]
    return local_table(df.sparkSession, rows, SCHEMA)


def check_cardinality(df: DataFrame, spec: LabelledSpec, classes: int) -> DataFrame:
    row = df.agg(F.count_distinct(spec.label_col).alias("n"))
    return _entries(
        row, [_entry("class_cardinality", spec.label_col, F.col("n") == classes, F.col("n"), classes)]
    )


def check_ranges(
    df: DataFrame, spec: LabelledSpec, low: float = 0.0, high: float = 20.0
) -> DataFrame:
    aggs = []
    for i, c in enumerate(spec.feature_cols):
        aggs += [F.min(c).alias(f"a{i}"), F.max(c).alias(f"b{i}")]
    row = df.agg(*aggs)
    entries = []
    for i, c in enumerate(spec.feature_cols):
        entries += [
            _entry("range_min", c, F.col(f"a{i}") >= low, F.col(f"a{i}") + 0.0, low),
            _entry("range_max", c, F.col(f"b{i}") <= high, F.col(f"b{i}") + 0.0, high),
        ]
    return _entries(row, entries)


def class_distribution(df: DataFrame, label_col: str) -> DataFrame:
    """(label, n, share), largest class first."""
    counts = df.groupBy(F.col(label_col).alias("label")).agg(F.count("*").alias("n"))
    return counts.select(
        "label", "n", (F.col("n") / F.sum("n").over(_all())).alias("share")
    ).orderBy(F.col("n").desc(), "label")


def check_balance(df: DataFrame, spec: LabelledSpec, share: float = 0.1) -> DataFrame:
    """Each class holds at least a tenth of the rows."""
    return class_distribution(df, spec.label_col).select(
        F.lit("class_balance").alias("check"),
        F.col("label").alias("column"),
        (F.col("share") >= share).alias("passed"),
        F.col("share").alias("observed"),
        F.lit(float(share)).alias("limit"),
    )


def check_class_variance(df: DataFrame, spec: LabelledSpec) -> DataFrame:
    """Within-class sample variance does not exceed the overall one.

    One pass: the overall variance follows from the counts, means and variances
    of the classes.
    """
    aggs = [F.count("*").cast("double").alias("n")]
    for i, c in enumerate(spec.feature_cols):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.var_samp(x).alias(f"v{i}")]
    within = (
        df.groupBy(F.col(spec.label_col).cast("string").alias("label"))
        .agg(*aggs)
        .withColumn("rows", F.sum("n").over(_all()))
    )
    entries = []
    for i, c in enumerate(spec.feature_cols):
        mean = F.sum(F.col("n") * F.col(f"m{i}")).over(_all()) / F.col("rows")
        spread = F.coalesce((F.col("n") - 1) * F.col(f"v{i}"), F.lit(0.0))
        within = within.withColumn(f"g{i}", mean).withColumn(
            f"o{i}",
            F.sum(spread + F.col("n") * F.pow(F.col(f"m{i}") - F.col(f"g{i}"), F.lit(2.0))).over(_all())
            / (F.col("rows") - 1),
        )
        passed = F.coalesce(F.col(f"v{i}") <= F.col(f"o{i}"), F.lit(False))
        column = F.concat(F.lit(f"{c}/"), F.col("label"))
        entries.append(_entry("class_variance", column, passed, F.col(f"v{i}"), F.col(f"o{i}")))
    return _entries(within, entries)


def check_noise_metadata(metadata: DataFrame, sweep: DataFrame, spec: LabelledSpec) -> DataFrame:
    """Metadata agrees with the rows that actually changed."""
    seen = sweep.groupBy("noise_level").agg(
        F.count("original_label").alias("seen_rows"),
        F.count_if(F.col(spec.label_col) != F.col("original_label")).alias("changed"),
    )
    level = F.col("noise_level").cast("string")
    both = metadata.join(seen, "noise_level")
    entries = [
        _entry("metadata_level", level, F.col("noise_level").between(0.0, 1.0), F.col("noise_level"), 1.0),
        _entry("metadata_total", level, F.col("seen_rows") == F.col("total_rows"), F.col("seen_rows"), F.col("total_rows").cast("double")),
        _entry("metadata_noisy", level, F.col("changed") == F.col("noisy_rows"), F.col("changed"), F.col("noisy_rows").cast("double")),
    ]
    return _entries(both, entries)


def check_metric_bounds(
    metrics: DataFrame, classes: int, baseline: float = 0.0, max_drop: float = 0.4
) -> DataFrame:
    """Per noise level: accuracy in [0, 1], better than chance, and a bounded drop."""
    acc = metrics.where("metric = 'accuracy'")
    clean = F.max(F.when(F.col("noise_level") == baseline, F.col("value"))).over(_all())
    both = acc.withColumn("drop", clean - F.col("value"))
    level = F.col("noise_level").cast("string")
    entries = [
        _entry("accuracy_bounds", level, F.col("value").between(0.0, 1.0), F.col("value"), 1.0),
        _entry("better_than_chance", level, F.col("value") > 1.0 / classes, F.col("value"), 1.0 / classes),
        _entry("drop_bound", level, F.col("drop") < max_drop, F.col("drop"), max_drop),
    ]
    return _entries(both, entries)


def class_histogram(df: DataFrame, feature: str, label_col: str, bins: int = 20) -> DataFrame:
    """Equal-width bins between each class's own minimum and maximum; the last bin is closed.

    Missing values are in no bin; a class that has some gets a row for them with a null bin.
    """
    x = F.when(~missing(df, feature), F.col(feature).cast("double"))
    rows = df.select(F.col(label_col).cast("string").alias("label"), x.alias("x"))
    ends = rows.groupBy("label").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    width = F.col("high") - F.col("low")
    place = F.when(F.col("x").isNull(), F.lit(None)).when(
        width > 0, F.least(F.floor((F.col("x") - F.col("low")) / width * bins), F.lit(bins - 1))
    ).otherwise(F.lit(bins // 2))
    return (
        rows.join(ends, "label")
        .groupBy("label", place.cast("int").alias("bin"))
        .agg(F.count("*").alias("n"), F.first("low").alias("low"), F.first("high").alias("high"))
    )


PARTS = ("n", "a", "b", "aa", "bb", "ab")


def correlation_matrix(df: DataFrame, features: tuple[str, ...]) -> DataFrame:
    """(feature_a, feature_b, corr, well_formed) for all ordered pairs, whatever their number.

    A pair is judged on the rows that have both values; a pair without variation there has
    no correlation and is not well formed. Two passes: the means, then products of centred
    values, summed as matrices per batch and dealt out as one row per pair and task.
    """
    d = len(features)
    x = [F.when(~missing(df, c), F.col(c).cast("double")) for c in features]
    centre = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(x)]).first()
    centred = df.select(F.array(*[c - F.lit(m) if m is not None else F.lit(None).cast("double") for c, m in zip(x, centre)]).alias("x"))
    left, right = np.triu_indices(d)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(PARTS), d, d))
        for batch in batches:
            column = batch.column(0)
            values = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), d)
            there = ~np.isnan(values)
            v, w = np.where(there, values, 0.0), there.astype(float)
            total += np.stack([w.T @ w, v.T @ w, w.T @ v, (v * v).T @ w, w.T @ (v * v), v.T @ v])
        columns = [pa.array(left), pa.array(right), *[pa.array(t[left, right]) for t in total]]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", *PARTS])

    schema = "i bigint, j bigint, " + ", ".join(f"{p} double" for p in PARTS)
    sums = centred.mapInArrow(summed, schema).groupBy("i", "j").agg(*[F.sum(p).alias(p) for p in PARTS])
    n = F.col("n")
    spread = lambda square, one: F.col(square) - F.try_divide(F.col(one) * F.col(one), n)
    both = F.col("ab") - F.try_divide(F.col("a") * F.col("b"), n)
    # What rounding leaves of a constant column is no variation.
    varies = lambda square, one: spread(square, one) > 1e-12 * F.greatest(F.col(square), F.lit(1e-300))
    corr = F.when(varies("aa", "a") & varies("bb", "b"), both / F.sqrt(spread("aa", "a") * spread("bb", "b")))
    names = F.array(*[F.lit(c) for c in features])
    half = sums.select("i", "j", F.when(F.col("i") == F.col("j"), F.when(varies("aa", "a"), F.lit(1.0))).otherwise(corr).alias("corr"))
    whole = half.unionByName(half.where("i != j").select(F.col("j").alias("i"), F.col("i").alias("j"), "corr"))
    return whole.select(
        names[F.col("i").cast("int")].alias("feature_a"),
        names[F.col("j").cast("int")].alias("feature_b"),
        "corr",
        F.coalesce(F.col("corr").between(-1.000001, 1.000001), F.lit(False)).alias("well_formed"),
    )


def label_shift(before: DataFrame, after: DataFrame, label_col: str) -> DataFrame:
    """Class counts and shares of two versions, and the total variation between them."""
    a = class_distribution(before, label_col).select(
        "label", F.col("n").alias("n_before"), F.col("share").alias("share_before")
    )
    b = class_distribution(after, label_col).select(
        "label", F.col("n").alias("n_after"), F.col("share").alias("share_after")
    )
    both = a.join(b, "label", "full_outer").na.fill(0)
    moved = both.withColumn("share_delta", F.col("share_after") - F.col("share_before"))
    return moved.withColumn("n_delta", F.col("n_after") - F.col("n_before")).withColumn(
        "total_variation", F.sum(F.abs("share_delta")).over(_all()) / 2
    )
