"""Standardisation with the population standard deviation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T


@dataclass(frozen=True)
class Scaler:
    """Column means and population standard deviations, fitted once and applied anywhere."""

    cols: tuple[str, ...]
    means: tuple[float, ...]
    stds: tuple[float, ...]
    rows: int = 0

    def column(self, name: str) -> Column:
        i = self.cols.index(name)
        return (F.col(name).cast("double") - F.lit(self.means[i])) / F.lit(self.stds[i])

    def vector(self) -> Column:
        return F.array(*[self.column(c) for c in self.cols])

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.column(c) for c in self.cols})


def missing(df: DataFrame, name: str) -> Column:
    """True where a value is null, or not a number in a floating column."""
    column = F.col(name)
    floating = isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))
    return column.isNull() | F.isnan(column) if floating else column.isNull()


def fit_scaler(df: DataFrame, cols: tuple[str, ...]) -> Scaler:
    """One aggregation; the result is two numbers per column. A missing feature is an error."""
    aggs = [F.count("*").alias("rows")]
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [
            F.avg(x).alias(f"m{i}"),
            F.stddev_pop(x).alias(f"s{i}"),
            F.count_if(missing(df, c)).alias(f"n{i}"),
        ]
    row = df.agg(*aggs).collect()[0]
    nulls = [c for i, c in enumerate(cols) if row[f"n{i}"]]
    if nulls:
        raise ValueError(f"missing values in features: {nulls}")
    means = tuple(row[f"m{i}"] if row[f"m{i}"] is not None else 0.0 for i in range(len(cols)))
    stds = tuple(row[f"s{i}"] or 1.0 for i in range(len(cols)))
    return Scaler(tuple(cols), means, stds, row["rows"])


def raw_vector(cols: tuple[str, ...]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in cols])
