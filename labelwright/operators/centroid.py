"""Nearest class mean on standardised features.

A deterministic classifier with one aggregation to fit and none to score. The
report operators take any scored table; this one lets their results be checked
row for row, which tree ensembles do not.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from labelwright.functions.local import local_table
from labelwright.operators.detect import predicted
from labelwright.spec import LabelledSpec, Params



@dataclass(frozen=True)
class Centroids:
    """Per run (a value of the ``by`` column): means, deviations, and one class mean each."""

    spec: LabelledSpec
    by: str | None
    labels: tuple[str, ...]
    runs: dict[object, tuple[list[float], list[float], list[list[float] | None]]]

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``probs`` (share of exp(-distance)) and ``prediction``."""
        rows = [(str(run), stds, centres) for run, (_, stds, centres) in self.runs.items()]
        if self.by is None:
            placed = df.withColumns(
                {
                    "_s": F.from_json(F.lit(json.dumps(rows[0][1])), "array<double>"),
                    "_c": F.from_json(F.lit(json.dumps(rows[0][2])), "array<array<double>>"),
                }
            )
        else:
            schema = "_run string, _s array<double>, _c array<array<double>>"
            table = local_table(df.sparkSession, rows, schema)
            placed = df.join(F.broadcast(table), F.col(self.by).cast("string") == F.col("_run"))
        x = F.array(*[F.col(c).cast("double") for c in self.spec.feature_cols])

        def weight(centre: Column) -> Column:
            gaps = F.zip_with(
                F.zip_with(x, centre, lambda a, b: a - b), F.col("_s"), lambda g, sd: g / sd
            )
            square = F.aggregate(gaps, F.lit(0.0), lambda total, g: total + g * g)
            return F.when(centre.isNull(), F.lit(0.0)).otherwise(
                F.exp(-F.round(F.sqrt(square), 9))
            )

        total = F.aggregate("_w", F.lit(0.0), lambda a, w: a + w)
        # The total is repeated beside the weights, so that it is summed once per row.
        totals = F.array_repeat(total, len(self.labels))
        return (
            placed.withColumn("_w", F.transform("_c", weight))
            .withColumns(
                {
                    "probs": F.zip_with("_w", totals, lambda w, t: w / t),
                    "prediction": predicted(F.col("_w"), list(self.labels)),
                }
            )
            .drop("_run", "_s", "_c", "_w")
        )


def fit_centroids(
    df: DataFrame,
    spec: LabelledSpec,
    by: str | None = None,
    held_out: bool = False,
    max_moments: int = 10 * Params.max_classes,
) -> Centroids:
    """One aggregation over the table, for every run at once.

    With ``held_out`` the run named by a value is fitted on all rows that do *not*
    carry it: cross-validation without a pass per fold. Runs times classes is
    what reaches the driver, and more than ``max_moments`` of them is an error.
    """
    d = len(spec.feature_cols)
    aggs = [F.count("*").alias("n")]
    for i, c in enumerate(spec.feature_cols):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}")]
    run = F.lit("") if by is None else F.col(by).cast("string")
    rows = (
        df.where(F.col(spec.label_col).isNotNull())
        .groupBy(run.alias("_run"), F.col(spec.label_col).cast("string").alias("_label"))
        .agg(*aggs)
        .limit(max_moments + 1)
        .collect()
    )
    if len(rows) > max_moments:
        raise ValueError(f"runs times classes exceed {max_moments}")
    parts: dict[str, dict[str, tuple]] = {}
    for r in rows:
        moments = (r["n"], [r[f"m{i}"] for i in range(d)], [r[f"v{i}"] * r["n"] for i in range(d)])
        parts.setdefault(r["_run"], {})[r["_label"]] = moments
    labels = tuple(sorted({label for p in parts.values() for label in p}))
    runs = {}
    for name in parts:
        used = [p for r, p in parts.items() if (r != name) == held_out]
        centres: list = []
        for label in labels:
            merged = _merge([p[label] for p in used if label in p], d)
            centres.append(merged)
        whole = _merge([c for c in centres if c], d)
        stds = [math.sqrt(q / whole[0]) or 1.0 for q in whole[2]]
        runs[name] = (whole[1], stds, [c[1] if c else None for c in centres])
    return Centroids(spec, by, labels, runs)


def _merge(parts: list[tuple], d: int) -> tuple | None:
    """Combine counts, means and squared deviations."""
    if not parts:
        return None
    n = sum(p[0] for p in parts)
    means = [sum(p[0] * p[1][i] for p in parts) / n for i in range(d)]
    squares = [
        sum(p[2][i] + p[0] * (p[1][i] - means[i]) ** 2 for p in parts) for i in range(d)
    ]
    return n, means, squares
