"""Classification metrics over a scored table (id, label, prediction, probs).

``by`` names grouping columns (model, data set, noise level, fold), so that many
runs are measured in one pass. ``probs`` is ordered like the sorted vocabulary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from labelwright.functions.labels import literal_array
from labelwright.functions.local import local_table
from labelwright.operators.noise import label_grid
from labelwright.sources.scratch import store
from labelwright.spec import Params

AVERAGES = ("macro", "micro", "weighted")


def confusion_cells(scored: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Non-empty cells (label, prediction, n)."""
    return scored.groupBy(*by, "label", "prediction").agg(F.count("*").alias("n"))


def confusion_matrix(
    scored: DataFrame, labels: list[str], by: tuple[str, ...] = ()
) -> DataFrame:
    """Every cell of the matrix; rows are the true label, empty cells count 0."""
    cells = confusion_cells(scored, by)
    if by:
        every = literal_array(labels)
        runs = cells.select(*by).distinct()
        grid = runs.withColumn("label", F.explode(every)).withColumn("prediction", F.explode(every))
    else:
        grid = label_grid(scored.sparkSession, labels, "label", "prediction")
    return grid.join(cells, [*by, "label", "prediction"], "left").withColumn(
        "n", F.coalesce("n", F.lit(0).cast("bigint"))
    )


def per_class_metrics(cells: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Precision, recall, F1 and support of each label that occurs as truth or prediction.

    A rate without a base is 0.
    """
    sides = F.array(
        F.struct(
            F.col("label").alias("class"),
            F.col("n").alias("support"),
            F.lit(0).cast("bigint").alias("guessed"),
            F.when(F.col("label") == F.col("prediction"), F.col("n"))
            .otherwise(F.lit(0))
            .cast("bigint")
            .alias("hits"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            F.lit(0).cast("bigint").alias("support"),
            F.col("n").alias("guessed"),
            F.lit(0).cast("bigint").alias("hits"),
        ),
    )
    sums = (
        cells.where("n > 0")
        .select(*by, F.explode(sides).alias("s"))
        .groupBy(*by, F.col("s.class").alias("class"))
        .agg(
            F.sum("s.support").alias("support"),
            F.sum("s.guessed").alias("guessed"),
            F.sum("s.hits").alias("hits"),
        )
    )
    rate = lambda top, base: F.when(base > 0, top / base).otherwise(F.lit(0.0))
    return sums.select(
        *by,
        "class",
        rate(F.col("hits"), F.col("guessed")).alias("precision"),
        rate(F.col("hits"), F.col("support")).alias("recall"),
        rate(2 * F.col("hits"), F.col("guessed") + F.col("support")).alias("f1"),
        "support",
        "hits",
        "guessed",
    )


def averaged_metrics(classes: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per run: accuracy, then precision, recall and F1 in every average."""
    n = F.sum("support")
    accuracy = F.sum("hits") / n
    columns = [accuracy.alias("accuracy")]
    for name in ("precision", "recall", "f1"):
        columns += [
            F.avg(name).alias(f"{name}_macro"),
            accuracy.alias(f"{name}_micro"),
            (F.sum(F.col(name) * F.col("support")) / n).alias(f"{name}_weighted"),
        ]
    return classes.groupBy(*by).agg(*columns, n.alias("samples"))


def long_metrics(wide: DataFrame, names: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """(…by, metric, value)."""
    return wide.unpivot(list(by), names, "metric", "value")


METRIC_NAMES = ["accuracy"] + [
    f"{name}_{average}" for name in ("precision", "recall", "f1") for average in AVERAGES
]


def classification_metrics(scored: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Accuracy and the averaged rates, long form."""
    classes = per_class_metrics(confusion_cells(scored, by), by)
    return long_metrics(averaged_metrics(classes, by), METRIC_NAMES, by)


def classification_report(scored: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Class rows, then accuracy, macro and weighted average rows."""
    classes = per_class_metrics(confusion_cells(scored, by), by)
    rows = classes.select(*by, "class", "precision", "recall", "f1", "support")
    wide = averaged_metrics(classes, by)
    none = F.lit(None).cast("double")
    entry = lambda name, p, r, f: F.struct(
        F.lit(name).alias("class"),
        p.alias("precision"),
        r.alias("recall"),
        f.alias("f1"),
        F.col("samples").alias("support"),
    )
    totals = wide.select(
        *by,
        F.explode(
            F.array(
                entry("accuracy", none, none, F.col("accuracy")),
                entry("macro avg", F.col("precision_macro"), F.col("recall_macro"), F.col("f1_macro")),
                entry(
                    "weighted avg",
                    F.col("precision_weighted"),
                    F.col("recall_weighted"),
                    F.col("f1_weighted"),
                ),
            )
        ).alias("t"),
    ).select(*by, "t.*")
    return rows.unionByName(totals)


def roc_auc_ovr(scored: DataFrame, labels: list[str]) -> DataFrame:
    """(class, auc) one against the rest, and the macro mean.

    Defined for more than two true classes. Rows are counted per (class, score)
    first. Only scores other than zero become rows; how many rows of a class have
    none follows from the counts of the labels, so rows grow with the scores that
    a model gives and not with the number of classes. The running counts need an
    order over all scores: the counted table is range-partitioned and written,
    each range is accumulated on its own, and the totals of the ranges before it
    are added. No class and no score ends up in one task.
    """
    given = F.filter(
        F.transform("probs", lambda p, i: F.struct(i.alias("_i"), p.alias("score"))), lambda x: x["score"] != 0
    )
    scores = scored.select("label", F.explode(given).alias("_s")).select(
        "label", F.element_at(literal_array(labels), F.col("_s._i") + 1).alias("class"), F.col("_s.score").alias("score")
    )
    some = store(
        scores.groupBy("class", "score").agg(
            F.count_if(F.col("label") == F.col("class")).alias("pos"), F.count("*").alias("rows")
        ),
        "counted",
    )
    of_label = dict(scored.groupBy("label").count().collect())
    whole_rows = sum(of_label.values())
    classes = local_table(
        scored.sparkSession, [(c, of_label.get(c, 0), whole_rows) for c in labels], "_class string, _pos bigint, _rows bigint"
    )
    seen = some.groupBy("class").agg(F.sum("pos").alias("pos"), F.sum("rows").alias("rows"))
    rest = classes.join(seen, F.col("_class") == F.col("class"), "left").select(
        F.col("_class").alias("class"),
        F.lit(0.0).alias("score"),
        (F.col("_pos") - F.coalesce("pos", F.lit(0))).alias("pos"),
        (F.col("_rows") - F.coalesce("rows", F.lit(0))).alias("rows"),
    )
    counted = some.unionByName(rest.where("rows > 0"))
    ranged = store(
        counted.orderBy("class", "score").withColumn("range", F.spark_partition_id()), "scores"
    )
    totals = ranged.groupBy("class", "range").agg(
        F.sum("pos").alias("pos"), F.sum("rows").alias("rows")
    )
    before = (
        Window.partitionBy("class").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = Window.partitionBy("class")
    offsets = totals.select(
        "class",
        "range",
        F.coalesce(F.sum(F.col("rows") - F.col("pos")).over(before), F.lit(0)).alias("neg_before"),
        F.sum("pos").over(whole).alias("p"),
        F.sum(F.col("rows") - F.col("pos")).over(whole).alias("n"),
    )
    inside = (
        Window.partitionBy("class", "range")
        .orderBy("score")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    neg = F.col("rows") - F.col("pos")
    below = F.coalesce(F.sum(neg).over(inside), F.lit(0))
    placed = ranged.select(
        "class", "range", "pos", neg.alias("neg"), below.alias("neg_inside")
    ).join(offsets, ["class", "range"])
    per_class = (
        placed.groupBy("class")
        .agg(
            F.sum(
                F.col("pos")
                * (F.col("neg_before") + F.col("neg_inside") + F.col("neg") / F.lit(2.0))
            ).alias("wins"),
            F.max("p").alias("p"),
            F.max("n").alias("n"),
        )
        .where("p > 0 and n > 0")
        .select("class", (F.col("wins") / (F.col("p").cast("double") * F.col("n"))).alias("auc"))
    )
    enough = per_class.withColumn("_c", F.count("*").over(Window.partitionBy(F.lit(1)))).where("_c > 2")
    rows = enough.select("class", "auc")
    macro = rows.agg(F.avg("auc").alias("auc")).where("auc is not null")
    return rows.unionByName(macro.select(F.lit("macro").alias("class"), "auc"))


def prediction_confidence(scored: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    top = F.array_max("probs")
    return scored.groupBy(*by).agg(
        F.avg(top).alias("mean"),
        F.stddev_pop(top).alias("std"),
        F.min(top).alias("min"),
        F.max(top).alias("max"),
    )


def low_confidence(
    scored: DataFrame, threshold: float = Params.low_confidence, by: tuple[str, ...] = ()
) -> DataFrame:
    low = F.array_max("probs") < F.lit(threshold)
    return scored.groupBy(*by).agg(
        F.count_if(low).alias("count"),
        (F.avg(low.cast("double")) * 100).alias("percentage"),
        F.lit(threshold).alias("threshold"),
    )


def dataset_info(df: DataFrame, label_col: str, features: int, path: str) -> DataFrame:
    return df.agg(
        F.lit(path).alias("path"),
        F.count("*").alias("samples"),
        F.lit(features).alias("features"),
        F.count_distinct(label_col).alias("classes"),
    )
