"""Suspect labels: neighbour disagreement, confident disagreement, and how well they do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from labelwright.functions.labels import literal_array
from labelwright.operators.noise import LabelNoise
from labelwright.spec import Params


def neighbour_suspects(
    near: DataFrame, k: int = Params.k, threshold: float = Params.threshold
) -> DataFrame:
    """(id, label, disagreements, disagreement_ratio, suspicious, confidence_score, neighbours).

    A row is suspicious when the share of its k neighbours with another label
    reaches the threshold.
    """
    differ = F.size(F.filter("neighbours", lambda v: v["label"] != F.col("label")))
    keep = [c for c in near.columns if c not in ("id", "label", "neighbours")]
    return (
        near.withColumn("disagreements", differ.cast("int"))
        .withColumn("disagreement_ratio", F.col("disagreements") / F.lit(float(k)))
        .select(
            "id",
            "label",
            "disagreements",
            "disagreement_ratio",
            (F.col("disagreement_ratio") >= F.lit(threshold)).alias("suspicious"),
            (F.lit(1.0) - F.col("disagreement_ratio")).alias("confidence_score"),
            "neighbours",
            *keep,
        )
    )


def relabel(near: DataFrame, noise: LabelNoise, levels: list[float] | None = None) -> DataFrame:
    """Neighbour lists as they would be at each noise level, with the row's truth.

    Neighbours depend on features alone, and the noise on the id alone, so one
    search serves every level and the noisy labels need no join.
    """
    levels = list(noise.counts) if levels is None else levels
    hashed = F.transform(
        "neighbours",
        lambda v: F.struct(
            v["d"].alias("d"), v["nid"].alias("nid"), v["label"].alias("label"), noise.hash(v["nid"]).alias("h")
        ),
    )
    decided = F.transform(
        "_hashed",
        lambda v: F.named_struct(
            F.lit("d"),
            v["d"],
            F.lit("nid"),
            v["nid"],
            F.lit("label"),
            v["label"],
            F.lit("other"),
            noise.other_label(v["h"], v["label"]),
            F.lit("from"),
            noise.flips_from(v["h"], v["nid"], v["label"]),
        ),
    )
    label, level = F.col("original_label"), F.col("noise_level")
    flipped = F.coalesce(level >= F.col("_from"), F.lit(False))
    return (
        near.select(
            "id",
            F.col("label").alias("original_label"),
            hashed.alias("_hashed"),
            noise.hash(F.col("id")).alias("_h"),
        )
        .select(
            "id",
            label,
            decided.alias("_near"),
            noise.other_label(F.col("_h"), label).alias("_other"),
            noise.flips_from(F.col("_h"), F.col("id"), label).alias("_from"),
        )
        # On its own: what a select computes beside an explode is computed for every level.
        .withColumn("noise_level", F.explode(F.array(*[F.lit(v) for v in levels])))
        .select(
            "noise_level",
            "id",
            F.when(flipped, F.col("_other")).otherwise(label).alias("label"),
            label,
            F.transform(
                "_near",
                lambda v: F.struct(
                    v["d"].alias("d"),
                    v["nid"].alias("nid"),
                    F.when(level >= v["from"], v["other"]).otherwise(v["label"]).alias("label"),
                ),
            ).alias("neighbours"),
            flipped.alias("flipped"),
        )
    )


def neighbour_detail(suspects: DataFrame) -> DataFrame:
    """One row per suspect and neighbour, nearest first."""
    return (
        suspects.where("suspicious")
        .select(
            "id",
            F.col("label").alias("original_label"),
            "disagreements",
            "disagreement_ratio",
            "confidence_score",
            F.posexplode("neighbours").alias("position", "n"),
        )
        .select(
            "id",
            "original_label",
            "disagreements",
            "disagreement_ratio",
            "confidence_score",
            (F.col("position") + 1).alias("rank"),
            F.col("n.nid").alias("neighbour_id"),
            F.col("n.label").alias("neighbour_label"),
            F.col("n.d").alias("distance"),
        )
    )


def suspicion_summary(suspects: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    flagged = F.count_if("suspicious")
    return suspects.groupBy(*by).agg(
        F.count("*").alias("total_rows"),
        flagged.alias("suspicious_rows"),
        (flagged / F.count("*")).alias("suspicion_rate"),
    )


def suspicion_by_class(suspects: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Suspicious rows and class size, for classes with at least one suspect."""
    flagged = F.count_if("suspicious")
    return (
        suspects.groupBy(*by, "label")
        .agg(
            flagged.alias("suspicious_rows"),
            F.count("*").alias("class_rows"),
            (flagged / F.count("*")).alias("ratio"),
        )
        .where("suspicious_rows > 0")
    )


def neighbour_votes(near: DataFrame, labels: list[str], k: int = Params.k) -> DataFrame:
    """Scored table (id, label, prediction, probs): the share of neighbours per class.

    Equal votes go to the smallest label.
    """
    vocab = literal_array(labels)
    votes = F.transform(
        vocab,
        lambda c: F.size(F.filter("neighbours", lambda v: v["label"] == c)) / F.lit(float(k)),
    )
    keep = [c for c in near.columns if c not in ("id", "label", "neighbours")]
    scored = near.select("id", "label", votes.alias("probs"), *keep)
    return scored.withColumn("prediction", predicted(F.col("probs"), labels))


def predicted(probs: Column, labels: list[str]) -> Column:
    place = F.array_position(probs, F.array_max(probs))
    return F.element_at(literal_array(labels), place.cast("int"))


def confident_disagreement(
    scored: DataFrame, labels: list[str], confidence: float = Params.confidence
) -> DataFrame:
    """Rows whose model disagrees with the label while its top probability exceeds the bound."""
    place = F.array_position(literal_array(labels), F.col("label")).cast("int")
    return (
        scored.withColumn("prediction_confidence", F.array_max("probs"))
        .where(
            (F.col("prediction") != F.col("label"))
            & (F.col("prediction_confidence") > F.lit(confidence))
        )
        .select(
            "id",
            F.col("label").alias("true_label"),
            F.col("prediction").alias("predicted_label"),
            "prediction_confidence",
            F.element_at("probs", place).alias("true_label_confidence"),
        )
    )


def detection_effectiveness(flags: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Counts and rates of (suspicious, flipped) rows; a rate without a base is null."""
    tp = F.count_if(F.col("suspicious") & F.col("flipped"))
    fp = F.count_if(F.col("suspicious") & ~F.col("flipped"))
    fn = F.count_if(~F.col("suspicious") & F.col("flipped"))
    tn = F.count_if(~F.col("suspicious") & ~F.col("flipped"))
    counted = flags.groupBy(*by).agg(
        tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn")
    )
    return counted.select(
        *by,
        "tp",
        "fp",
        "fn",
        "tn",
        F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide("tp", F.col("tp") + F.col("fn")).alias("recall"),
        F.try_divide("fp", F.col("fp") + F.col("tn")).alias("false_positive_rate"),
    )


def with_truth(suspects: DataFrame, ledger: DataFrame) -> DataFrame:
    """Join flags of an arbitrary detector with a per-row ledger (id, flipped)."""
    return suspects.join(ledger.select("id", "flipped"), "id", "left").withColumn(
        "flipped", F.coalesce("flipped", F.lit(False))
    )


def detection_roc(flags: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """True and false positive rate at every threshold on the disagreement ratio.

    Rows are counted per ratio first; there are at most k+1 of them.
    """
    counted = flags.groupBy(*by, F.col("disagreement_ratio").alias("threshold")).agg(
        F.count_if("flipped").alias("hits"), F.count_if(~F.col("flipped")).alias("misses")
    )
    whole = Window.partitionBy(*by)
    down = whole.orderBy(F.col("threshold").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return counted.select(
        *by,
        "threshold",
        F.try_divide(F.sum("hits").over(down), F.sum("hits").over(whole)).alias("tpr"),
        F.try_divide(F.sum("misses").over(down), F.sum("misses").over(whole)).alias("fpr"),
    )


def quarantine(df: DataFrame, suspects: DataFrame, id_col: str) -> DataFrame:
    """The rows that are not suspicious."""
    flagged = suspects.where("suspicious").select(F.col("id").alias(id_col))
    return df.join(flagged, id_col, "left_anti")


def confirmed(suspects: DataFrame, ledger: DataFrame) -> DataFrame:
    """Ids that are both detected and known to be flipped."""
    return suspects.where("suspicious").select("id").intersect(
        ledger.where("flipped").select("id")
    )
