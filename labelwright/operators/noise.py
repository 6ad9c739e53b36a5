"""Label noise: flip the labels of an exact share of rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from labelwright.functions.hashing import digits, row_hash
from labelwright.functions.labels import class_counts, literal_array
from labelwright.operators.cuts import Cut, at_or_before
from labelwright.operators.sampling import hash_cuts, within_cut
from labelwright.spec import LabelledSpec, Params, check_level


@dataclass(frozen=True)
class LabelNoise:
    """A fitted plan for one table: which ids flip at each level, and to what.

    A few literals per level describe it, so applying it is a projection: no
    shuffle, no join. Levels nest, because one hash order serves all of them.
    """

    spec: LabelledSpec
    seed: int
    labels: tuple[str, ...]
    total_rows: int
    counts: dict[float, int]
    cuts: dict[float, Cut | None]

    def selected(self, level: float) -> Column:
        """True for the rows that flip at the level."""
        row_id = F.col(self.spec.id_col)
        return within_cut(row_id, self.seed, self.cuts[level]) & F.col(self.spec.label_col).isNotNull()

    def hash(self, row_id: Column) -> Column:
        return row_hash(row_id, self.seed)

    def flips_from(self, h: Column, row_id: Column, label: Column) -> Column:
        """The lowest level at which the row flips; null if it never does.

        One hash and one comparison per level decide every level at once.
        """
        pick = F.when(label.isNull(), F.lit(None).cast("double"))
        for level in sorted(self.cuts):
            cut = self.cuts[level]
            if cut is not None:
                ends = [F.lit(v) for v in cut.values]
                pick = pick.when(at_or_before([h, row_id], ends), F.lit(level))
        return pick

    def other_label(self, h: Column, label: Column) -> Column:
        """One of the other labels, each equally likely, from the last digits of the hash."""
        vocab = literal_array(list(self.labels))
        step = digits(h, 25) % (len(self.labels) - 1)
        place = (F.array_position(vocab, label) + step) % len(self.labels)
        return F.element_at(vocab, (place + 1).cast("int"))

    def flip(self, df: DataFrame, level: float) -> DataFrame:
        """The table at one level, with its original label and a flag."""
        return self._noisy(df, [level])

    def sweep(self, df: DataFrame) -> DataFrame:
        """The table at every level, from one scan."""
        return self._noisy(df, list(self.counts))

    def _noisy(self, df: DataFrame, levels: list[float]) -> DataFrame:
        spec = self.spec
        own = (spec.id_col, *spec.feature_cols, spec.label_col)
        kept = [c for c in df.columns if c not in own]
        row_id, label, h = F.col(spec.id_col), F.col("original_label"), F.col("_h")
        return (
            spec.project(df, kept)
            .withColumnRenamed(spec.label_col, "original_label")
            .withColumn("_h", self.hash(row_id))
            .withColumns({"_from": self.flips_from(h, row_id, label), "_other": self.other_label(h, label)})
            # On its own, so that the two are computed once and not for every level.
            .withColumn("noise_level", F.explode(F.array(*[F.lit(level) for level in levels])))
            .withColumn("flipped", F.coalesce(F.col("noise_level") >= F.col("_from"), F.lit(False)))
            .select(
                "noise_level",
                spec.id_col,
                *spec.feature_cols,
                F.when(F.col("flipped"), F.col("_other")).otherwise(label).alias(spec.label_col),
                "original_label",
                "flipped",
                *kept,
            )
        )


def fit_label_noise(
    df: DataFrame,
    spec: LabelledSpec,
    levels: tuple[float, ...] = Params.noise_levels,
    seed: int = Params.seed,
    max_classes: int = Params.max_classes,
) -> LabelNoise:
    """Count classes and find the cut of every level. Rows without a label never flip."""
    levels = tuple(check_level(level) for level in levels)
    spec.check(df)
    classes = class_counts(df, spec.label_col, max_classes)
    if len(classes) < 2:
        raise ValueError("labels cannot be flipped with fewer than two classes")
    n = sum(classes.values())
    counts = {level: int(n * level) for level in levels}
    labelled = df.where(F.col(spec.label_col).isNotNull())
    found = hash_cuts(labelled, spec.id_col, seed, {"": list(counts.values())}, rows=n)
    by_rank = {c.rank: c for c in found}
    cuts = {level: by_rank.get(k) for level, k in counts.items()}
    return LabelNoise(spec, seed, tuple(classes), n, counts, cuts)


def label_grid(spark, labels: list[str] | tuple[str, ...], left: str, right: str) -> DataFrame:
    """Every ordered pair of labels, generated in parallel from the vocabulary."""
    c = len(labels)
    vocab = literal_array(list(labels))
    return spark.range(c * c).select(
        F.element_at(vocab, F.expr(f"cast(id div {c} as int)") + 1).alias(left),
        F.element_at(vocab, F.expr(f"cast(id % {c} as int)") + 1).alias(right),
    )


def transitions(noisy: DataFrame, spec: LabelledSpec, noise: LabelNoise) -> DataFrame:
    """Ledger (noise_level, original_label, new_label, n); pairs that never occur count 0."""
    spark = noisy.sparkSession
    counted = (
        noisy.where("flipped")
        .groupBy("noise_level", "original_label", F.col(spec.label_col).alias("new_label"))
        .agg(F.count("*").alias("n"))
    )
    levels = F.array(*[F.lit(level) for level in noise.counts])
    grid = (
        label_grid(spark, noise.labels, "original_label", "new_label")
        .where("original_label <> new_label")
        .withColumn("noise_level", F.explode(levels))
    )
    return grid.join(counted, ["noise_level", "original_label", "new_label"], "left").select(
        "noise_level", "original_label", "new_label", F.coalesce("n", F.lit(0)).alias("n")
    )


def noise_metadata(ledger: DataFrame, noise: LabelNoise, source: str) -> DataFrame:
    """One record per level; label_changes nests original label, new label and count."""
    nested = F.transform(
        F.array_sort(F.collect_list(F.struct("original_label", "pairs"))),
        lambda v: F.struct(v["original_label"], F.map_from_entries(v["pairs"])),
    )
    changes = (
        ledger.groupBy("noise_level", "original_label")
        .agg(
            F.sum("n").alias("changed"),
            F.array_sort(F.collect_list(F.struct("new_label", "n"))).alias("pairs"),
        )
        .groupBy("noise_level")
        .agg(
            F.sum("changed").alias("noisy_rows"),
            F.to_json(F.map_from_entries(nested)).alias("label_changes"),
        )
    )
    return changes.select(
        F.lit(source).alias("source"),
        "noise_level",
        F.lit(noise.total_rows).cast("bigint").alias("total_rows"),
        F.col("noisy_rows").cast("bigint").alias("noisy_rows"),
        F.lit(noise.seed).alias("random_seed"),
        "label_changes",
    )


def nesting_violations(
    sweep: DataFrame, spec: LabelledSpec, levels: tuple[float, ...]
) -> DataFrame:
    """For each pair of neighbouring levels: rows flipped at the lower level that are
    not flipped to the same label at the higher one."""
    ordered = sorted(levels)
    steps = list(zip(ordered, ordered[1:]))
    pairs = F.array(
        *[F.struct(F.lit(a).alias("lower"), F.lit(b).alias("higher")) for a, b in steps]
    )
    touched = sweep.where("flipped").select(
        F.col(spec.id_col).alias("id"), "noise_level", F.col(spec.label_col).alias("label")
    )
    per_row = (
        touched.withColumn("_p", F.explode(pairs))
        .where("noise_level = _p.lower or noise_level = _p.higher")
        .groupBy("id", F.col("_p.lower").alias("lower"), F.col("_p.higher").alias("higher"))
        .agg(
            F.max(F.when(F.col("noise_level") == F.col("_p.lower"), F.col("label"))).alias("at_lower"),
            F.max(F.when(F.col("noise_level") == F.col("_p.higher"), F.col("label"))).alias("at_higher"),
        )
    )
    return per_row.groupBy("lower", "higher").agg(
        F.count("at_lower").alias("lower_rows"),
        F.count_if(
            F.col("at_lower").isNotNull() & ~F.col("at_lower").eqNullSafe(F.col("at_higher"))
        ).alias("violations"),
    )


def label_diff(before: DataFrame, after: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """Rows whose label differs between two versions of a table."""
    a = before.select(F.col(id_col), F.col(label_col).cast("string").alias("label_before"))
    b = after.select(F.col(id_col), F.col(label_col).cast("string").alias("label_after"))
    return a.join(b, id_col).where(~F.col("label_before").eqNullSafe(F.col("label_after")))
