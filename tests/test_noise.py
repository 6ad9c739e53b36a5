import json

import pytest
from pyspark.sql import functions as F

from labelwright.operators.feature_noise import add_feature_noise, inject_outliers
from labelwright.operators.noise import (
    fit_label_noise,
    label_diff,
    nesting_violations,
    noise_metadata,
    transitions,
)
from labelwright.operators.sampling import sample_exact, sample_fractions
from labelwright.spec import LabelledSpec
from tests.conftest import CLUSTERS


def changed(df):
    return df.where("target <> original_label").count()


@pytest.mark.parametrize("level", [0.0, 0.05, 0.1, 0.29, 0.5, 1.0])
def test_exact_number_of_labels_changes(clean, level):
    noisy = fit_label_noise(clean, CLUSTERS, (level,)).flip(clean, level)
    assert noisy.count() == 150
    assert changed(noisy) == noisy.where("flipped").count() == int(150 * level)


def test_features_stay(clean):
    noisy = fit_label_noise(clean, CLUSTERS, (0.5,)).flip(clean, 0.5)
    assert noisy.select("id", "feature1", "feature2").exceptAll(
        clean.select("id", "feature1", "feature2")
    ).isEmpty()


def test_level_too_low_changes_nothing_but_is_reported(clean):
    noise = fit_label_noise(clean, CLUSTERS, (0.001,))
    noisy = noise.flip(clean, 0.001)
    record = noise_metadata(transitions(noisy, CLUSTERS, noise), noise, "clusters").collect()
    assert changed(noisy) == 0
    assert [(r.total_rows, r.noisy_rows, r.random_seed) for r in record] == [(150, 0, 42)]


def test_ledger_has_every_pair_and_adds_up(clean):
    noise = fit_label_noise(clean, CLUSTERS, (0.1, 0.5))
    ledger = transitions(noise.sweep(clean), CLUSTERS, noise)
    rows = ledger.groupBy("noise_level").agg(F.count("*").alias("pairs"), F.sum("n").alias("n")).collect()
    assert {(r.noise_level, r.pairs, r.n) for r in rows} == {(0.1, 6, 15), (0.5, 6, 75)}
    text = noise_metadata(ledger, noise, "clusters").where("noise_level = 0.1").first().label_changes
    nested = json.loads(text)
    assert sorted(nested) == ["A", "B", "C"] and sorted(nested["A"]) == ["B", "C"]
    assert sum(n for to in nested.values() for n in to.values()) == 15


@pytest.mark.parametrize("level", [-0.1, 1.1])
def test_bad_level(clean, level):
    with pytest.raises(ValueError):
        fit_label_noise(clean, CLUSTERS, (level,))


def test_one_class_cannot_flip(clean):
    with pytest.raises(ValueError):
        fit_label_noise(clean.where("target = 'A'"), CLUSTERS)


def test_rows_without_label_never_flip(clean):
    holes = clean.withColumn("target", F.expr("if(id % 3 = 0, null, target)"))
    noise = fit_label_noise(holes, CLUSTERS, (1.0,))
    noisy = noise.flip(holes, 1.0)
    assert noise.total_rows == 100
    assert noisy.where("target is null and not flipped").count() == 50
    assert changed(noisy) == 100


def test_partitioning_does_not_matter(spark, clean):
    a = fit_label_noise(clean, CLUSTERS).sweep(clean)
    spread = clean.repartition(7, "feature1")
    b = fit_label_noise(spread, CLUSTERS).sweep(spread)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_seed_matters(clean):
    a = fit_label_noise(clean, CLUSTERS, (0.1,), seed=1).flip(clean, 0.1).where("flipped").select("id")
    b = fit_label_noise(clean, CLUSTERS, (0.1,), seed=2).flip(clean, 0.1).where("flipped").select("id")
    assert not a.exceptAll(b).isEmpty()


def test_new_labels_are_spread(spark):
    df = spark.range(20_000).select("id", F.rand(1).alias("f"), F.expr("cast(id % 5 as string)").alias("label"))
    spec = LabelledSpec.of(df, "id")
    noise = fit_label_noise(df, spec, (0.5,))
    counts = [r.n for r in transitions(noise.flip(df, 0.5), spec, noise).collect()]
    assert len(counts) == 20 and min(counts) > 400 and max(counts) < 600


def test_levels_nest(clean):
    levels = (0.05, 0.1, 0.5)
    sweep = fit_label_noise(clean, CLUSTERS, levels).sweep(clean)
    assert [r.violations for r in nesting_violations(sweep, CLUSTERS, levels).collect()] == [0, 0]


def test_diff_sees_flips_and_lost_labels(clean, flipped):
    assert label_diff(clean, flipped, "id", "target").count() == 10
    holes = clean.withColumn("target", F.expr("if(id = 1, null, target)"))
    assert label_diff(clean, holes, "id", "target").count() == 1


def test_large_selection_takes_several_counting_rounds(spark, monkeypatch):
    from labelwright.operators import cuts

    monkeypatch.setattr(cuts, "COUNTED_BUCKETS", 16)
    monkeypatch.setattr(cuts, "SORTABLE_ROWS", 10)
    df = spark.range(5000).select("id", F.lit(1.0).alias("f"), F.lit("a").alias("label"))
    expected = {
        r.id
        for r in df.selectExpr("id", "md5(concat('42:', id)) as h").orderBy("h", "id").limit(1234).collect()
    }
    found = {r.id for r in sample_exact(df, "id", 1234 / 5000).collect()}
    assert found == expected


def test_repeated_id_is_an_error(spark, monkeypatch):
    from labelwright.operators import cuts

    monkeypatch.setattr(cuts, "SORTABLE_ROWS", 10)
    df = spark.range(100).select(F.lit(1).alias("id"), F.lit(1.0).alias("f"))
    with pytest.raises(ValueError, match="unique"):
        sample_exact(df, "id", 0.5)


def test_feature_noise_has_the_asked_scale(spark):
    df = spark.range(20_000).select("id", (F.randn(3) * 4).alias("f"), F.lit("a").alias("label"))
    spec = LabelledSpec.of(df, "id")
    both = df.join(add_feature_noise(df, spec).select("id", F.col("f").alias("g")), "id")
    row = both.agg(F.stddev("f").alias("s"), F.avg(F.expr("g - f")).alias("m"), F.stddev(F.expr("g - f")).alias("d")).first()
    assert abs(row.m) < 0.02 and abs(row.d / row.s - 0.1) < 0.005


def test_outliers_leave_labels_alone(clean):
    out = inject_outliers(clean, CLUSTERS)
    assert out.where("outlier").count() == 5
    assert out.select("id", "target").exceptAll(clean.select("id", "target")).isEmpty()
    assert out.where("feature1 is null or feature2 is null").isEmpty()


def test_repeated_ids_are_an_error_at_every_size(spark):
    df = spark.range(400).selectExpr("id div 4 as id")
    with pytest.raises(ValueError, match="unique"):
        sample_exact(df, "id", 10 / 400)


def test_fractions_nest_in_one_scan(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    rows = sample_fractions(df, "k", (0.0, 0.25, 0.5)).collect()
    by = {f: {r.k for r in rows if r.fraction == f} for f in (0.0, 0.25, 0.5)}
    assert (len(by[0.0]), len(by[0.25]), len(by[0.5])) == (0, 25, 50) and by[0.25] < by[0.5]
    assert by[0.25] == {r.k for r in sample_exact(df, "k", 0.25).collect()}
