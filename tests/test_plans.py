"""Shapes of physical plans, and the entry points."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from labelwright.operators.detect import relabel
from labelwright.operators.noise import fit_label_noise
from labelwright.operators.split import stratified_folds, train_test_split
from labelwright.plans import inputs as I, models, neighbours
from labelwright.sources.scratch import store


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_noise_is_a_projection(spark, sf_dir):
    df = I.orders(spark, sf_dir)
    text = plan(fit_label_noise(df, I.ORDERS).sweep(df))
    assert "Exchange" not in text and "Window" not in text and "Join" not in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in text


def test_split_and_folds_do_not_shuffle_the_table(spark, sf_dir):
    df = I.orders(spark, sf_dir)
    for built in (train_test_split(df, I.ORDERS), stratified_folds(df, I.ORDERS)):
        text = plan(built)
        assert "hashpartitioning" not in text and "SinglePartition" not in text and "Window" not in text


def test_level_filter_reaches_nothing_but_the_flagged_rows(spark, sf_dir):
    df = I.orders(spark, sf_dir)
    text = plan(df.where(fit_label_noise(df, I.ORDERS, (0.1,)).selected(0.1)).select("o_orderkey"))
    assert "o_totalprice" not in text


def test_no_cartesian_product_in_reports(spark, sf_dir):
    for name in ("check_class_variance", "label_shift", "class_distribution", "correlation_matrix"):
        text = plan(entry_point.queries()[name](spark, sf_dir))
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text), name


def test_entry(spark):
    assert entry_point.entry(spark).count() == 4


def test_every_oracle_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_the_split_groups_the_lines_once(spark, sf_dir, monkeypatch):
    """The split reads its rows more than once; the table behind them is grouped for the first time only."""
    bands, seen = I.part_bands, spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    def counted(spark, sf_dir):
        rows = bands(spark, sf_dir)
        return rows.mapInArrow(count, rows.schema)

    monkeypatch.setattr(I, "part_bands", counted)
    assert models._split(spark, sf_dir).count() == seen.value == bands(spark, sf_dir).count()


def test_flips_are_decided_once_for_all_levels(spark, sf_dir):
    """Hashes and other labels are computed below the explode over the levels, not for each of them."""
    bands = store(I.part_bands(spark, sf_dir), "bands")
    noise = fit_label_noise(bands, I.BANDS)
    near = spark.createDataFrame([], "id long, label string, neighbours array<struct<d:double,nid:bigint,label:string>>")
    for df in (relabel(near, noise), noise.sweep(bands)):
        above, below = df._jdf.queryExecution().optimizedPlan().toString().split("Generate", 1)
        assert "conv(" not in above and "md5(" not in above


def test_detection_effectiveness_groups_the_lines_once(spark, sf_dir, monkeypatch):
    bands, seen = I.order_bands, spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    def counted(spark, sf_dir):
        rows = bands(spark, sf_dir)
        return rows.mapInArrow(count, rows.schema)

    monkeypatch.setattr(I, "order_bands", counted)
    neighbours.detection_effectiveness(spark, sf_dir).collect()
    assert seen.value == bands(spark, sf_dir).count()
