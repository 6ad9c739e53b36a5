import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelwright.operators import approximate as A
from labelwright.operators.neighbours import build_index, search_index
from labelwright.sources.scratch import store
from tests.test_neighbours import brute, frame, result


def clustered(rows, dims, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(40, dims)) * 4
    return centres[rng.integers(0, 40, rows)] + rng.normal(size=(rows, dims)) * rng.uniform(0.2, 1.0, dims)


@pytest.mark.parametrize("dims", [3, 64])
def test_recall_against_all_rows(spark, dims):
    """Ids divisible by 20 against all rows; a fraction of the rows is looked at."""
    x = clustered(6000, dims, dims)
    df = frame(spark, np.arange(6000), x)
    asked = df.where("id % 20 = 0")
    index = A.build_projection_index(df, 5)
    found = A.approximate_search(index, asked, skip_same_id=True)
    exact = search_index(build_index(df, 5), asked, skip_same_id=True)
    facts = A.recall(found, exact).first()
    assert facts.queries == 300 and facts.expected == 1500
    assert facts.recall >= 0.9
    looked = A.visits(index, asked).join(index.sizes, "block").agg(F.sum("held")).first()[0]
    assert looked < 0.2 * 300 * 6000


def test_every_row_is_in_every_table_and_buckets_stay_small(spark):
    x = clustered(2000, 4, 1)
    index = A.build_projection_index(frame(spark, np.arange(2000), x), 5, tables=3, bucket_rows=50)
    assert index.points.count() == 3 * 2000
    assert index.sizes.agg(F.max("held")).first()[0] <= 50


def test_distances_are_exact_and_all_buckets_give_the_exact_result(spark):
    x = np.round(clustered(400, 3, 2), 1)
    ids = np.arange(400)
    df = frame(spark, ids, x)
    index = A.build_projection_index(df, 5, tables=1, bucket_rows=10_000)
    assert result(A.approximate_search(index, df, skip_same_id=True)) == brute(ids, x, 5)


@pytest.mark.parametrize("leaf_bytes", [13, 1 << 40])
def test_rows_that_fit_one_bucket_lie_in_one(spark, monkeypatch, leaf_bytes):
    """The empty beginning is a bucket too, and no neighbour lies behind a border then."""
    monkeypatch.setattr(A, "LEAF_BYTES", leaf_bytes)
    x = clustered(60, 3, 5)
    df = frame(spark, np.arange(60), x)
    index = A.build_projection_index(df, 5, tables=2)
    assert index.depths == (0,) and [r.held for r in index.sizes.collect()] == [60, 60]
    assert result(A.approximate_search(index, df, skip_same_id=True)) == brute(np.arange(60), x, 5)


def test_points_of_one_code_are_dealt_into_parts(spark, monkeypatch):
    """Rows that no projection tells apart: the sample has one value, so all share a code."""
    monkeypatch.setattr(A, "SAMPLE_ROWS", 10)
    x = np.full((600, 2), 5.0)
    x[:500, 0] += np.arange(500) * 1e-9
    x[500:] = np.random.default_rng(0).normal(size=(100, 2))
    ids = np.arange(600)
    df = frame(spark, ids, x)
    index = A.build_projection_index(df, 3, tables=2, bucket_rows=40, sample_rows=600)
    found = A.approximate_search(index, df.where("id < 20"), skip_same_id=True)
    exact = search_index(build_index(df, 3), df.where("id < 20"), skip_same_id=True)
    assert A.recall(found, exact).first().recall == 1.0


def test_queries_far_away_bad_ones_and_none(spark):
    df = frame(spark, range(200), clustered(200, 3, 3))
    index = A.build_projection_index(df, 4)
    far = frame(spark, [999], [[1e6, -1e6, 1e6]])
    assert A.approximate_search(index, far).first().id == 999
    assert A.approximate_search(index, df.where("id < 0")).isEmpty()
    with pytest.raises(ValueError, match="finite"):
        A.approximate_search(index, frame(spark, [1], [[1.0]]))


def test_partitioning_does_not_matter(spark):
    df = frame(spark, range(500), clustered(500, 5, 4))
    one, two = (result(A.approximate_search(A.build_projection_index(d, 4), df)) for d in (df, df.repartition(11)))
    assert one == two


def test_leaves_are_found_without_copies_of_the_rows_per_depth(spark, monkeypatch):
    """The bisection finds the buckets that the join on every depth finds."""
    df = frame(spark, range(800), clustered(800, 3, 6))
    index = A.build_projection_index(df, 4, tables=2, bucket_rows=8)
    assert len(index.depths) > 1
    plan = index.points._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan
    pick = lambda index: {(r.id, r.block) for r in index.points.select("id", "block").collect()}
    looks = lambda index: {(r.qid, r.block) for r in A.visits(index, df.where("id % 20 = 0")).collect()}
    own, seen = pick(index), looks(index)
    monkeypatch.setattr(A, "LEAF_BYTES", 1 << 40)
    other = A.build_projection_index(df, 4, tables=2, bucket_rows=8)
    assert pick(other) == own and looks(other) == seen and len(own) == 1600


def test_dense_regions_get_finer_bins(spark):
    """Rows that lie in one bin of every direction are told apart by the next digits, not visited together."""
    x = np.random.default_rng(9).normal(size=(4000, 3))
    x[:300] = 40 + 0.005 * x[:300]
    df = frame(spark, np.arange(4000), x)
    index = A.build_projection_index(df, 5)
    assert index.leaves.agg(F.max("parts")).first()[0] == 1
    assert index.leaves.groupBy("t").agg(F.sum("n").alias("n")).where("n <> 4000").isEmpty()
    asked = df.where("id % 20 = 0")
    found = A.approximate_search(index, asked, skip_same_id=True)
    assert A.recall(found, search_index(build_index(df, 5), asked, skip_same_id=True)).first().recall >= 0.9


def test_shuffle_files_go_with_the_write_that_needed_them(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {n for f in [manager.getAllFiles()] for n in (f.apply(i).getName() for i in range(f.size())) if n.startswith("shuffle_")}
    before = held()
    store(spark.range(5000).repartition(3, "id"), "rows")
    for _ in range(50):
        if not held() - before:
            break
        time.sleep(0.1)
    assert not held() - before
