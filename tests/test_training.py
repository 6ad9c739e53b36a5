"""Fold-parallel fits, the kernel machine's bounds, and forests that do not depend on partitions."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from labelwright.operators import forest as R
from labelwright.operators import models as M
from labelwright.operators import parallel as P
from labelwright.sources import scratch
from labelwright.spec import LabelledSpec, Params
from tests.conftest import CLUSTERS, clusters


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 3)) * [1.0, 20.0, 0.1] + [0, 5, -3]
    y = (x[:, 0] + x[:, 1] / 20 + rng.normal(size=600) * 0.5 > 0.3).astype(int) + (x[:, 2] > -2.95)
    rows = [([float(v) for v in a], int(b), i % 4 + 1, i) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "x array<double>, y int, fold int, id long").repartition(5)
    return scratch.store(df, "table"), x, y, np.arange(600) % 4 + 1


def test_scaling_leaves_the_fold_out(table):
    df, x, _, fold = table
    maps, rows = P.standards(df, (0, 1, 2, 3, 4), 3)
    for r in range(5):
        own = x[fold != r] if r else x
        assert rows[r] == len(own)
        assert np.allclose(maps[r].means, own.mean(axis=0)) and np.allclose(maps[r].stds, own.std(axis=0))


def test_constant_columns_divide_by_one(spark):
    df = spark.createDataFrame([([7.1, float(i)], i % 2, 0, i) for i in range(30)], "x array<double>, y int, fold int, id long")
    maps, _ = P.standards(df, (0,), 2)
    assert maps[0].stds[0] == 1.0


def test_softmax_of_all_folds_equals_single_fits(table):
    df, x, y, fold = table
    runs = (0, 1, 2, 3, 4)
    maps, rows = P.standards(df, runs, 3)
    penalty = {r: 1 / rows[r] for r in runs}
    fits = P.fit_softmax(df, maps, rows, 3, penalty, 500, 1e-7)
    for r in runs:
        f = maps[r](x[fold != r] if r else x)
        own = y[fold != r] if r else y
        w = fits[r].weights
        z = f @ w.T
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        keep = w.copy()
        keep[:, -1] = 0
        slope = (p - np.eye(3)[own]).T @ f / len(own) + penalty[r] * keep
        assert np.abs(slope).max() < 1e-6
    alone = P.fit_softmax(df.where("fold != 2").withColumn("fold", F.lit(0)), {0: maps[2]}, {0: rows[2]}, 3, {0: penalty[2]}, 500, 1e-7)
    assert np.allclose(alone[0].weights[:, :3] - alone[0].weights[:, :3].mean(axis=0), fits[2].weights[:, :3] - fits[2].weights[:, :3].mean(axis=0), atol=1e-4)


def test_kernel_machine_is_within_its_gap(table):
    df, x, y, fold = table
    maps, rows = P.standards(df, (0, 3), 3)
    landmarks = {r: P.fit_landmarks(maps[r], x[fold != r] if r else x, 0.01) for r in (0, 3)}
    error = P.kernel_error(df, landmarks, rows)
    for r in (0, 3):
        own = x[fold != r] if r else x
        exact = P.kernel(maps[r].scaled(own), maps[r].scaled(own), 1 / 3)
        f = landmarks[r].features(own)
        assert error[r] == pytest.approx((1 - (f * f).sum(axis=1)).mean(), abs=1e-9) and error[r] <= 0.01 + 1e-6
        assert np.abs(f @ f.T - exact).max() < 0.2 and len(landmarks[r].points) < 200
    fits = P.fit_margins(df, landmarks, rows, 3, 1.0, 200, 1e-3)
    assert all(0 <= f.gap <= 1e-3 for f in fits.values())
    # The value cannot be beaten by more than the gap, whatever the weights.
    f, own = landmarks[0](x), np.where(y[:, None] == np.arange(3), 1.0, -1.0)
    rng = np.random.default_rng(0)

    def value(w):
        short = 1 - own * (f @ w.T)
        loss = np.where(short > P.ROUND, short - P.ROUND / 2, np.maximum(short, 0) ** 2 / (2 * P.ROUND))
        return (w * w).sum() / (2 * 600) + loss.sum() / 600

    best = value(fits[0].weights)
    assert best == pytest.approx(fits[0].value, rel=1e-6)
    for _ in range(20):
        assert value(fits[0].weights + rng.normal(size=fits[0].weights.shape) * 0.05) >= best * (1 - 2e-3)


def test_tolerance_decides_on_the_landmarks(table):
    _, x, _, _ = table
    base = P.Standard(x.mean(axis=0), x.std(axis=0))
    few, many = (len(P.fit_landmarks(base, x, t).points) for t in (0.1, 0.001))
    assert few < many
    assert len(P.fit_landmarks(base, np.repeat(x[:3], 50, axis=0), 0.0).points) == 3


@pytest.mark.parametrize("name", M.MODELS)
def test_saved_models_score_the_same(spark, clean, tmp_path, name):
    model = M.fit_model(name, clean, CLUSTERS, Params(trees=5))
    path = str(tmp_path / name)
    M.save_model(model, path)
    a, b = (M.score_model(m, clean, CLUSTERS) for m in (model, M.load_model(path)))
    assert a.exceptAll(b).isEmpty() and a.count() == 150
    assert a.where("abs(aggregate(probs, 0D, (s, p) -> s + p) - 1) > 1e-9").isEmpty()
    assert a.where("label = prediction").count() >= 145


def nodes(model):
    return [model.tree.tolist(), model.path.tolist(), model.feature.tolist(), model.cut.tolist(), model.counts.tolist()]


def test_forest_is_the_same_for_any_partitioning_and_growth(table, monkeypatch):
    """Nodes split level by level over the table are those that one task finds."""
    df, *_ = table
    args = (["a", "b", "c"], ("f", "g", "h"), (0, 2), 7, 30, 42)
    want = {r: nodes(m) for r, m in R.fit_forests(df, *args).items()}
    other = scratch.store(df.repartition(3, "fold").sortWithinPartitions(F.desc("id")), "other")
    assert {r: nodes(m) for r, m in R.fit_forests(other, *args).items()} == want
    for limit in (200, 20):
        monkeypatch.setattr(R, "LOCAL_ROWS", limit)
        assert {r: nodes(m) for r, m in R.fit_forests(df, *args).items()} == want
    monkeypatch.setattr(R, "CELLS", 1000)
    monkeypatch.setattr(R, "LOCAL_ROWS", 8192)
    assert {r: nodes(m) for r, m in R.fit_forests(df, *args).items()} == want


def test_forest_learns_and_keeps_the_fold_out(table):
    df, x, y, fold = table
    models = R.fit_forests(df, ["a", "b", "c"], ("f", "g", "h"), (0, 2), 30, 30, 1)
    seen = models[0].probabilities(x)
    assert (seen.argmax(axis=1) == y).mean() > 0.97
    held = models[2].probabilities(x[fold == 2])
    assert 0.6 < (held.argmax(axis=1) == y[fold == 2]).mean() < 1.0
    assert models[0].importances().sum() == pytest.approx(1.0)
    # A tree's root holds its bootstrap sample, and every node the sum of its children.
    m = models[2]
    for t in range(3):
        own = m.tree == t
        at = {p: c for p, c in zip(m.path[own], m.counts[own])}
        drawn = R.bootstrap(np.arange(600), 1, t)[fold != 2].sum()
        assert at[1].sum() == drawn
        for p, f in zip(m.path[own], m.feature[own]):
            if f >= 0:
                assert np.array_equal(at[2 * p] + at[2 * p + 1], at[p])


def test_best_cut_equals_trying_all():
    rng = np.random.default_rng(0)
    hist = rng.integers(0, 5, size=(20, 9, 3)).astype(float)
    gain, at = R._best(hist)
    for k in range(20):
        total = hist[k].sum(axis=0)
        tried = []
        for b in range(8):
            left = hist[k, : b + 1].sum(axis=0)
            right = total - left
            if left.sum() and right.sum():
                tried.append((left**2).sum() / left.sum() + (right**2).sum() / right.sum() - (total**2).sum() / total.sum())
        assert gain[k] == pytest.approx(max(tried))


def test_depth_and_single_class(spark):
    pdf = clusters()
    df = spark.createDataFrame(pdf)
    shallow = M.fit_model(M.RANDOM_FOREST, df, CLUSTERS, Params(trees=3, max_depth=1))
    assert shallow.path.max() <= 3
    one = M.fit_model(M.RANDOM_FOREST, df.withColumn("target", F.lit("only")), CLUSTERS, Params(trees=3))
    assert set(M.score_model(one, df, CLUSTERS).select("prediction").toPandas()["prediction"]) == {"only"}
    with pytest.raises(ValueError):
        M.fit_model(M.LOGISTIC, df.withColumn("target", F.lit("only")), CLUSTERS)


def test_forests_grow_from_cells_and_the_node_limit_is_that_of_one_model(spark, monkeypatch):
    """Rows of equal bins, class and fold are one; draws add up to those of the rows."""
    rng = np.random.default_rng(3)
    x, fold = rng.integers(0, 6, size=(30_000, 2)).astype(float), np.arange(30_000) % 2 + 1
    y = (x.sum(axis=1) > 5).astype(int)
    rows = [(v.tolist(), int(c), int(f), i) for i, (v, c, f) in enumerate(zip(x, y, fold))]
    df = scratch.store(spark.createDataFrame(rows, "x array<double>, y int, fold int, id bigint"), "rows").repartition(3)
    cells = R._cells(df, [R._edges(x[:, j]) for j in range(2)], 4, 42).toPandas()
    assert len(cells) == 72
    drawn = R._weights(pa.array(cells["w"]), 4).sum(axis=0)
    assert drawn.tolist() == [R.bootstrap(np.arange(30_000), 42, t).sum() for t in range(4)]
    args = (["a", "b"], ("f", "g"), (0, 1, 2), 4, 30, 42)
    want = {r: nodes(m) for r, m in R.fit_forests(df, *args).items()}
    monkeypatch.setattr(R, "MOST_NODES", max(len(n[0]) for n in want.values()))
    assert {r: nodes(m) for r, m in R.fit_forests(df, *args).items()} == want


@pytest.mark.parametrize("curved", [P.CURVED, 0])
def test_kernel_machine_of_little_penalty_reaches_its_gap(spark, monkeypatch, curved):
    """As little penalty a row as a table of many rows has; the steps are the usual ones."""
    monkeypatch.setattr(P, "CURVED", curved)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 3))
    label = np.where(x[:, 0] + 0.5 * np.sin(3 * x[:, 1]) > 0.3, "a", np.where(x[:, 2] > 0, "b", "c"))
    rows = [(i, *map(float, v), str(c)) for i, (v, c) in enumerate(zip(x, label))]
    df = spark.createDataFrame(rows, "id bigint, f double, g double, h double, label string")
    spec = LabelledSpec("id", ("f", "g", "h"), "label")
    run = M.fit_run(M.KERNEL_SVM, df, spec, Params(c=50.0))
    assert run.facts["gap"] <= Params.svm_gap
    assert M.score_model(run.model, df, spec).where("label = prediction").count() > 2800


def test_large_tables_are_fitted_on_a_sample_first(table, monkeypatch):
    """From there the steps over all rows are few, and the bounds over all rows are those of a cold start."""
    runs = (0, 2)
    df, points, _, _ = table
    maps, rows = P.standards(df, runs, 3)
    landmarks = {r: P.fit_landmarks(maps[r], points, 0.01) for r in runs}
    penalty = {r: 1.0 / rows[r] for r in runs}
    asked, summed = [], P.summed
    monkeypatch.setattr(P, "summed", lambda t, per_batch, size: asked.append(t) or summed(t, per_batch, size))
    found = []
    for most in (1 << 16, 100):
        monkeypatch.setattr(P, "WARM_ROWS", most, raising=False)
        margins = P.fit_margins(df, landmarks, rows, 3, 1.0, 200, 1e-3)
        scans = sum(t is df for t in asked)
        asked.clear()
        softmax = P.fit_softmax(df, maps, rows, 3, penalty, 500, 1e-5)
        found.append((scans, sum(t is df for t in asked), margins, softmax))
        asked.clear()
    cold, warm = found
    assert warm[0] < cold[0] and warm[1] < cold[1]
    for r in runs:
        assert warm[2][r].gap <= 1e-3 and warm[3][r].slope <= 1e-5
        assert warm[2][r].value == pytest.approx(cold[2][r].value, rel=3e-3)
        assert warm[3][r].value == pytest.approx(cold[3][r].value, rel=1e-3)


def test_margins_are_computed_once_for_all_steps(table):
    """The stored columns of each run are its features, and fits on them are the same."""
    df = table[0]
    maps, rows = P.standards(df, (0, 2), 3)
    held, columns = P.mapped(df, maps)
    assert held.count() == df.count() and held.columns == ["x", "y", "fold", "id"]
    before = {i: np.array(x) for i, x in df.select("id", "x").collect()}
    for row in held.collect():
        x = np.array([row.x])
        for r in maps:
            assert (columns[r](x) == maps[r](before[row.id][None])).all()
    penalty = {r: 0.01 for r in maps}
    one, two = (P.fit_softmax(t, m, rows, 3, penalty, 200, 1e-6) for t, m in ((df, maps), (held, columns)))
    assert all(np.allclose(one[r].weights, two[r].weights, atol=1e-9) for r in maps)


def test_stored_forest_scores_like_the_loaded_one_some_trees_at_a_time(table, monkeypatch):
    """No more nodes pass the driver at once than asked for, and the sums are the same to the last digit."""
    df, *_ = table
    forests = R.grow_forests(df, ["a", "b", "c"], ("f", "g", "h"), (0, 2), 7, 30, 42)
    spec = LabelledSpec("id", ("f", "g", "h"), "label")
    rows = scratch.store(df.select("id", *[F.col("x")[i].alias(c) for i, c in enumerate("fgh")], F.lit("a").alias("label"), "fold"), "asked")
    pick = lambda scored: sorted((r.id, r.label, r.prediction, tuple(r.probs), r.fold) for r in scored.collect())
    loaded, model = [], R._model
    monkeypatch.setattr(R, "_model", lambda nodes, *a: loaded.append(nodes.num_rows) or model(nodes, *a))
    for r, limit in ((2, 1 << 19), (2, 300), (0, 1)):
        monkeypatch.setattr(R, "SCORED_NODES", limit)
        forest = forests[r]
        for out_of_bag in (False, True):
            loaded.clear()
            found = forest.score(rows, spec, out_of_bag)
            assert sum(loaded) == sum(n for _, n in forest.sizes)
            assert max(loaded) <= max(limit, *(n for _, n in forest.sizes)) and len(loaded) == len(forest.pieces())
            assert pick(found) == pick(forest.load().score(rows, spec, out_of_bag))
    assert len(forests[0].pieces()) == 7
    assert forests[2].score(rows.where("id < 0"), spec).isEmpty()


def test_models_of_folds_stay_tables(clean):
    runs = M.fit_runs(M.RANDOM_FOREST, M.folds_of(clean, CLUSTERS, Params(folds=2)), CLUSTERS, Params(trees=3, folds=2))
    assert isinstance(runs[0].model, R.ForestModel)
    assert isinstance(runs[1].model, R.StoredForest) and isinstance(runs[2].model, R.StoredForest)
