from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelwright.operators import blocks, neighbours as N
from labelwright.operators.blocks import build_cells
from labelwright.operators.detect import (
    confirmed,
    detection_effectiveness,
    neighbour_suspects,
    suspicion_summary,
    with_truth,
)
from labelwright.operators.noise import fit_label_noise
from tests.conftest import CLUSTERS


def brute(ids, x, k, queries=None):
    """{id: [(distance, neighbour id)]} by comparing everything."""
    asked = list(zip(ids, x)) if queries is None else queries
    out = {}
    for i, v in asked:
        d = np.floor(np.sqrt(((x - v) ** 2).sum(axis=1)) * 1e9 + 0.5) / 1e9
        near = sorted((float(a), int(b)) for a, b in zip(d, ids) if queries is not None or b != i)
        out[int(i)] = near[:k]
    return out


def frame(spark, ids, x, labels=None):
    labels = labels if labels is not None else ["a" if i % 2 else "b" for i in ids]
    rows = [(int(i), [float(v) for v in p], str(label)) for i, p, label in zip(ids, x, labels)]
    return spark.createDataFrame(rows, "id bigint, x array<double>, label string")


def result(near):
    return {r.id: [(n.d, n.nid) for n in r.neighbours] for r in near.collect()}


@pytest.fixture
def tiny_cells(monkeypatch):
    monkeypatch.setattr(N, "PER_CELL", 32)
    monkeypatch.setattr(N, "PER_CELL_MANY_DIMS", 32)


@pytest.mark.parametrize("dims", [1, 2, 3, 12])
def test_equals_brute_force_over_many_cells(spark, tiny_cells, dims):
    rng = np.random.default_rng(dims)
    ids = rng.permutation(5000)[:900]
    x = np.round(rng.normal(size=(900, dims)), 2)
    index = N.build_index(frame(spark, ids, x), 4)
    assert index.cells is not None and index.cells.count > 4
    assert result(N.nearest_neighbours(frame(spark, ids, x), 4)) == brute(ids, x, 4)


def test_a_third_of_the_rows_share_one_point(spark, tiny_cells, monkeypatch):
    monkeypatch.setattr(N, "HOT_ROWS", 50)
    monkeypatch.setattr(N, "HOT_KEYS", 5)
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=(900, 2)), 3)
    x[::3] = (0.5, -0.0)
    x[1::9] = (0.5, 0.0)
    ids = np.arange(900) * 7
    index = N.build_index(frame(spark, ids, x), 5)
    assert index.points.count() < 600
    assert result(N.nearest_neighbours(frame(spark, ids, x + 0.0), 5)) == brute(ids, x, 5)


def test_ties_go_to_the_smaller_id(spark, tiny_cells):
    grid = np.array([(i, j) for i in range(20) for j in range(20)], dtype=float)
    ids = np.random.default_rng(1).permutation(400)
    assert result(N.nearest_neighbours(frame(spark, ids, grid), 6)) == brute(ids, grid, 6)


def widest(index):
    return index.points.groupBy("block").count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize("dims", [2, 12])
def test_crowded_cells_are_cut_by_samples_of_their_own(spark, monkeypatch, dims):
    """With a first sample of a few rows the deeper cuts keep the blocks as small as asked for."""
    monkeypatch.setattr(N, "SAMPLE_BYTES", 8 * dims * 100)
    monkeypatch.setattr(N, "LEVEL_SAMPLE", 64)
    rng = np.random.default_rng(5)
    ids, x = np.arange(3000), rng.normal(size=(3000, dims)) * np.linspace(3, 0.1, dims)
    index = N.build_index(frame(spark, ids, x), 3, per_cell=20)
    assert index.cells.count <= 6 and len(index.deeper) >= 2
    assert widest(index) <= N.CROWDED * 20
    assert result(N.nearest_neighbours(frame(spark, ids, x), 3, per_cell=20)) == brute(ids, x, 3)
    asked = [(i, v) for i, v in zip(range(5000, 5050), rng.normal(size=(50, dims)))]
    found = N.search_index(index, frame(spark, [i for i, _ in asked], [v for _, v in asked]))
    assert result(found) == brute(ids, x, 3, asked)


def test_without_a_first_cut(spark, monkeypatch):
    monkeypatch.setattr(N, "PER_CELL", 20)
    monkeypatch.setattr(N, "SAMPLE_BYTES", 8)
    rng = np.random.default_rng(5)
    ids, x = np.arange(500), rng.normal(size=(500, 2))
    index = N.build_index(frame(spark, ids, x), 3)
    assert index.cells is None and widest(index) <= N.CROWDED * 20
    assert result(N.nearest_neighbours(frame(spark, ids, x), 3)) == brute(ids, x, 3)


def test_points_that_the_view_cannot_tell_apart(spark, monkeypatch):
    """One column takes all axes of the view; the rest differ outside it, and are dealt out by a hash."""
    from labelwright.operators import blocks

    monkeypatch.setattr(N, "fit_view", lambda x: blocks.View(np.zeros(10), np.eye(10)[:, :1]))
    rng = np.random.default_rng(2)
    x = np.zeros((400, 10))
    x[:, 0] = np.repeat([0.0, 1000.0], 200)
    x[:, 3] = np.round(rng.normal(size=400), 3)
    ids = np.arange(400)
    index = N.build_index(frame(spark, ids, x), 3, per_cell=10)
    assert index.deeper and widest(index) <= N.CROWDED * 10
    assert result(N.nearest_neighbours(frame(spark, ids, x), 3, per_cell=10)) == brute(ids, x, 3)


def test_groups_of_bounded_size_meet_their_cut(spark, monkeypatch):
    monkeypatch.setattr(N, "GROUP_ROWS", 7)
    monkeypatch.setattr(N, "SAMPLE_BYTES", 8)
    rng = np.random.default_rng(8)
    ids, x = np.arange(300), np.round(rng.normal(size=(300, 3)), 1)
    assert result(N.nearest_neighbours(frame(spark, ids, x), 4, per_cell=10)) == brute(ids, x, 4)


def test_blocks_with_fewer_points_than_neighbours(spark, monkeypatch):
    monkeypatch.setattr(N, "PER_CELL", 3)
    monkeypatch.setattr(N, "SAMPLE_BYTES", 8)
    rng = np.random.default_rng(15)
    ids, x = np.arange(60), rng.normal(size=(60, 2))
    index = N.build_index(frame(spark, ids, x), 25)
    assert index.blocks > 2 and widest(index) < 25
    assert result(N.nearest_neighbours(frame(spark, ids, x), 25)) == brute(ids, x, 25)


def test_screen_bounds_hold_far_from_the_origin():
    """The screen drops nothing that is near, with ties, copies and a large common offset."""
    from labelwright.operators.blocks import nearest_in_block

    rng = np.random.default_rng(3)
    points = np.round(rng.normal(size=(700, 24)), 1) + 1e4
    points[100:150] = points[0]
    queries = np.concatenate([points[:20], points[200:220] + 0.05])
    ids = np.arange(700)
    d = np.floor(np.sqrt(((queries[:, None] - points[None]) ** 2).sum(axis=2)) * 1e9 + 0.5) / 1e9
    for reach in (np.full(40, np.inf), np.sort(d, axis=1)[:, 7].copy(), np.full(40, 0.2)):
        row, col, dist = nearest_in_block(queries, reach, points, ids, 9, 1e9)
        got = {i: [] for i in range(40)}
        for r, c, v in zip(row, col, dist):
            got[r].append((v, c))
        for i in range(40):
            want = sorted((v, c) for c, v in enumerate(d[i]) if v <= reach[i])[:9]
            assert [c for _, c in got[i]] == [c for _, c in want]


def test_many_queries_of_one_block_are_dealt_out(spark, tiny_cells, monkeypatch):
    monkeypatch.setattr(N, "MOST_QUERIES", 10)
    monkeypatch.setattr(N, "FEWEST_QUERIES", 10)
    rng = np.random.default_rng(6)
    ids, x = np.arange(400), rng.normal(size=(400, 3))
    assert result(N.nearest_neighbours(frame(spark, ids, x), 3)) == brute(ids, x, 3)


def test_other_rows_are_searched_in_the_table(spark, tiny_cells):
    rng = np.random.default_rng(7)
    ids, x = np.arange(300), np.round(rng.normal(size=(300, 2)), 1)
    asked = [(i, v) for i, v in zip(range(1000, 1060), np.round(rng.normal(size=(60, 2)), 1) * 3)]
    queries = frame(spark, [i for i, _ in asked], [v for _, v in asked])
    found = N.nearest_neighbours(frame(spark, ids, x), 5, queries=queries)
    assert result(found) == brute(ids, x, 5, asked)


def test_partitioning_does_not_matter(spark, tiny_cells):
    rng = np.random.default_rng(8)
    ids, x = np.arange(300), rng.normal(size=(300, 2))
    df = frame(spark, ids, x)
    assert result(N.nearest_neighbours(df, 5)) == result(N.nearest_neighbours(df.repartition(13), 5))


def test_cells_cover_the_points_they_hold():
    rng = np.random.default_rng(9)
    x = rng.integers(0, 6, size=(2000, 3)).astype(float)
    cells = build_cells(x, 4)
    at = cells.locate(x)
    assert np.bincount(at, minlength=cells.count).min() >= 4
    who, cell = cells.within(x[:50], np.zeros(50))
    assert {(i, at[i]) for i in range(50)} <= set(zip(who.tolist(), cell.tolist()))


def test_too_few_rows_and_bad_vectors(spark):
    with pytest.raises(ValueError):
        N.nearest_neighbours(frame(spark, range(5), np.zeros((5, 2))), 5)
    ragged = spark.createDataFrame(
        [(1, [1.0], "a"), (2, [1.0, 2.0], "a"), (3, [0.0], "b")], "id bigint, x array<double>, label string"
    )
    with pytest.raises(ValueError, match="finite"):
        N.nearest_neighbours(ragged, 1)
    endless = frame(spark, range(3), [[0.0], [1.0], [float("inf")]])
    with pytest.raises(ValueError, match="finite"):
        N.nearest_neighbours(endless, 1)
    index = N.build_index(frame(spark, range(9), np.arange(9.0).reshape(9, 1)), 2)
    with pytest.raises(ValueError, match="finite"):
        N.search_index(index, ragged)


def test_no_queries_give_no_rows(spark, tiny_cells):
    rng = np.random.default_rng(3)
    df = frame(spark, range(200), rng.normal(size=(200, 2)))
    assert N.search_index(N.build_index(df, 3), df.where("id < 0")).isEmpty()


def test_null_feature_is_an_error_and_null_label_is_left_out(spark, clean):
    holes = clean.withColumn("target", F.expr("if(id < 10, null, target)"))
    assert N.nearest_neighbours(N.feature_vectors(holes, CLUSTERS)).count() == 140
    with pytest.raises(ValueError, match="feature1"):
        N.feature_vectors(clean.withColumn("feature1", F.expr("if(id = 3, null, feature1)")), CLUSTERS)


def suspects(df, k=5, threshold=0.5):
    return neighbour_suspects(N.nearest_neighbours(N.feature_vectors(df, CLUSTERS), k), k, threshold)


def test_separated_clusters_have_hardly_a_suspect(clean):
    row = suspicion_summary(suspects(clean)).first()
    assert row.total_rows == 150 and row.suspicious_rows <= 2 and row.suspicion_rate <= 0.05


def test_known_flips_are_found(spark, flipped):
    flags = suspects(flipped)
    ledger = flipped.select("id", F.expr("id between 5 and 9 or id between 55 and 59").alias("flipped"))
    assert flags.where("suspicious").count() >= 5
    assert confirmed(flags, ledger).count() >= 3
    row = detection_effectiveness(with_truth(flags, ledger)).first()
    assert row.tp + row.fn == 10 and row.tp + row.fp + row.fn + row.tn == 150


def test_lower_threshold_finds_at_least_as_many(flipped):
    low, high = (suspects(flipped, 5, t).where("suspicious").count() for t in (0.3, 0.7))
    assert low >= high


def test_threshold_is_inclusive(flipped):
    flags = suspects(flipped, 5, 0.6)
    assert flags.where("disagreements = 3 and not suspicious").isEmpty()


def test_most_injected_noise_is_recovered(spark, sf_dir):
    from labelwright.plans import QUERIES

    by_level = {r.noise_level: r for r in QUERIES["detection_effectiveness"](spark, sf_dir).collect()}
    assert by_level[0.05].recall > 0.95 and by_level[0.1].precision > 0.85
    assert by_level[0.0].recall is None and by_level[0.5].recall > 0.8


def test_relabelled_lists_equal_a_search_on_the_noisy_table(clean):
    from labelwright.operators.detect import relabel

    noise = fit_label_noise(clean, CLUSTERS, (0.2,))
    once = neighbour_suspects(relabel(N.nearest_neighbours(N.feature_vectors(clean, CLUSTERS)), noise))
    again = suspects(noise.flip(clean, 0.2))
    pick = lambda df: {(r.id, r.label, r.disagreements, r.suspicious) for r in df.collect()}
    assert pick(once) == pick(again)


def test_pairs_of_queries_and_cells_leave_a_task_in_bounded_pieces(spark, monkeypatch):
    """Points far from each other reach every cell; what a task holds of their pairs is bounded."""
    x = np.random.default_rng(4).normal(size=(600, 12))
    df = frame(spark, np.arange(600), x)
    index = N.build_index(df, 5, per_cell=4)
    assert index.cells.count > 10
    asked = df.selectExpr("id AS qid", "x", "CAST('inf' AS double) AS reach", "CAST(-1 AS bigint) AS block").repartition(1)
    monkeypatch.setattr(N, "PAIR_BYTES", 8 * 17 * 100)
    sizes = []
    near = N._near_cells
    monkeypatch.setattr(N.Cells, "within", lambda self, p, r, _own=N.Cells.within: (sizes.append(len(p)), _own(self, p, r))[1])
    who, cell = near(index.view, index.cells, x, np.full(600, np.inf))
    assert len(who) == 600 * index.cells.count and max(sizes) == 1
    assert N._abroad(replace(index, deeper=[]), asked).count() == 600 * index.cells.count
    assert result(N.nearest_neighbours(df, 5, per_cell=4)) == brute(np.arange(600), x, 5)


@pytest.mark.parametrize("reach", [9.0, 30.0, np.inf])
def test_reach_alone_decides_where_few_points_are_within_it(monkeypatch, reach):
    """The k nearest within reach, by all pairs; the k-th of the block is looked for only where many are."""
    rng = np.random.default_rng(8)
    p, q = np.round(rng.normal(size=(500, 64)), 1), np.round(rng.normal(size=(300, 64)), 1)
    p[100:110] = p[0]
    asked, limits = [], blocks._limits
    monkeypatch.setattr(blocks, "_limits", lambda *a: asked.append(1) or limits(*a))
    row, col, dist = blocks.nearest_in_block(q, np.full(300, reach), p, np.arange(500), 5, 1e9)
    far = np.round(np.sqrt(((q[:, None] - p[None]) ** 2).sum(axis=2)), 9)
    want = [(i, j) for i in range(300) for j in sorted(range(500), key=lambda j: (far[i, j], j))[:5] if far[i, j] <= reach]
    assert list(zip(row.tolist(), col.tolist())) == want
    assert dist.tolist() == pytest.approx([far[i, j] for i, j in want], abs=1e-9)
    assert bool(asked) == (reach > 9.0) and 300 < len(want) <= 1500


@pytest.mark.parametrize("dims,most,sample", [(12, 100, 1 << 20), (2, 100, 1 << 20), (12, 100, 8)])
def test_small_blocks_are_visited_in_bundles(spark, monkeypatch, dims, most, sample):
    """The pairs that are written grow with the bundles, not with the blocks; the lists are those of all pairs."""
    monkeypatch.setattr(N, "BUNDLE_ROWS", most)
    monkeypatch.setattr(N, "SAMPLE_BYTES", sample)
    rng = np.random.default_rng(6)
    ids, x = np.arange(600), np.concatenate([rng.normal(size=(400, dims)), rng.normal(size=(200, dims)) * 0.1 + 30])
    df = frame(spark, ids, x)
    pairs, abroad = [], N._abroad
    monkeypatch.setattr(N, "_abroad", lambda *a: pairs.append(N.store(abroad(*a), "pairs")) or pairs[-1])
    assert result(N.nearest_neighbours(df, 5, per_cell=4)) == brute(ids, x, 5)
    index = N.build_index(df, 5, per_cell=4)
    assert index.blocks > 40 and int(index.bundles.parts.sum()) < 20
    assert pairs[0].count() < 600 * 20
    held = N._in_bundles(index.points.select("id", "x", "li", "block"), index, "id").groupBy("block").count()
    assert held.agg(F.sum("count")).first()[0] == 600 and held.agg(F.max("count")).first()[0] <= 2 * most


def test_blocks_that_no_query_reaches_are_left_out():
    rng = np.random.default_rng(7)
    p, block = np.concatenate([rng.normal(size=(50, 3)) + 10 * i for i in range(4)]), np.repeat([7, 3, 9, 1], 50)
    view = blocks.View()
    assert N._reached(view, p[:5], np.full(5, 1.0), p, block).tolist() == list(range(50))
    assert N._reached(view, p[[0, 120]], np.array([1.0, 1.0]), p, block).tolist() == [*range(50), *range(100, 150)]
    assert len(N._reached(view, p[:2], np.array([1.0, np.inf]), p, block)) == 200
