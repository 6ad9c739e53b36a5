"""The network against a plain reading of one text at a time, its gradient, and held-out accuracy."""

import numpy as np
import pytest

from labelwright.llm import byte_network as B


def packed(raws):
    return np.frombuffer(b"".join(raws), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raws])]).astype(np.int64)


def plain(net, raw):
    """Half chunks, chunks and the document, one loop each."""
    w, halves = net.weights, []
    for start in range(0, max(len(raw), 1), B.HALF):
        read = (raw[start : start + B.HALF + B.WIDTH - B.STEP] + bytes(B.HALF + B.WIDTH))[: B.HALF + B.WIDTH - B.STEP]
        best = np.full(B.FILTERS, -np.inf)
        for at in range(0, B.HALF, B.STEP):
            x = np.concatenate([w["bytes"][b] for b in read[at : at + B.WIDTH]])
            best = np.maximum(best, x @ w["filters"] + w["filter_bias"])
        halves.append(np.maximum(best, 0))
    chunks = [np.maximum(a, b) for a, b in zip(halves, halves[1:])] or halves
    u = [np.maximum(c @ w["hidden"] + w["hidden_bias"], 0) for c in chunks]
    z = np.concatenate([np.max(u, axis=0), np.mean(u, axis=0)]) @ w["out"] + w["out_bias"][0]
    return 1 / (1 + np.exp(-z))


TEXTS = [b"", b"a", b"x" * 63, b"y" * 64, b"ab " * 22, "grüße €".encode() * 90, bytes(range(256)) * 3, b"long one. " * 900]


def test_score_equals_a_plain_reading(monkeypatch):
    net = B.Network.fresh(3)
    want = [plain(net, t) for t in TEXTS]
    for run in (1, 2, 7, 4096):
        monkeypatch.setattr(B, "RUN_HALVES", run)
        assert np.allclose(B.score(net, *packed(TEXTS)), want, atol=2e-6)


def test_gradient_equals_differences():
    net = B.Network.fresh(5)
    body, offsets = packed(TEXTS[1:7])
    target, weight = np.array([0, 1, 0, 1, 1, 0]), np.array([1.0, 2, 1, 1, 3, 1])
    _, grad = B._gradient(net, body, offsets, target, weight)
    rng = np.random.default_rng(0)
    for name, value in net.weights.items():
        flat_view, g = value.reshape(-1), grad[name].reshape(-1)
        for i in rng.choice(np.argsort(-abs(g))[:40], 4):
            kept, step = flat_view[i], np.float32(2e-3)
            flat_view[i] = kept + step
            up = B._gradient(net, body, offsets, target, weight)[0]
            flat_view[i] = kept - step
            down = B._gradient(net, body, offsets, target, weight)[0]
            flat_view[i] = kept
            assert g[i] == pytest.approx((up - down) / (2 * step), rel=0.2, abs=2e-3), name


@pytest.fixture(scope="module")
def scored(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, {r.doc_id: r for r in B.quality(docs, labels).collect()}


def test_held_out_accuracy(scored):
    docs, labels, got = scored
    assert len(got) == docs.count()
    tested = [(r.quality, got[r.doc_id]) for r in labels.collect() if got[r.doc_id].held_out]
    assert len(tested) > 20
    assert sum(y == g.predicted for y, g in tested) >= 0.93 * len(tested)
    assert all(0 <= g.score <= 1 and g.predicted == (g.score >= 0.5) for g in got.values())


def test_same_for_any_partitioning(scored):
    docs, labels, got = scored
    other = B.quality(docs.repartition(7), labels.repartition(3)).collect()
    assert all(abs(r.score - got[r.doc_id].score) < 1e-4 for r in other)


def test_held_out_labels_are_not_learned(scored, spark):
    """Turning every held-out label round changes nothing."""
    docs, labels, got = scored
    turned = labels.withColumn("quality", B.F.when(B.held_out(B.F.col("doc_id")), 1 - labels.quality).otherwise(labels.quality))
    assert all(abs(r.score - got[r.doc_id].score) < 1e-4 for r in B.quality(docs, turned).collect())


def test_defined_results(spark):
    rows = [(1, None, 0), (2, "", 0), (3, "fine words here", 1), (3, "fine words here", 1), (None, "x", 2), (5, "€" * 50_000, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(3, 1), (1, 0), (6, 0), (9, 1), (3, None), (None, 1), (5, 7)], "doc_id long, quality int")
    got = B.quality(docs, labels).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[1].score == by[2].score
    assert by[None].held_out is False
    assert len({r.score for r in got if r.doc_id == 3}) == 1
    assert {r.score for r in B.quality(docs, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in B.quality(docs, labels.where("quality = 1")).collect()} <= {0.5, 1.0}
    assert B.quality(docs.limit(0), labels).count() == 0
