"""Random forests that do not depend on how a table is partitioned.

Every choice is a hash: the bootstrap weight of a row in a tree of (seed, tree, id), the columns
that a node may split on of (seed, tree, place of the node). Split points are quantiles of a
sample picked by id, and histograms are whole numbers, so sums come out the same in any order.

A tree sees nothing of a row but its bins and its class. Rows that agree on these, and on their
fold, are collapsed into one cell with the number of times that each tree drew them, so a table
costs one pass over its rows, and growing costs what its different cells cost.

All trees of all folds grow together. Nodes with many cells are split level by level: a scan
counts (node, column, bin, class) by task, the counts are added up, and each node's best split is
chosen in the task that holds its counts. A node with few cells is finished in one task, which
gathers them and grows the rest of the tree. What is gathered is bounded by ``LOCAL_ROWS`` cells
and ``LOCAL_BYTES`` whatever the table. The nodes of all forests are a table; the driver holds those
of a model that is loaded, or of some trees at a time where rows are scored without loading it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from labelwright.functions.labels import literal_array
from labelwright.sources.scratch import store, temporary
from labelwright.spec import LabelledSpec

BINS = 64
SAMPLE_ROWS = 100_000
LOCAL_ROWS = 1 << 17
LOCAL_BYTES = 32 << 20
DRAWN_ROWS = 1 << 17
KNOWN_CELLS = 1 << 16
CELLS = 1 << 23
MOST_NODES = 20_000_000
# Nodes that pass the driver at a time where rows are scored by a stored forest.
SCORED_NODES = 1 << 19
_GAIN = 1e-9
# Upper ends of the first values of a Poisson variable of mean 1.
_POISSON = np.cumsum(np.exp(-1.0) / np.array([1, 1, 2, 6, 24, 120, 720, 5040, 40320]))
_NODES = "run int, tree int, path bigint, feature int, bin int, gain double, counts array<double>"


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def _salt(seed: int, tree: int) -> np.uint64:
    return _mixed(np.array([seed * 1_000_003 + tree + 1], np.int64).view(np.uint64))[0]


def bootstrap(ids: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row is drawn into a tree."""
    u = (_mixed(_mixed(ids.view(np.uint64) + _salt(seed, tree)) ^ _salt(seed, tree)) >> np.uint64(11)) * 2.0**-53
    return np.searchsorted(_POISSON, u, "right")


def candidates(paths: np.ndarray, seed: int, tree: np.ndarray, dims: int) -> np.ndarray:
    """The columns that each node may split on, ascending: about the root of their number."""
    some = max(1, int(np.ceil(np.sqrt(dims))))
    salts = {t: _salt(seed, int(t)) for t in np.unique(tree)}
    base = _mixed(paths.view(np.uint64) ^ np.array([salts[t] for t in tree], np.uint64))
    each = _mixed(base[:, None] + np.arange(1, dims + 1, dtype=np.uint64)[None, :] * np.uint64(0x632BE59BD9B4E019))
    return np.sort(np.argsort(each, axis=1, kind="stable")[:, :some], axis=1)


def _edges(values: np.ndarray) -> np.ndarray:
    """Inner bin borders: between all values if they are few, else at quantiles."""
    own = np.unique(values)
    if len(own) <= BINS:
        return (own[1:] + own[:-1]) / 2
    return np.unique(np.quantile(values, np.arange(1, BINS) / BINS, method="lower"))


def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1).astype(np.uint8)


def _best(hist: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gain and bin of the best cut of each node from (node, bin, class) counts."""
    left = hist.cumsum(axis=1)
    total = left[:, -1:, :]
    right = total - left
    n_left, n_right = left.sum(axis=2), right.sum(axis=2)
    with np.errstate(divide="ignore", invalid="ignore"):
        score = (left * left).sum(axis=2) / n_left + (right * right).sum(axis=2) / n_right
    whole = (total[:, 0] ** 2).sum(axis=1) / np.maximum(n_left[:, -1], 1)
    score = np.where((n_left > 0) & (n_right > 0), score, -1.0)
    at = score.argmax(axis=1)
    return score[np.arange(len(at)), at] - whole, at


def _split(at, bins, y, w, chosen, n_bins: int, classes: int):
    """Best (gain, column, bin) and class counts of nodes 0.. from their rows, some nodes at a time."""
    nodes = len(chosen)
    gain, feature, cut = np.full(nodes, -1.0), np.full(nodes, -1), np.zeros(nodes, np.int64)
    counts = np.bincount(at * classes + y, weights=w, minlength=nodes * classes).reshape(nodes, classes)
    some = max(1, CELLS // (n_bins * classes))
    order = np.argsort(at, kind="stable") if nodes > some else None
    bounds = np.searchsorted(at[order], np.arange(0, nodes + some, some)) if order is not None else None
    for i, first in enumerate(range(0, nodes, some)):
        rows = slice(None) if order is None else order[bounds[i] : bounds[i + 1]]
        size = min(some, nodes - first)
        here, cls, weight = at[rows] - first, y[rows], w[rows]
        for j in range(chosen.shape[1]):
            column = chosen[first : first + size, j]
            b = bins[rows][np.arange(len(here)), column[here]].astype(np.int64)
            hist = np.bincount((here * n_bins + b) * classes + cls, weights=weight, minlength=size * n_bins * classes)
            own, place = _best(hist.reshape(size, n_bins, classes))
            better = own > gain[first : first + size] + _GAIN
            part = slice(first, first + size)
            gain[part] = np.where(better, own, gain[part])
            feature[part] = np.where(better, column, feature[part])
            cut[part] = np.where(better, place, cut[part])
    return gain, feature, cut, counts


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, path: int, seed: int, tree: int, n_bins: int, classes: int, max_depth: int):
    """Nodes (path, column or -1, bin, gain, counts) of the subtree below a path, level by level."""
    paths = np.array([path], np.int64)
    at = np.zeros(len(y), np.int64)
    out = []
    while len(paths):
        depth = int(paths[0]).bit_length() - 1
        chosen = candidates(paths, seed, np.full(len(paths), tree), bins.shape[1])
        gain, feature, cut, counts = _split(at, bins, y, w, chosen, n_bins, classes)
        inner = (gain > _GAIN * counts.sum(axis=1)) & (depth < max_depth)
        out.append((paths, np.where(inner, feature, -1), np.where(inner, cut, 0), np.where(inner, gain, 0.0), counts))
        go = inner[at]
        at, bins, y, w = at[go], bins[go], y[go], w[go]
        right = bins[np.arange(len(at)), feature[at]] > cut[at]
        number = np.cumsum(inner) - 1
        at = 2 * number[at] + right
        paths = np.repeat(2 * paths[inner], 2) + np.tile([0, 1], int(inner.sum()))
    return [np.concatenate(part) for part in zip(*out)]


def _packed(*parts: np.ndarray) -> np.ndarray:
    """Rows of several arrays as one byte string each."""
    whole = np.concatenate([np.ascontiguousarray(p).view(np.uint8).reshape(len(p), -1) for p in parts], axis=1)
    return np.ascontiguousarray(whole).view(np.dtype((np.void, whole.shape[1]))).ravel()


def _binary(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """An array cut at the given places as byte strings."""
    offsets = np.concatenate([[0], ends]) * flat.itemsize
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat))])


def _joined(column) -> bytes:
    return b"".join(column.to_pylist())


def _weights(column, trees: int) -> np.ndarray:
    """(cell, tree) counts, which are written as narrow as each batch allows."""
    blobs = column.to_pylist()
    sizes = np.array([len(b) for b in blobs], np.int64) // trees
    out = np.zeros((len(blobs), trees), np.int64)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        out[at] = np.frombuffer(b"".join(blobs[i] for i in at), f"<u{size}").reshape(len(at), trees)
    return out


_CELLS = "b binary, y int, fold int, w binary"


def _cell_batch(bins: np.ndarray, y: np.ndarray, fold: np.ndarray, w: np.ndarray) -> pa.RecordBatch:
    n, most = len(y), w.max(initial=0)
    narrow = w.astype(next(t for t in ("<u1", "<u2", "<u4", "<u8") if most <= np.iinfo(t).max))
    each = np.arange(1, n + 1)
    return pa.RecordBatch.from_arrays(
        [_binary(bins.ravel(), each * bins.shape[1]), pa.array(y.astype(np.int32)), pa.array(fold.astype(np.int32)), _binary(narrow.ravel(), each * w.shape[1])],
        ["b", "y", "fold", "w"],
    )


def _cells(table: DataFrame, edges: list[np.ndarray], trees: int, seed: int) -> DataFrame:
    """(b, y, fold, w): the rows of equal bins, class and fold as one, with how often each tree drew them.

    Tasks collapse their own rows first, so a cell that holds most of the table is no larger than
    any other; cells of equal bins and class lie next to each other.
    """
    dims = len(edges)

    def drawn(x, y, fold, ids) -> pa.RecordBatch:
        bins = _binned(x, edges)
        _, first, cell = np.unique(_packed(bins, y.astype(np.int32), fold.astype(np.int32)), return_index=True, return_inverse=True)
        w = np.stack([np.bincount(cell, bootstrap(ids, seed, t), len(first)).astype(np.int64) for t in range(trees)], axis=1)
        return _cell_batch(bins[first], y[first], fold[first], w)

    def draw(batches):
        held, rows = [], 0
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            held.append((x, *(batch.column(c).to_numpy() for c in ("y", "fold")), batch.column("id").to_numpy().astype(np.int64)))
            rows += len(batch)
            if rows >= DRAWN_ROWS:
                yield drawn(*(np.concatenate(part) for part in zip(*held)))
                held, rows = [], 0
        if rows:
            yield drawn(*(np.concatenate(part) for part in zip(*held)))

    def merge(batches):
        """Add up neighbours with one key; the last cell of a batch may go on in the next."""
        carried = None
        for batch in batches:
            if not batch.num_rows:
                continue
            bins = np.frombuffer(_joined(batch.column("b")), np.uint8).reshape(-1, dims)
            own = (bins, batch.column("y").to_numpy(), batch.column("fold").to_numpy(), _weights(batch.column("w"), trees))
            bins, y, fold, w = own if carried is None else (np.concatenate(part) for part in zip(carried, own))
            new = (bins[1:] != bins[:-1]).any(axis=1) | (y[1:] != y[:-1]) | (fold[1:] != fold[:-1])
            starts = np.concatenate([[0], np.flatnonzero(new) + 1])
            bins, y, fold, w = bins[starts], y[starts], fold[starts], np.add.reduceat(w, starts, axis=0)
            carried = tuple(part[-1:] for part in (bins, y, fold, w))
            if len(y) > 1:
                yield _cell_batch(bins[:-1], y[:-1], fold[:-1], w[:-1])
        if carried is not None:
            yield _cell_batch(*carried)

    parts = table.select("x", "y", "fold", "id").mapInArrow(draw, _CELLS)
    return store(parts.repartition("b", "y").sortWithinPartitions("b", "y", "fold").mapInArrow(merge, _CELLS), "cells")


def row_key(df: DataFrame, spec: LabelledSpec):
    """The id as a whole number; other ids by their hash."""
    whole = isinstance(df.schema[spec.id_col].dataType, T.IntegralType)
    return F.col(spec.id_col).cast("bigint") if whole else F.xxhash64(spec.id_col)


@dataclass(frozen=True)
class _Upper:
    """The split nodes of one tree so far, by path."""

    paths: np.ndarray
    feature: np.ndarray
    cut: np.ndarray

    def descend(self, bins: np.ndarray) -> np.ndarray:
        node = np.ones(len(bins), np.int64)
        if not len(self.paths):
            return node
        rows = np.arange(len(bins))
        while len(rows):
            i = np.minimum(np.searchsorted(self.paths, node[rows]), len(self.paths) - 1)
            inner = self.paths[i] == node[rows]
            rows, i = rows[inner], i[inner]
            node[rows] = 2 * node[rows] + (bins[rows, self.feature[i]] > self.cut[i])
        return node


@dataclass(frozen=True)
class _Walk:
    """What scoring needs of a forest: splits of the nodes of all trees and class shares of the leaves.

    ``next`` is the left child of a split node and the place of a leaf's shares.
    """

    edges: tuple[np.ndarray, ...]
    tree: np.ndarray
    root: np.ndarray
    next: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    shares: np.ndarray
    seed: int

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """(row, tree): the leaf that each row ends in."""
        out = np.zeros((len(bins), len(self.root)), np.int32)
        for t, root in enumerate(self.root):
            node = np.full(len(bins), root, np.int32)
            rows = np.flatnonzero(self.feature[node] >= 0)
            while len(rows):
                i = node[rows]
                node[rows] = self.next[i] + (bins[rows, self.feature[i]] > self.cut[i])
                rows = rows[self.feature[node[rows]] >= 0]
            out[:, t] = self.next[node]
        return out

    def probabilities(self, x: np.ndarray, ids: np.ndarray | None, known: dict[bytes, np.ndarray]) -> np.ndarray:
        total, used = np.zeros((len(x), self.shares.shape[1])), np.zeros(len(x))
        self.add(x, ids, known, total, used)
        return mean_share(total, used)

    def add(self, x: np.ndarray, ids: np.ndarray | None, known: dict[bytes, np.ndarray], total: np.ndarray, used: np.ndarray) -> None:
        """Add the class shares of each row's leaves, tree by tree, and the number of trees that judge it.

        Rows of equal bins end in the same leaves; ``known`` keeps those of a bounded number of cells.
        """
        bins = _binned(x, list(self.edges))
        cells, first, inverse = np.unique(_packed(bins), return_index=True, return_inverse=True)
        if len(known) > KNOWN_CELLS:
            known.clear()
        keys = [c.tobytes() for c in cells]
        new = [i for i, key in enumerate(keys) if key not in known]
        if new:
            known.update(zip([keys[i] for i in new], self.leaves(bins[first[new]])))
        leaf = np.stack([known[key] for key in keys])
        for t, tree in enumerate(self.tree):
            share = self.shares[leaf[:, t]][inverse]
            if ids is None:
                total += share
                used += 1
            else:
                counts = bootstrap(ids, self.seed, int(tree)) == 0
                total += share * counts[:, None]
                used += counts


def mean_share(total: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Probabilities from sums over the trees; equal ones where no tree judges a row."""
    return np.where(used[:, None] > 0, total / np.maximum(used, 1)[:, None], 1.0 / total.shape[1])


def _asked(df: DataFrame, spec: LabelledSpec) -> tuple[DataFrame, list[str]]:
    """(_x, _row, _id) of the rows to score, and the further columns that are kept."""
    keep = [c for c in df.columns if c not in (spec.id_col, spec.label_col, *spec.feature_cols)]
    row = F.struct(F.col(spec.id_col).alias("id"), F.col(spec.label_col).cast("string").alias("label"), *[F.col(f"`{c}`") for c in keep])
    x = F.array(*[F.col(c).cast("double") for c in spec.feature_cols])
    return df.select(x.alias("_x"), row.alias("_row"), row_key(df, spec).alias("_id")), keep


def _lists(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), pa.array(values.ravel()))


def _judged(found: DataFrame, labels: tuple[str, ...], keep: list[str]) -> DataFrame:
    prediction = F.element_at(literal_array(list(labels)), F.col("_best") + 1)
    return found.select("_row.id", "_row.label", prediction.alias("prediction"), "probs", *[F.col(f"_row.`{c}`") for c in keep])


@dataclass(frozen=True)
class ForestModel:
    """Trees of one forest as arrays over all nodes, sorted by (tree, path)."""

    labels: tuple[str, ...]
    features: tuple[str, ...]
    edges: tuple[np.ndarray, ...]
    tree: np.ndarray
    path: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    gain: np.ndarray
    counts: np.ndarray
    seed: int

    def walk(self) -> _Walk:
        starts = np.append(np.flatnonzero(np.append(True, self.tree[1:] != self.tree[:-1])), len(self.tree))
        ends = self.feature < 0
        after = (np.cumsum(ends) - 1).astype(np.int32)
        for low, high in zip(starts[:-1], starts[1:]):
            inner = low + np.flatnonzero(~ends[low:high])
            after[inner] = low + np.searchsorted(self.path[low:high], 2 * self.path[inner])
        shares = self.counts[ends] / self.counts[ends].sum(axis=1, keepdims=True)
        return _Walk(self.edges, self.tree[starts[:-1]], starts[:-1], after, self.feature.astype(np.int32), self.cut.astype(np.uint8), shares, self.seed)

    def probabilities(self, x: np.ndarray, ids: np.ndarray | None = None) -> np.ndarray:
        """Mean over the trees of the class shares of each row's leaf.

        With ids, only trees that did not draw the row count; a row that all trees drew has
        equal shares.
        """
        return self.walk().probabilities(x, ids, {})

    def score(self, df: DataFrame, spec: LabelledSpec, out_of_bag: bool = False) -> DataFrame:
        """(id, label, prediction, probs, …) like the other models; ties go to the first label.

        ``out_of_bag`` is for rows that the forest was trained on: each is judged by the trees
        that did not draw it, so no row vouches for its own label.
        """
        shared, classes = df.sparkSession.sparkContext.broadcast(self.walk()), len(self.labels)
        source, keep = _asked(df, spec)

        def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known: dict[bytes, np.ndarray] = {}
            for batch in batches:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
                ids = batch.column(2).to_numpy() if out_of_bag else None
                p = shared.value.probabilities(x, ids, known) if len(x) else np.zeros((0, classes))
                yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(p.argmax(axis=1).astype(np.int32)), _lists(p)], ["_row", "_best", "probs"])

        kind = source.schema["_row"].dataType.simpleString()
        return _judged(source.mapInArrow(scored, f"_row {kind}, _best int, probs array<double>"), self.labels, keep)

    def importances(self) -> np.ndarray:
        """Share of the gain of each column, per tree and then over the trees."""
        out = np.zeros(len(self.features))
        for t in np.unique(self.tree):
            inner = (self.tree == t) & (self.feature >= 0)
            own = np.bincount(self.feature[inner], self.gain[inner], len(self.features))
            out += own / own.sum() if own.sum() > 0 else 0.0
        return out / out.sum() if out.sum() > 0 else out

    def save(self, spark: SparkSession, path: str) -> None:
        nodes = pa.table(
            {
                "tree": self.tree.astype(np.int32),
                "path": self.path,
                "feature": self.feature.astype(np.int32),
                "cut": self.cut.astype(np.int32),
                "gain": self.gain,
                "counts": list(self.counts),
            }
        )
        spark.createDataFrame(nodes).write.mode("overwrite").parquet(f"{path}/nodes")
        about = json.dumps({"labels": self.labels, "features": self.features, "edges": [e.tolist() for e in self.edges], "seed": self.seed})
        spark.createDataFrame([(about,)], "value string").write.mode("overwrite").text(f"{path}/forest")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ForestModel:
        about = json.loads(spark.read.text(f"{path}/forest").first()[0])
        rows = spark.read.parquet(f"{path}/nodes").toArrow()
        return _model(rows, tuple(about["labels"]), tuple(about["features"]), tuple(np.array(e, float) for e in about["edges"]), about["seed"])


def _model(rows: pa.Table, labels, features, edges, seed: int) -> ForestModel:
    tree, path = rows.column("tree").to_numpy(), rows.column("path").to_numpy()
    order = np.lexsort((path, tree))
    counts = rows.column("counts").combine_chunks().flatten().to_numpy().reshape(len(tree), -1)
    pick = lambda c: rows.column(c).to_numpy()[order]
    return ForestModel(labels, features, edges, tree[order], path[order], pick("feature"), pick("cut"), pick("gain"), counts[order], seed)


@dataclass(frozen=True)
class StoredForest:
    """A forest whose nodes (tree, path, feature, cut, gain, counts) stay a table, with their number by tree."""

    labels: tuple[str, ...]
    features: tuple[str, ...]
    edges: tuple[np.ndarray, ...]
    nodes: DataFrame
    sizes: tuple[tuple[int, int], ...]
    seed: int

    def load(self) -> ForestModel:
        return _model(self.nodes.toArrow(), self.labels, self.features, self.edges, self.seed)

    def pieces(self) -> list[tuple[int, int]]:
        """First and last trees of pieces of at most SCORED_NODES nodes, or of one tree."""
        out, held = [], 0
        for tree, n in sorted(self.sizes):
            if out and held + n <= SCORED_NODES:
                out[-1], held = (out[-1][0], tree), held + n
            else:
                out.append((tree, tree))
                held = n
        return out

    def score(self, df: DataFrame, spec: LabelledSpec, out_of_bag: bool = False) -> DataFrame:
        """The scored table of ForestModel, written: trees are added to the rows' sums one piece after the other."""
        spark, classes = df.sparkSession, len(self.labels)
        source, keep = _asked(df, spec)
        kind = source.schema["_row"].dataType.simpleString()
        sums = "_x array<double>, _row {}, _id bigint, _total array<double>, _used double".format(kind)
        pieces = self.pieces()
        with temporary(spark) as kept:
            for i, (low, high) in enumerate(pieces):
                part = self.nodes.where(F.col("tree").between(low, high)).toArrow()
                shared = spark.sparkContext.broadcast(_model(part, self.labels, self.features, self.edges, self.seed).walk())
                del part
                ends = i == len(pieces) - 1
                step = self._step(shared, classes, out_of_bag, i == 0, ends)
                source = store(source.mapInArrow(step, f"_row {kind}, _best int, probs array<double>" if ends else sums), "sums")
                shared.destroy()
            kept.pop()
        return _judged(source, self.labels, keep)

    @staticmethod
    def _step(shared, classes: int, out_of_bag: bool, starts: bool, ends: bool) -> Callable:
        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known: dict[bytes, np.ndarray] = {}
            for batch in batches:
                n = len(batch)
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                ids = batch.column(2).to_numpy() if out_of_bag else None
                if starts or not n:
                    total, used = np.zeros((n, classes)), np.zeros(n)
                else:
                    total, used = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(n, -1).copy(), batch.column(4).to_numpy().copy()
                if n:
                    shared.value.add(x, ids, known, total, used)
                if ends:
                    p = mean_share(total, used)
                    yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(p.argmax(axis=1).astype(np.int32)), _lists(p)], ["_row", "_best", "probs"])
                else:
                    yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(3)), _lists(total), pa.array(used)], ["_x", "_row", "_id", "_total", "_used"])

        return step


def fit_forests(
    table: DataFrame, labels: list[str], features: tuple[str, ...], runs: tuple[int, ...], trees: int, max_depth: int, seed: int
) -> dict[int, ForestModel]:
    """The forests of ``grow_forests``, loaded."""
    return {r: forest.load() for r, forest in grow_forests(table, labels, features, runs, trees, max_depth, seed).items()}


def grow_forests(
    table: DataFrame, labels: list[str], features: tuple[str, ...], runs: tuple[int, ...], trees: int, max_depth: int, seed: int
) -> dict[int, StoredForest]:
    """A forest per run of a stored table (x, y, fold, id): run 0 takes all rows, run f those outside fold f.

    Ids must be unique whole numbers. ``max_depth`` is at most 60.
    """
    classes, dims = len(labels), len(features)
    share = min(1.0, SAMPLE_ROWS / max(1, table.count()))
    picked = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
    sample = table.where(picked).select("x").limit(2 * SAMPLE_ROWS).toArrow().column("x").combine_chunks()
    sample = sample.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    edges = [_edges(sample[:, j]) for j in range(dims)]
    source = _cells(table, edges, trees, seed)
    sizes = dict(source.groupBy("fold").count().collect())
    rows_of = {r: sum(n for f, n in sizes.items() if r == 0 or f != r) for r in runs}
    if not all(rows_of.values()):
        raise ValueError("every run needs training rows")
    most = min(LOCAL_ROWS, LOCAL_BYTES // dims)
    context = table.sparkSession.sparkContext
    upper = {(r, t): _Upper(*(np.zeros(0, np.int64) for _ in range(3))) for r in runs for t in range(trees)}
    big = {(r, t): [1] for r in runs for t in range(trees) if rows_of[r] > most}
    local = {(r, t): [1] for r in runs for t in range(trees) if rows_of[r] <= most}
    done: list[tuple] = []
    n_bins = max(len(e) for e in edges) + 1

    def rows_in(batch, places, upper):
        """(run, tree, bins, classes, weights and nodes) of a batch's cells that lie in the places asked for."""
        bins = np.frombuffer(_joined(batch.column("b")), np.uint8).reshape(-1, dims)
        y, fold, drawn = batch.column("y").to_numpy().astype(np.int64), batch.column("fold").to_numpy(), _weights(batch.column("w"), trees)
        # Cells that differ by their fold alone are one to a run.
        starts = np.concatenate([[0], np.flatnonzero((bins[1:] != bins[:-1]).any(axis=1) | (y[1:] != y[:-1])) + 1])
        bins, y = bins[starts], y[starts]
        weights = {r: np.add.reduceat(drawn * ((fold != r) | (r == 0))[:, None], starts, axis=0) for r in {r for r, _ in places}}
        for (r, t), wanted in places.items():
            node = upper[r, t].descend(bins)
            wanted = np.array(sorted(wanted), np.int64)
            i = np.minimum(np.searchsorted(wanted, node), len(wanted) - 1)
            inside = np.flatnonzero((wanted[i] == node) & (weights[r][:, t] > 0))
            yield r, t, bins[inside], y[inside], weights[r][inside, t], node[inside]

    while big:
        shared = context.broadcast((big, upper))

        def count(batches):
            places, uppers = shared.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                for r, t, bins, y, w, node in rows_in(batch, places, uppers):
                    paths, at = np.unique(node, return_inverse=True)
                    chosen = candidates(paths, seed, np.full(len(paths), t), dims)
                    for j in range(chosen.shape[1]):
                        f = chosen[at, j]
                        key = (at * n_bins + bins[np.arange(len(at)), f]) * classes + y
                        cells, inverse = np.unique(key, return_inverse=True)
                        which = cells // (n_bins * classes)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(cells), r, np.int32)),
                                pa.array(np.full(len(cells), t, np.int32)),
                                pa.array(paths[which]),
                                pa.array(chosen[which, j].astype(np.int32)),
                                pa.array((cells % (n_bins * classes)).astype(np.int32)),
                                pa.array(np.bincount(inverse, weights=w).astype(np.int64)),
                                pa.array(np.bincount(inverse).astype(np.int64)),
                            ],
                            ["run", "tree", "path", "f", "cell", "n", "held"],
                        )

        def choose(key, held):
            r, t, path = (k.as_py() for k in key)
            f, cell, n, m = (held.column(c).to_numpy() for c in ("f", "cell", "n", "held"))
            best = (-1.0, -1, 0, np.zeros(classes), np.zeros(2))
            for column in np.unique(f):
                hist = np.zeros(n_bins * classes)
                hist[cell[f == column]] = n[f == column]
                hist = hist.reshape(1, n_bins, classes)
                gain, at = _best(hist)
                if best[1] < 0 or gain[0] > best[0] + _GAIN:
                    own, here = m[f == column], cell[f == column] // classes <= at[0]
                    best = (float(gain[0]), int(column), int(at[0]), hist[0].sum(axis=0), np.array([own[here].sum(), own[~here].sum()], float))
            gain, column, at, counts, parts = best
            inner = gain > _GAIN * counts.sum() and int(path).bit_length() - 1 < max_depth
            return pa.table(
                {
                    "run": pa.array([r], pa.int32()),
                    "tree": pa.array([t], pa.int32()),
                    "path": pa.array([path], pa.int64()),
                    "feature": pa.array([column if inner else -1], pa.int32()),
                    "bin": pa.array([at if inner else 0], pa.int32()),
                    "gain": pa.array([gain if inner else 0.0]),
                    "counts": pa.array([counts.tolist()], pa.list_(pa.float64())),
                    "parts": pa.array([parts.tolist()], pa.list_(pa.float64())),
                }
            )

        sums = source.mapInArrow(count, "run int, tree int, path bigint, f int, cell int, n bigint, held bigint")
        sums = sums.groupBy("run", "tree", "path", "f", "cell").agg(F.sum("n").alias("n"), F.sum("held").alias("held"))
        found = sums.groupBy("run", "tree", "path").applyInArrow(choose, _NODES + ", parts array<double>").collect()
        big = {}
        for row in found:
            key = (row["run"], row["tree"])
            done.append(tuple(row)[:7])
            if row["feature"] >= 0:
                for side in (0, 1):
                    where = big if row["parts"][side] > most else local
                    where.setdefault(key, []).append(2 * row["path"] + side)
        inner: dict[tuple[int, int], list] = {}
        for d in done:
            if d[3] >= 0:
                inner.setdefault(d[:2], []).append((d[2], d[3], d[4]))
        for key, own in inner.items():
            own.sort()
            upper[key] = _Upper(*(np.array([o[i] for o in own], np.int64) for i in range(3)))
        shared.unpersist()
    shared = context.broadcast((local, upper))

    def gather(batches):
        places, uppers = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            for r, t, bins, y, w, node in rows_in(batch, places, uppers):
                order = np.argsort(node, kind="stable")
                paths, ends = np.unique(node, return_counts=True)
                ends = np.cumsum(ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(paths), r, np.int32)),
                        pa.array(np.full(len(paths), t, np.int32)),
                        pa.array(paths),
                        _binary(bins[order].ravel(), ends * dims),
                        _binary(y[order].astype("<i4"), ends),
                        _binary(w[order].astype("<i8"), ends),
                    ],
                    ["run", "tree", "path", "b", "y", "w"],
                )

    def finish(key, held):
        r, t, path = (k.as_py() for k in key)
        bins = np.frombuffer(_joined(held.column("b")), np.uint8).reshape(-1, dims)
        y, w = np.frombuffer(_joined(held.column("y")), "<i4").astype(np.int64), np.frombuffer(_joined(held.column("w")), "<i8").astype(float)
        paths, feature, cut, gain, counts = grow(bins, y, w, path, seed, t, n_bins, classes, max_depth)
        ends = pa.array(np.arange(len(paths) + 1, dtype=np.int32) * classes)
        return pa.table(
            {
                "run": pa.array(np.full(len(paths), r, np.int32)),
                "tree": pa.array(np.full(len(paths), t, np.int32)),
                "path": pa.array(paths),
                "feature": pa.array(feature.astype(np.int32)),
                "bin": pa.array(cut.astype(np.int32)),
                "gain": pa.array(gain),
                "counts": pa.ListArray.from_arrays(ends, pa.array(counts.ravel())),
            }
        )

    gathered = source.mapInArrow(gather, "run int, tree int, path bigint, b binary, y binary, w binary")
    grown = store(gathered.groupBy("run", "tree", "path").applyInArrow(finish, _NODES), "nodes", by="run")
    rest = table.sparkSession.createDataFrame(done, _NODES) if done else None
    whole = (grown if rest is None else grown.unionByName(rest)).withColumnRenamed("bin", "cut")
    sizes: dict[int, list[tuple[int, int]]] = {r: [] for r in runs}
    for r, t, n in whole.groupBy("run", "tree").count().collect():
        sizes[r].append((t, n))
    most_nodes = max(sum(n for _, n in own) for own in sizes.values())
    if most_nodes > MOST_NODES:
        raise ValueError(f"{most_nodes} nodes are more than a model of {MOST_NODES} may hold; lower the depth")
    return {
        r: StoredForest(tuple(labels), tuple(features), tuple(edges), whole.where(F.col("run") == r).drop("run"), tuple(sorted(sizes[r])), seed) for r in runs
    }
