"""Space partitioning for the neighbour join.

Samples of bounded size decide how space is cut into cells; Spark assigns the rows to cells and
shuffles cells against the queries that need them. Only these array helpers run inside the
tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SAMPLE_BYTES = 64 << 20
SAMPLE_PER_CELL = 32
FEW_DIMS = 8
LEADING = 16
PARTIAL = 16
# Points per query and neighbour within reach up to which the k-th of a block need not be looked for.
FEW_IN_REACH = 4


@dataclass(frozen=True)
class View:
    """The space that is cut: the columns, or in many dimensions their leading components.

    The axes are orthonormal, so no distance in the view is longer than the true one.
    """

    mean: np.ndarray | None = None
    axes: np.ndarray | None = None

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return x if self.axes is None else (x - self.mean) @ self.axes

    def slack(self, x: np.ndarray) -> np.ndarray:
        """What rounding may add to a distance in the view."""
        if self.axes is None:
            return np.zeros(len(x))
        return 1e-12 * (1.0 + np.abs(x).max(axis=1, initial=0.0) + np.abs(self.mean).max()) * x.shape[1]


def fit_view(sample: np.ndarray, leading: int = LEADING, rounds: int = 6) -> View:
    """Leading components of a sample by block power iteration; a few columns are taken as they are."""
    dims = sample.shape[1]
    if dims <= FEW_DIMS or not len(sample):
        return View()
    mean = sample.mean(axis=0)
    centred = sample - mean
    axes = np.linalg.qr(np.random.default_rng(0).normal(size=(dims, min(leading, dims))))[0]
    for _ in range(rounds):
        axes = np.linalg.qr(centred.T @ (centred @ axes))[0]
    return View(mean, axes)


@dataclass(frozen=True)
class Cells:
    """Binary cuts of space; node 0 is everything, a node without children is a cell."""

    axis: np.ndarray
    value: np.ndarray
    child: np.ndarray
    low: np.ndarray
    high: np.ndarray
    cell: np.ndarray

    @property
    def count(self) -> int:
        return int((self.axis < 0).sum())

    def locate(self, points: np.ndarray) -> np.ndarray:
        """Cell of each point."""
        node = np.zeros(len(points), dtype=np.int64)
        active = np.flatnonzero(self.axis[node] >= 0)
        while len(active):
            at = node[active]
            right = points[active, self.axis[at]] > self.value[at]
            node[active] = self.child[at, right.astype(np.int64)]
            active = active[self.axis[node[active]] >= 0]
        return self.cell[node]

    def within(self, points: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (point, cell) where the cell comes as close as ``reach`` to the point."""
        who = np.arange(len(points))
        node = np.zeros(len(points), dtype=np.int64)
        found_who, found_cell = [], []
        while len(who):
            p = points[who]
            gap = np.maximum(np.maximum(self.low[node] - p, p - self.high[node]), 0.0)
            near = np.sqrt((gap * gap).sum(axis=1)) <= reach[who]
            who, node = who[near], node[near]
            end = self.axis[node] < 0
            found_who.append(who[end])
            found_cell.append(self.cell[node[end]])
            who, node = who[~end], node[~end]
            who, node = np.repeat(who, 2), self.child[node].reshape(-1)
        if not found_who:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_who), np.concatenate(found_cell)


def build_cells(sample: np.ndarray, smallest: int) -> Cells:
    """Cut at the median of the widest axis until a cell holds few sample points.

    Each cell keeps at least ``smallest`` of them. They are rows of the table,
    so a search inside any one cell finds enough neighbours.
    """
    stop = max(2 * smallest, SAMPLE_PER_CELL)
    dims = sample.shape[1]
    axis, value, child = [-1], [0.0], [[-1, -1]]
    low, high = [np.full(dims, -np.inf)], [np.full(dims, np.inf)]
    todo = [(0, np.arange(len(sample)))]
    while todo:
        node, rows = todo.pop()
        if len(rows) < stop:
            continue
        x = sample[rows]
        for a in np.argsort(x.min(axis=0) - x.max(axis=0), kind="stable"):
            column = np.sort(x[:, a])
            if column[0] == column[-1]:
                break
            at = column[(len(column) - 1) // 2]
            if at == column[-1]:
                at = column[np.searchsorted(column, at) - 1]
            left = x[:, a] <= at
            if min(left.sum(), (~left).sum()) < smallest:
                continue
            axis[node], value[node] = int(a), float(at)
            child[node] = [len(axis), len(axis) + 1]
            for side, part in ((0, rows[left]), (1, rows[~left])):
                lo, hi = low[node].copy(), high[node].copy()
                (hi if side == 0 else lo)[a] = at
                low.append(lo)
                high.append(hi)
                axis.append(-1)
                value.append(0.0)
                child.append([-1, -1])
                todo.append((child[node][side], part))
            break
    axis = np.array(axis)
    cell = np.full(len(axis), -1)
    cell[axis < 0] = np.arange((axis < 0).sum())
    return Cells(axis, np.array(value), np.array(child), np.array(low), np.array(high), cell)


def _all_pairs(q: np.ndarray, p: np.ndarray, reach: np.ndarray, k: int, slack: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs that may be among the k nearest and their squared distances; for few dimensions."""
    square = np.zeros((len(q), len(p)))
    for j in range(p.shape[1]):
        gap = q[:, j, None] - p[None, :, j]
        square += gap * gap
    limit = _limits(square, reach, k, slack)
    row, col = np.nonzero(square <= limit[:, None])
    return row, col, square[row, col]


def _limits(square: np.ndarray, reach: np.ndarray, k: int, slack: float) -> np.ndarray:
    """Squared distance beyond which nothing is among a row's k nearest within its reach."""
    limit = reach
    if square.shape[1] > k:
        limit = np.minimum(limit, np.sqrt(np.partition(square, k - 1, axis=1)[:, k - 1]))
    return (limit + slack) ** 2


class _Screen:
    """Bounds of distances to the points of a block in many dimensions.

    First the leading components of the block: their distance, and that between the lengths of
    what they leave, bound the true one from below, which drops points that nobody reaches.
    Then products give all distances up to rounding. Only pairs that pass are computed column
    by column, and dropped once a partial sum is too long. Where the first bound keeps most points
    it is not asked again for that block, and where few pairs are within reach the k-th nearest
    of the block, which could only shorten the reach, is not looked for.
    """

    def __init__(self, p: np.ndarray):
        self.p = p
        self.view = fit_view(p)
        self.lead = self.view(p)
        self.rest = self._rest(p, self.lead)
        self.length = np.einsum("ij,ij->i", p, p)
        self.product = np.column_stack([p, np.ones(len(p)), self.length])
        self.drops = True

    def _rest(self, x: np.ndarray, lead: np.ndarray) -> np.ndarray:
        centred = x - self.view.mean
        return np.sqrt(np.maximum(np.einsum("ij,ij->i", centred, centred) - np.einsum("ij,ij->i", lead, lead), 0.0))

    def _reached(self, q: np.ndarray, reach: np.ndarray, slack: float) -> np.ndarray:
        lead = self.view(q)
        rest = self._rest(q, lead)
        a, b = np.column_stack([lead, rest]), np.column_stack([self.lead, self.rest])
        la, lb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
        square = la[:, None] + lb[None, :] - 2.0 * (a @ b.T)
        # The root in the rest doubles the relative error of the sums it comes from.
        doubt = 8.0 * np.sqrt(1e-15 * q.shape[1]) * (la.max(initial=0.0) + lb.max(initial=0.0))
        return np.flatnonzero((square - doubt <= ((reach + slack) ** 2)[:, None]).any(axis=0))

    def pairs(self, q: np.ndarray, reach: np.ndarray, k: int, slack: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, p, product = np.arange(len(self.p)), self.p, self.product
        bounded = not np.isinf(reach).any()
        if bounded and self.drops:
            at = self._reached(q, reach, slack)
            self.drops = 2 * len(at) <= len(p)
            p, product = p[at], product[at]
        own = np.einsum("ij,ij->i", q, q)
        # Lengths and products in one: |q|^2 + |p|^2 - 2 q p.
        about = np.column_stack([-2.0 * q, own, np.ones(len(q))]) @ product.T
        doubt = 1e-15 * (8 + q.shape[1]) * (own.max(initial=0.0) + self.length.max(initial=0.0))
        limit = (reach + slack) ** 2
        near = np.flatnonzero(about <= (limit + doubt)[:, None]) if bounded else None
        if near is None or len(near) > FEW_IN_REACH * k * len(q):
            limit = _limits(np.maximum(about, 0.0) + doubt, reach, k, slack)
            near = np.flatnonzero(about <= (limit + doubt)[:, None])
        row, col = np.divmod(near, max(1, len(p)))
        square = np.zeros(len(row))
        for start in range(0, q.shape[1], PARTIAL):
            for j in range(start, min(start + PARTIAL, q.shape[1])):
                gap = q[row, j] - p[col, j]
                square += gap * gap
            short = square <= limit[row]
            row, col, square = row[short], col[short], square[short]
        return row, at[col], square


def nearest_in_block(
    queries: np.ndarray,
    reach: np.ndarray,
    points: np.ndarray,
    ids: np.ndarray,
    k: int,
    scale: float,
    step: int = 256,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, distance) of the k nearest points per query within its reach.

    Points come sorted by id. Distances are rounded to ``1/scale`` before they are
    compared, and equal ones go to the smaller id.
    """
    screen = None if points.shape[1] <= FEW_DIMS else _Screen(points)
    slack = 2.0 / scale
    out = []
    for start in range(0, len(queries), step):
        q, far = queries[start : start + step], reach[start : start + step]
        if screen is None:
            row, col, square = _all_pairs(q, points, far, k, slack)
        else:
            row, col, square = screen.pairs(q, far, k, slack)
        dist = np.floor(np.sqrt(square) * scale + 0.5) / scale
        keep = dist <= far[row]
        row, col, dist = row[keep], col[keep], dist[keep]
        order = np.lexsort((ids[col], dist, row))
        row, col, dist = row[order], col[order], dist[order]
        first = np.searchsorted(row, np.arange(len(q)))
        keep = np.arange(len(row)) - first[row] < k
        out.append((row[keep] + start, col[keep], dist[keep]))
    return tuple(np.concatenate(part) for part in zip(*out))
