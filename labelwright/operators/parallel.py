"""Penalised linear fits of many problems at once: one scan of the table per step.

A run is a set of training rows: run 0 takes all of them, run f those outside fold f. Each run
has its own features, fitted without its held-out rows. A scan adds up the losses and gradients
of all problems of all runs; tasks add up their own rows first, and what reaches the driver is
one number per weight. The driver steps every problem by its own limited-memory quasi-Newton
state, so problems that are done wait while the others go on.

Support vector problems are one class against the rest, with a hinge that is rounded over half
a unit. Their duality gap comes with the gradient: the slopes of the losses are a dual point,
and the gap between both values bounds how far a solution is from the best one. The constant
is a feature like any other there, which makes the bound hold. The more rows, the less penalty
there is and the more the directions differ in curvature. Up to ``CURVED`` features the scan
therefore sums second derivatives too and steps are Newton's; beyond, a bounded sample of rows says
how curved each direction is. That shapes the steps alone: values, gradients and gaps are sums over
all rows. Softmax problems leave the constant free of penalty.

A large table is first fitted on a sample of bounded size, with the penalty of the whole table, and
the steps over all rows start from there. Most steps then cost the same whatever the table; where
the descent ends is decided by values, gradients and gaps over all rows as before.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from labelwright.sources.scratch import store

ROUND = 0.5
MEMORY = 10
LANDMARK_ROWS = 4096
MOST_LANDMARKS = 512
HALVINGS = 25
CURVED = 128
# Rows of the sample that a fit of more than four times as many rows starts from.
WARM_ROWS = 1 << 16
# Share of the curvature of all sampled rows that is added to that of the rows within the margin.
SPREAD = 0.01


@dataclass(frozen=True)
class Standard:
    """Standardised columns and the constant."""

    means: np.ndarray
    stds: np.ndarray

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return (x - self.means) / self.stds

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([self.scaled(x), np.ones(len(x))])

    @property
    def size(self) -> int:
        return len(self.means) + 1


def kernel(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
    return np.exp(-gamma * np.maximum(square, 0.0))


@dataclass(frozen=True)
class Landmarks:
    """Features whose products approximate the RBF kernel, from some of the rows (Nyström), and the constant."""

    base: Standard
    points: np.ndarray
    root: np.ndarray
    gamma: float

    def features(self, x: np.ndarray) -> np.ndarray:
        return kernel(self.base.scaled(x), self.points, self.gamma) @ self.root

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([self.features(x), np.ones(len(x))])

    @property
    def size(self) -> int:
        return self.root.shape[1] + 1

    def error(self, x: np.ndarray) -> np.ndarray:
        """What is missing of each row's product with itself, which is 1: between 0 and 1."""
        return np.clip(1.0 - (self.features(x) ** 2).sum(axis=1), 0.0, 1.0)


def fit_landmarks(base: Standard, sample: np.ndarray, tolerance: float, most: int = MOST_LANDMARKS) -> Landmarks:
    """Take the worst represented row of the sample until the mean error is within the tolerance.

    This is the pivoted Cholesky factorisation of the sample's kernel matrix, of which only the
    rows taken are computed. The kernel width is 1 / columns, the usual default for columns of
    unit variance.
    """
    z = base.scaled(sample)
    gamma = 1.0 / z.shape[1]
    left = np.ones(len(z))
    rows: list[int] = []
    factor = np.zeros((min(most, len(z)), len(z)))
    while len(rows) < len(factor) and left.mean() > tolerance:
        j = int(left.argmax())
        if left[j] < 1e-10:
            break
        i = len(rows)
        column = kernel(z[j : j + 1], z, gamma)[0]
        factor[i] = (column - factor[:i, j] @ factor[:i]) / np.sqrt(left[j])
        left = np.maximum(left - factor[i] ** 2, 0.0)
        left[j] = 0.0
        rows.append(j)
    points = z[rows]
    upper = np.linalg.cholesky(kernel(points, points, gamma) + 1e-10 * np.eye(len(rows))).T
    return Landmarks(base, points, np.linalg.inv(upper), gamma)


@dataclass(frozen=True)
class Margins:
    """The margins of fitted classes as features, and the constant."""

    base: Landmarks
    weights: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([self.base(x) @ self.weights.T, np.ones(len(x))])

    @property
    def size(self) -> int:
        return len(self.weights) + 1


@dataclass(frozen=True)
class Columns:
    """Features that the table holds already, and the constant."""

    first: int
    count: int

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([x[:, self.first : self.first + self.count], np.ones(len(x))])

    @property
    def size(self) -> int:
        return self.count + 1


Map = Standard | Landmarks | Margins | Columns
PerBatch = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def summed(table: DataFrame, per_batch: PerBatch, size: int) -> np.ndarray:
    """Sum of an array over all rows (x, y, fold), by task and then by position."""

    def add(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                total += per_batch(x, batch.column("y").to_numpy(), batch.column("fold").to_numpy())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["i", "v"])

    rows = table.select("x", "y", "fold").mapInArrow(add, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(size)
    out[rows.column("i").to_numpy()] = rows.column("v").to_numpy()
    return out


def mapped(table: DataFrame, maps: dict[int, Map]) -> tuple[DataFrame, dict[int, Columns]]:
    """The table (x, y, fold, id) with the features of all runs as x, written once, and where each run finds its own."""
    shared = table.sparkSession.sparkContext.broadcast(maps)

    def apply(batches):
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                f = np.concatenate([m(x)[:, :-1] for m in shared.value.values()], axis=1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(f) + 1, dtype=np.int32) * f.shape[1]), pa.array(f.ravel()))
                yield pa.RecordBatch.from_arrays([lists, *(batch.column(c) for c in ("y", "fold", "id"))], ["x", "y", "fold", "id"])

    rows = table.select("x", "y", "fold", "id").mapInArrow(apply, "x array<double>, y int, fold int, id bigint")
    ends = np.cumsum([m.size - 1 for m in maps.values()])
    return store(rows, "features"), {r: Columns(int(end) - m.size + 1, m.size - 1) for (r, m), end in zip(maps.items(), ends)}


def _warm(table: DataFrame, rows: dict[int, int]) -> tuple[DataFrame, dict[int, int]] | None:
    """A stored sample by id of a large table, and its rows per run."""
    most = max(rows.values())
    if most <= 4 * WARM_ROWS:
        return None
    share = int(WARM_ROWS / most * (1 << 30))
    few = store(table.where(F.pmod(F.xxhash64("id", F.lit("warm")), F.lit(1 << 30)) < share), "warm")
    counts = few.groupBy("fold").count().collect()
    found = {r: sum(c["count"] for c in counts if r == 0 or c["fold"] != r) for r in rows}
    return (few, found) if all(found.values()) else None


def standards(table: DataFrame, runs: tuple[int, ...], dims: int) -> tuple[dict[int, Standard], dict[int, int]]:
    """Scaling and number of rows of every run; deviations are taken about means, in a second scan."""
    folds = max(runs)
    width = 1 + dims

    def moments(about: np.ndarray, power: int) -> PerBatch:
        def per_batch(x, y, fold):
            out = np.zeros((folds + 1, width))
            # Folds that no run leaves out are kept by all.
            slot = np.where(np.isin(fold, runs), fold, 0)
            np.add.at(out, slot, np.column_stack([np.ones(len(x)), (x - about) ** power]))
            return out.ravel()

        return per_batch

    first = summed(table, moments(np.zeros(dims), 1), (folds + 1) * width).reshape(folds + 1, width)
    centre = first[:, 1:].sum(axis=0) / max(first[:, 0].sum(), 1)
    shift = summed(table, moments(centre, 1), (folds + 1) * width).reshape(folds + 1, width)
    square = summed(table, moments(centre, 2), (folds + 1) * width).reshape(folds + 1, width)
    maps, rows = {}, {}
    for run in runs:
        kept = np.arange(folds + 1) != run if run else np.ones(folds + 1, bool)
        n = first[kept, 0].sum()
        off = shift[kept, 1:].sum(axis=0) / max(n, 1)
        variance = np.maximum(square[kept, 1:].sum(axis=0) / max(n, 1) - off**2, 0.0)
        deviation = np.sqrt(variance)
        flat = deviation <= 1e-12 * (1.0 + np.abs(centre))
        maps[run], rows[run] = Standard(centre + off, np.where(flat, 1.0, deviation)), int(n)
    return maps, rows


@dataclass
class Fit:
    """Weights (class, feature), the value reached, its largest slope, and the gap to the best value where known."""

    weights: np.ndarray
    value: float
    slope: float
    gap: float | None


class _Descent:
    """One problem: where it is, what it has learned of its curvature, and the point it wants to try."""

    def __init__(self, start: np.ndarray, curved: Callable[[np.ndarray], np.ndarray] | None = None):
        self.curved, self.caution = curved, 1.0
        self.at, self.value, self.grad, self.gap = start, np.inf, np.zeros(len(start)), None
        self.trial, self.direction, self.step = self.at, None, 1.0
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []
        self.steps, self.halved, self.over = 0, 0, False

    def tell(self, value: float, grad: np.ndarray, gap: float | None, second: np.ndarray | None = None) -> None:
        fits = self.direction is None or value <= self.value + 1e-4 * self.step * (self.grad @ self.direction)
        if not fits:
            self.halved += 1
            self.step *= 0.5
            self.over = self.halved > HALVINGS
            self.trial = self.at if self.over else self.at + self.step * self.direction
            return
        if self.direction is not None:
            s, y = self.trial - self.at, grad - self.grad
            if s @ y > 1e-12 * np.sqrt((s @ s) * (y @ y)):
                self.pairs = [*self.pairs, (s, y)][-MEMORY:]
            self.steps += 1
            self.caution = max(1e-4, self.caution * 0.3) if self.step == 1.0 else min(1.0, self.caution * 4.0)
        self.at, self.value, self.grad, self.gap = self.trial, value, grad, gap
        if second is not None:
            self.direction, self.step, self.halved = -np.linalg.solve(second, grad), 1.0, 0
            self.trial = self.at + self.direction
            return
        q, used = grad.copy(), []
        for s, y in reversed(self.pairs):
            a = (s @ q) / (s @ y)
            q -= a * y
            used.append(a)
        if self.curved is not None:
            q = np.linalg.solve(self.curved(self.at), q)
        elif self.pairs:
            s, y = self.pairs[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, np.sqrt(grad @ grad))
        for (s, y), a in zip(self.pairs, reversed(used)):
            q += s * (a - (y @ q) / (s @ y))
        self.direction, self.step, self.halved = -q, 1.0, 0
        self.trial = self.at + self.direction


def _minimise(evaluate, starts: list[np.ndarray], steps: int, done, curved=None) -> list[_Descent]:
    """Descend on all problems; ``evaluate`` gives (value, gradient, gap) of each trial point, and may give the second derivative.

    It is told which problems go on; what it gives for the others is not looked at.
    """
    problems = [_Descent(start, how) for start, how in zip(starts, curved or [None] * len(starts))]
    while any(not p.over for p in problems):
        live = [not p.over for p in problems]
        for p, found in zip(problems, evaluate([p.trial for p in problems], [p.caution for p in problems], live)):
            if not p.over:
                p.tell(*found)
                if p.over or p.steps >= steps or (p.halved == 0 and done(p)):
                    p.over, p.trial = True, p.at
    return problems


def _kept(fold: np.ndarray, run: int) -> np.ndarray:
    return np.ones(len(fold)) if run == 0 else (fold != run).astype(float)


Sample = tuple[np.ndarray, np.ndarray, np.ndarray]


def _curvature(own: np.ndarray, f: np.ndarray, weight: float) -> Callable[[np.ndarray], np.ndarray]:
    """About the second derivative of a problem at a point, from the features and signs of sampled rows."""
    n = max(1, len(own))
    least = weight * np.eye(f.shape[1]) + SPREAD / (ROUND * n) * (f.T @ f)

    def at(w: np.ndarray) -> np.ndarray:
        inside = f[1.0 - own * (f @ w) > 0.0]
        return least + (inside.T @ inside) / (ROUND * n)

    return at


def fit_margins(
    table: DataFrame, maps: dict[int, Map], rows: dict[int, int], classes: int, c: float, steps: int, gap: float, sample: Sample | None = None
) -> dict[int, Fit]:
    """One class against the rest, for every run; stops at a gap relative to the value.

    A sample (x, y, fold) of the rows makes for fewer steps and does not change what is minimised.
    """
    runs = list(maps)
    starts = [np.zeros(maps[r].size) for r in runs for _ in range(classes)]
    if warm := _warm(table, rows):
        # The penalty stays that of all rows.
        more = max(rows.values()) / max(warm[1].values())
        near = fit_margins(warm[0], maps, warm[1], classes, c * more, steps, gap, sample)
        starts = [w for r in runs for w in near[r].weights]
    newton = max(maps[r].size for r in runs) <= CURVED
    widths = [classes * (2 + maps[r].size + newton * maps[r].size ** 2) for r in runs]
    cuts = np.concatenate([[0], np.cumsum(widths)])
    context = table.sparkSession.sparkContext

    def evaluate(points: list[np.ndarray], cautions: list[float], live: list[bool]):
        weights = {r: np.stack(points[i * classes : (i + 1) * classes]) for i, r in enumerate(runs)}
        # Rows beyond the rounding have no curvature; a descent that is far off counts them too.
        caution = {r: np.array(cautions[i * classes : (i + 1) * classes]) for i, r in enumerate(runs)}
        going = {r: live[i * classes : (i + 1) * classes] for i, r in enumerate(runs)}
        shared = context.broadcast((maps, weights, caution))

        def per_batch(x, y, fold):
            maps, weights, caution = shared.value
            out = np.zeros(cuts[-1])
            own = np.where(y[:, None] == np.arange(classes), 1.0, -1.0)
            for r, low, high in zip(runs, cuts[:-1], cuts[1:]):
                if not any(going[r]):
                    continue
                f = maps[r](x)
                kept = _kept(fold, r)[:, None]
                short = 1.0 - own * (f @ weights[r].T)
                slope = np.clip(short / ROUND, 0.0, 1.0)
                loss = np.where(short > ROUND, short - ROUND / 2, slope * slope * ROUND / 2)
                dual = slope - ROUND / 2 * slope * slope
                sums = [(loss * kept).sum(axis=0), (dual * kept).sum(axis=0), (-(slope * own * kept).T @ f).ravel()]
                if newton:
                    curved = np.where(short > ROUND, caution[r], 1.0) * (short > 0.0) * kept
                    for k in range(classes):
                        at = np.flatnonzero(curved[:, k] * going[r][k])
                        sums.append(((f[at] * curved[at, k, None]).T @ f[at]).ravel())
                out[low:high] = np.concatenate(sums)
            return out

        sums = summed(table, per_batch, int(cuts[-1]))
        shared.unpersist()
        out = []
        for r, low, high in zip(runs, cuts[:-1], cuts[1:]):
            part, n, weight = sums[low:high], rows[r], 1.0 / (c * rows[r])
            size = maps[r].size
            slopes = part[2 * classes : (2 + size) * classes].reshape(classes, -1) / n
            second = part[(2 + size) * classes :].reshape(-1, size, size) / (ROUND * n) + weight * np.eye(size)
            for k in range(classes):
                w = weights[r][k]
                value = weight / 2 * (w @ w) + part[k] / n
                bound = part[classes + k] / n - (slopes[k] @ slopes[k]) / (2 * weight)
                out.append((value, weight * w + slopes[k], value - bound, second[k] if newton else None))
        return out

    curved = []
    for r in runs if sample is not None and not newton else ():
        x, y, fold = (part[_kept(sample[2], r) > 0] for part in sample)
        f = maps[r](x)
        curved += [_curvature(np.where(y == k, 1.0, -1.0), f, 1.0 / (c * rows[r])) for k in range(classes)]
    found = _minimise(evaluate, starts, steps, lambda p: p.gap <= gap * max(p.value, 1e-12), curved)
    out = {}
    for i, r in enumerate(runs):
        own = found[i * classes : (i + 1) * classes]
        worst = max(p.gap / max(p.value, 1e-12) for p in own)
        out[r] = Fit(np.stack([p.at for p in own]), sum(p.value for p in own), max(np.abs(p.grad).max() for p in own), worst)
    return out


def fit_softmax(table: DataFrame, maps: dict[int, Map], rows: dict[int, int], classes: int, penalty: dict[int, float], steps: int, slope: float) -> dict[int, Fit]:
    """Multinomial logistic weights of every run; stops when no slope is steeper than asked."""
    runs = list(maps)
    sizes = [classes * maps[r].size for r in runs]
    starts = [np.zeros(size) for size in sizes]
    if warm := _warm(table, rows):
        near = fit_softmax(warm[0], maps, warm[1], classes, penalty, steps, max(slope, min(warm[1].values()) ** -0.5))
        starts = [near[r].weights.ravel() for r in runs]
    cuts = np.concatenate([[0], np.cumsum([1 + s for s in sizes])])
    context = table.sparkSession.sparkContext

    def evaluate(points: list[np.ndarray], _, live: list[bool]):
        weights = {r: p.reshape(classes, -1) for r, p in zip(runs, points)}
        shared = context.broadcast((maps, weights))

        def per_batch(x, y, fold):
            maps, weights = shared.value
            out = np.zeros(cuts[-1])
            for r, low, high, going in zip(runs, cuts[:-1], cuts[1:], live):
                if not going:
                    continue
                f, kept = maps[r](x), _kept(fold, r)
                z = f @ weights[r].T
                z -= z.max(axis=1, keepdims=True)
                total = np.log(np.exp(z).sum(axis=1))
                off = (np.exp(z - total[:, None]) - (y[:, None] == np.arange(classes))) * kept[:, None]
                out[low] = ((total - z[np.arange(len(y)), y]) * kept).sum()
                out[low + 1 : high] = (off.T @ f).ravel()
            return out

        sums = summed(table, per_batch, int(cuts[-1]))
        shared.unpersist()
        out = []
        for r, low, high in zip(runs, cuts[:-1], cuts[1:]):
            w = weights[r].copy()
            w[:, -1] = 0.0
            value = sums[low] / rows[r] + penalty[r] / 2 * (w * w).sum()
            out.append((value, sums[low + 1 : high] / rows[r] + penalty[r] * w.ravel(), None))
        return out

    found = _minimise(evaluate, starts, steps, lambda p: np.abs(p.grad).max() <= slope)
    return {r: Fit(p.at.reshape(classes, -1), p.value, float(np.abs(p.grad).max()), None) for r, p in zip(runs, found)}


def kernel_error(table: DataFrame, maps: dict[int, Landmarks], rows: dict[int, int]) -> dict[int, float]:
    """Mean error of the features of each run over its training rows."""
    runs = list(maps)
    shared = table.sparkSession.sparkContext.broadcast(maps)

    def per_batch(x, y, fold):
        return np.array([(shared.value[r].error(x) * _kept(fold, r)).sum() for r in runs])

    return {r: v / rows[r] for r, v in zip(runs, summed(table, per_batch, len(runs)))}
