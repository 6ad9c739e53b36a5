"""Quality scores from a byte-level convolutional network, trained and applied in numpy.

A whole text is cut into half chunks of 64 bytes, each read with the bytes that follow it, so
that no window is lost between them. Bytes have learned vectors; learned filters of eight bytes
run over them with a step of two, and each filter keeps its largest response per half chunk.
Chunks are two neighbouring halves, so they overlap by one half and cover the whole document.
Every chunk gives hidden responses; their maximum and mean over all chunks of the document meet
in one logistic unit.

The network learns from at most about ``per_class`` labelled rows per class, chosen by a hash of
the id, and of a longer text from 16 evenly spaced slices of 2 kB; only training is bounded so.
Scoring reads every byte of every text, in runs of bounded memory: a long text is pooled piece
by piece.

Defined results: a null text is empty; an empty text is one window of padding and has a score.
Labels other than 0 and 1, null ids and null labels teach nothing; an id with several labels
counts with the smallest. If only one class can be learned, every score is that class's label,
and 0.5 if there is none. Scores are rounded to six decimals; equal texts get equal scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from labelwright.llm.arrays import flat

HALF = 64
WIDTH = 8
STEP = 2
DIMS = 8
FILTERS = 48
HIDDEN = 16
PER_CLASS = 600
SLICES = 16
SLICE_BYTES = 2048
EPOCHS = 6
DOCS_PER_STEP = 24
RATE = 0.004
SEED = 7
RUN_HALVES = 2048

_REACH = HALF + WIDTH - STEP
_PLACES = HALF // STEP


def halves_of(lengths: np.ndarray) -> np.ndarray:
    """Half chunks that cover texts of these lengths; an empty text has one."""
    return np.maximum(1, -(-lengths // HALF))


def half_bytes(body: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The bytes each half chunk reads, zero beyond the end of its text."""
    at = start[:, None] + np.arange(_REACH)
    inside = at < end[:, None]
    if not len(body):
        return np.zeros(at.shape, np.uint8)
    return np.where(inside, body[np.minimum(at, len(body) - 1)], 0).astype(np.uint8)


@dataclass
class Network:
    """Weights by name: byte vectors, filters, hidden layer, output."""

    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, seed: int = SEED) -> Network:
        rng = np.random.default_rng(seed)
        normal = lambda *shape, scale: (rng.normal(size=shape) * scale).astype(np.float32)
        return cls(
            {
                "bytes": normal(256, DIMS, scale=0.5),
                "filters": normal(WIDTH * DIMS, FILTERS, scale=(WIDTH * DIMS) ** -0.5),
                "filter_bias": np.zeros(FILTERS, np.float32),
                "hidden": normal(FILTERS, HIDDEN, scale=FILTERS**-0.5),
                "hidden_bias": np.zeros(HIDDEN, np.float32),
                "out": normal(2 * HIDDEN, scale=(2 * HIDDEN) ** -0.5),
                "out_bias": np.zeros(1, np.float32),
            }
        )

    def windows(self, read: np.ndarray) -> np.ndarray:
        """(half chunk, place, WIDTH * DIMS) inputs of the filters."""
        x = np.ascontiguousarray(self.weights["bytes"][read]).reshape(len(read), _REACH * DIMS)
        shape = (len(read), _PLACES, WIDTH * DIMS)
        return np.lib.stride_tricks.as_strided(x, shape, (x.strides[0], STEP * DIMS * 4, 4), writeable=False)

    def pooled(self, read: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Raw responses (half chunk, place, filter), and the largest per filter."""
        x = np.ascontiguousarray(self.windows(read)).reshape(-1, WIDTH * DIMS)
        raw = (x @ self.weights["filters"]).reshape(len(read), _PLACES, FILTERS)
        return raw, np.maximum(raw.max(axis=1) + self.weights["filter_bias"], 0)

    def hidden(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled @ self.weights["hidden"] + self.weights["hidden_bias"], 0)

    def probability(self, most: np.ndarray, mean: np.ndarray) -> np.ndarray:
        z = np.concatenate([most, mean], axis=1) @ self.weights["out"] + self.weights["out_bias"]
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))


def _chunks(pooled: np.ndarray, n_halves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunk responses, index of each chunk's first half, and chunks per text."""
    first = np.cumsum(n_halves) - n_halves
    n_chunks = np.maximum(1, n_halves - 1)
    left = np.repeat(first - (np.cumsum(n_chunks) - n_chunks), n_chunks) + np.arange(n_chunks.sum())
    right = np.minimum(left + 1, np.repeat(first + n_halves - 1, n_chunks))
    return np.maximum(pooled[left], pooled[right]), left, n_chunks


def _gradient(net: Network, body, offsets, target, weight) -> tuple[float, dict[str, np.ndarray]]:
    """Loss and gradient over a few texts."""
    w = net.weights
    n_halves = halves_of(np.diff(offsets))
    first = np.cumsum(n_halves) - n_halves
    doc_of_half = np.repeat(np.arange(len(n_halves)), n_halves)
    start = offsets[doc_of_half] + HALF * (np.arange(n_halves.sum()) - first[doc_of_half])
    read = half_bytes(body, start, offsets[1:][doc_of_half])
    raw, pooled = net.pooled(read)
    h, left, n_chunks = _chunks(pooled, n_halves)
    u = net.hidden(h)
    doc = np.repeat(np.arange(len(n_halves)), n_chunks)
    at = np.cumsum(n_chunks) - n_chunks
    most = np.maximum.reduceat(u, at, axis=0)
    mean = np.add.reduceat(u, at, axis=0) / n_chunks[:, None]
    p = net.probability(most, mean)
    loss = -(weight * np.log(np.where(target == 1, p, 1 - p))).sum() / weight.sum()
    dz = (weight * (p - target) / weight.sum()).astype(np.float32)
    grad = {"out": np.concatenate([most, mean], axis=1).T @ dz, "out_bias": dz.sum(keepdims=True)}
    dv = dz[:, None] * w["out"]
    peak = u == most[doc]
    shared = np.add.reduceat(peak, at, axis=0, dtype=np.float32)
    du = peak * (dv[:, :HIDDEN] / shared)[doc] + (dv[:, HIDDEN:] / n_chunks[:, None])[doc]
    du *= u > 0
    grad["hidden"], grad["hidden_bias"] = h.T @ du, du.sum(axis=0)
    dh = du @ w["hidden"].T
    last = np.repeat(first + n_halves - 1, n_chunks)
    right = np.minimum(left + 1, last)
    to_left = pooled[left] >= pooled[right]
    dp = np.zeros_like(pooled)
    np.add.at(dp, left, dh * to_left)
    np.add.at(dp, right, dh * ~to_left)
    dp *= pooled > 0
    half, filt = np.nonzero(dp)
    place = raw.argmax(axis=1)[half, filt]
    d = dp[half, filt]
    taken = net.windows(read)[half, place] * d[:, None]
    order = np.argsort(filt, kind="stable")
    cuts = np.flatnonzero(np.append(True, np.diff(filt[order]) != 0)) if len(filt) else np.zeros(0, np.int64)
    grad["filters"] = np.zeros_like(w["filters"])
    if len(filt):
        grad["filters"][:, filt[order][cuts]] = np.add.reduceat(taken[order], cuts, axis=0).T
    grad["filter_bias"] = dp.sum(axis=0)
    seen = read[half[:, None], (STEP * place)[:, None] + np.arange(WIDTH)].ravel()
    back = (w["filters"].T[filt] * d[:, None]).reshape(-1, DIMS)
    grad["bytes"] = np.stack([np.bincount(seen, back[:, k], 256) for k in range(DIMS)], axis=1).astype(np.float32)
    return float(loss), grad


def train(texts: list[bytes], labels: np.ndarray, weights: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """Adam over small groups of texts in a seeded order; the rate falls to zero."""
    net, rng = Network.fresh(seed), np.random.default_rng(seed)
    body = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    mean = {k: np.zeros_like(v) for k, v in net.weights.items()}
    square = {k: np.zeros_like(v) for k, v in net.weights.items()}
    steps, step = epochs * -(-len(texts) // DOCS_PER_STEP), 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for i in range(0, len(texts), DOCS_PER_STEP):
            rows = order[i : i + DOCS_PER_STEP]
            part = np.concatenate([body[bounds[r] : bounds[r + 1]] for r in rows])
            offsets = np.concatenate([[0], np.cumsum(bounds[rows + 1] - bounds[rows])])
            _, grad = _gradient(net, part, offsets, labels[rows], weights[rows])
            step += 1
            rate = RATE * (1 - (step - 1) / steps) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, g in grad.items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.001 * (g * g - square[k])
                net.weights[k] -= (rate * mean[k] / (np.sqrt(square[k]) + 1e-8)).astype(np.float32)
    return net


def score(net: Network, body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probability of each whole text."""
    n_halves = halves_of(np.diff(offsets))
    first = np.concatenate([[0], np.cumsum(n_halves)])
    most = np.zeros((len(n_halves), HIDDEN), np.float32)
    total = np.zeros((len(n_halves), HIDDEN))
    before = None
    for lo in range(0, int(first[-1]), RUN_HALVES):
        hi = min(lo + RUN_HALVES, int(first[-1]))
        doc = np.searchsorted(first, np.arange(lo, hi), "right") - 1
        start = offsets[doc] + HALF * (np.arange(lo, hi) - first[doc])
        pooled = net.pooled(half_bytes(body, start, offsets[1:][doc]))[1]
        pair = np.append(False, doc[1:] == doc[:-1])
        if before is not None and before[0] == doc[0]:
            pair[0] = True
            behind = np.concatenate([before[1][None], pooled[:-1]])
        else:
            behind = np.concatenate([pooled[:1], pooled[:-1]])
        take = pair | (n_halves[doc] == 1)
        u = net.hidden(np.where(pair[:, None], np.maximum(behind, pooled), pooled)[take])
        who = doc[take]
        if len(who):
            at = np.flatnonzero(np.append(True, np.diff(who) != 0))
            most[who[at]] = np.maximum(most[who[at]], np.maximum.reduceat(u, at, axis=0))
            total[who[at]] += np.add.reduceat(u, at, axis=0, dtype=np.float64)
        before = int(doc[-1]), pooled[-1]
    mean = (total / np.maximum(1, n_halves - 1)[:, None]).astype(np.float32)
    return np.round(net.probability(most, mean), 6)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 1 when divided by 3; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _slices(raw: bytes) -> bytes:
    """A text for training: whole, or 16 evenly spaced slices of a longer one."""
    if len(raw) <= SLICES * SLICE_BYTES:
        return raw
    gap = (len(raw) - SLICE_BYTES) / (SLICES - 1)
    return b"".join(raw[round(i * gap) : round(i * gap) + SLICE_BYTES] for i in range(SLICES))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, epochs: int = EPOCHS) -> Network | float:
    """A network, or the only score when there are not two classes to learn."""
    given = labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_y"))
    given = given.where(F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & ~held_out(F.col("_id")))
    given = given.groupBy("_id").agg(F.min("_y").alias("_y"))
    sizes = dict(given.groupBy("_y").count().collect())
    if len(sizes) < 2:
        return float(next(iter(sizes), 0.5))
    share = F.when(F.col("_y") == 1, min(1.0, per_class / sizes[1])).otherwise(min(1.0, per_class / sizes[0]))
    chosen = given.where(F.pmod(F.xxhash64("_id", F.lit("learn")), F.lit(1_000_000)) < share * 1_000_000)
    rows = docs.select(F.col("doc_id").alias("_doc"), F.coalesce("text", F.lit("")).cast("binary").alias("_text"))
    rows = rows.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("_y", "_text")

    def cut(batches):
        for batch in batches:
            for i in range(len(batch)):
                raw = _slices(batch.column(1)[i].as_py())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([raw], pa.binary())], ["_y", "_text"])

    table = rows.mapInArrow(cut, "_y int, _text binary").distinct().toPandas().sort_values(["_y", "_text"])
    target = table["_y"].to_numpy()
    if len(set(target)) < 2:
        return float(target[0]) if len(target) else 0.5
    seen = np.bincount(target, minlength=2)
    weight = np.array([sizes[0], sizes[1]])[target] / seen[target]
    # A rare class weighs at least a quarter, so that its mistakes are learned from.
    weight = weight / weight.sum() * len(target)
    of_class = np.array([weight[target == c].sum() for c in (0, 1)]) / len(target)
    weight *= (np.maximum(of_class, 0.25) / of_class)[target]
    return train([bytes(t) for t in table["_text"]], target, weight, epochs)


def quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, epochs: int = EPOCHS) -> DataFrame:
    """doc_id, held_out, score and predicted class of every document."""
    model = fit(docs, labels, per_class, epochs)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("_text"))

    def scored(batches):
        net = sent.value
        for batch in batches:
            for i in range(0, len(batch), 256):
                rows = batch.slice(i, 256)
                if isinstance(net, Network):
                    values = score(net, *flat(rows.column(1)))
                else:
                    values = np.full(len(rows), net)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(values, pa.float64())], ["doc_id", "score"])

    kind = source.schema["doc_id"].dataType.simpleString()
    found = source.mapInArrow(scored, f"doc_id {kind}, score double")
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )
