"""Approximate nearest neighbours by several tables of random projections.

A table projects a row on random directions and notes in which quantile bin each projection
falls; quantiles and directions come from a bounded sample. The code of a row names the bins
digit by digit: first the eighth of each direction, then the eighth of that eighth, and so on. A
bucket is the shortest beginning of the code that few rows share, so buckets stay small in dense
regions and large in sparse ones, whatever the table. A query looks into its own bucket of every
table and into those behind the bin borders that it is closest to, as fine as its own bucket is;
the lists of all buckets are merged by one aggregation. The tables are searched one after the other,
so the disk holds the copies of the rows of one table at a time.

Every row is in every table. Equal points are collapsed as in the exact search. Points that
share a whole code are dealt into parts of bounded size, and all parts are visited. Whether a
search is exact or approximate is the caller's choice and never depends on the size of a table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from labelwright.operators.blocks import FEW_DIMS, SAMPLE_BYTES
from labelwright.operators.neighbours import DECIMALS, MOST_QUERIES, _lists_per_row, _matrix, _unusable, collapse
from labelwright.sources.scratch import BROADCAST_BYTES, small, store, temporary
from labelwright.spec import Params

TABLES = 4
PROBES = 6
BUCKET_ROWS = 64
DIGITS = 18
BITS = 3
# Directions of a table; the digits after the first of each direction refine its bins.
DIRECTIONS = 6
DIRECTIONS_MANY_DIMS = 9
SAMPLE_ROWS = 20_000
CLOSEST = 8
# Of a leaf in the sorted arrays of all leaves.
LEAF_BYTES = 13
# Digits by which the codes are summed up before the leaves among them are looked for.
STEP = 6
# Rows that meet in one task's group, and pairs of a visit and a point under way there.
PACKET_ROWS = 16_384
PAIRS = 1 << 20

_CODES = "t int, code bigint"


@dataclass(frozen=True)
class Projections:
    """Directions (table, direction, column) and the inner borders of their finest bins (table, direction, border)."""

    directions: np.ndarray
    borders: np.ndarray

    @property
    def rounds(self) -> int:
        return DIGITS // self.directions.shape[1]

    def values(self, x: np.ndarray, t: int) -> np.ndarray:
        return x @ self.directions[t].T

    def bins(self, values: np.ndarray, t: int) -> np.ndarray:
        """The finest bin of each projection."""
        return np.stack([np.searchsorted(b, values[:, j], "left") for j, b in enumerate(self.borders[t])], axis=1)

    def codes(self, bins: np.ndarray) -> np.ndarray:
        """The bins of each row as one number: the first digits of all directions, then the second ones."""
        out = np.zeros(len(bins), np.int64)
        for r in range(self.rounds):
            for j in range(bins.shape[1]):
                out = (out << BITS) | ((bins[:, j] >> (BITS * (self.rounds - 1 - r))) & ((1 << BITS) - 1))
        return out


def fit_projections(sample: np.ndarray, tables: int, seed: int) -> Projections:
    rng = np.random.default_rng(seed)
    some = DIRECTIONS if sample.shape[1] <= FEW_DIMS else DIRECTIONS_MANY_DIMS
    directions = rng.normal(size=(tables, some, sample.shape[1]))
    directions /= np.linalg.norm(directions, axis=2, keepdims=True)
    most = 1 << (BITS * (DIGITS // some))
    values = np.einsum("td,ksd->kst", sample, directions)
    return Projections(directions, np.quantile(values, np.arange(1, most) / most, axis=2).transpose(1, 2, 0))


def probe_codes(p: Projections, x: np.ndarray, t: int, probes: int, depth: np.ndarray) -> np.ndarray:
    """(row, probe) codes: the own one, then those with bins behind the closest borders.

    Bins are as fine as the first ``depth`` digits of a row make them; behind a border the finest
    bin next to it counts. Steps in different directions are combined by up to three and ordered by
    the sum of squared distances to the borders crossed.
    """
    values = p.values(x, t)
    bins = p.bins(values, t)
    own = p.codes(bins)
    if probes < 2:
        return own[:, None]
    some, b = bins.shape[1], p.borders[t]
    direction = np.arange(some)
    known = np.clip((depth[:, None] - direction + some - 1) // some, 0, p.rounds)
    shift = BITS * (p.rounds - known)
    low, high = (bins >> shift) << shift, ((bins >> shift) + 1) << shift
    last = b.shape[1]
    below = np.where(low > 0, values - b[direction, np.maximum(low - 1, 0)], np.inf)
    above = np.where(high <= last, b[direction, np.minimum(high, last) - 1] - values, np.inf)
    cost = np.concatenate([below, above], axis=1) ** 2
    moves = []
    for side in (low - 1, high):
        for j in range(some):
            moved = bins.copy()
            moved[:, j] = np.clip(side[:, j], 0, last)
            moves.append(p.codes(moved) - own)
    closest = np.argsort(cost, axis=1, kind="stable")[:, :CLOSEST]
    finite = np.take_along_axis(cost, closest, axis=1)
    step = np.where(np.isinf(finite), 0, np.take_along_axis(np.stack(moves, axis=1), closest, axis=1))
    sets = [s for n in (1, 2, 3) for s in combinations(range(closest.shape[1]), n)]
    chosen = np.zeros((len(sets), closest.shape[1]))
    for i, s in enumerate(sets):
        chosen[i, list(s)] = 1
    total = np.minimum(finite, 1e300) @ chosen.T
    moved = step @ chosen.astype(np.int64).T
    for one, other in combinations(range(closest.shape[1]), 2):
        both = (chosen[:, one] * chosen[:, other] > 0)[None, :] & (closest[:, one] % some == closest[:, other] % some)[:, None]
        total[both], moved[both] = np.inf, 0
    best = np.argsort(total, axis=1, kind="stable")[:, : probes - 1]
    return np.concatenate([own[:, None], own[:, None] + np.take_along_axis(moved, best, axis=1)], axis=1)


@dataclass(frozen=True)
class ProjectionIndex:
    """Buckets of all tables: ``points`` (id, x, li, block), ``sizes`` (block, held), ``leaves`` (t, depth, head, parts, n).

    ``base`` (id, x, li) are the collapsed rows, of which there are ``held``.
    """

    points: DataFrame
    sizes: DataFrame
    leaves: DataFrame
    base: DataFrame
    projections: Projections
    labels: tuple[str, ...]
    k: int
    rows: int
    held: int
    dims: int
    depths: tuple[int, ...]
    digits: int

    @property
    def tables(self) -> int:
        return len(self.projections.directions)

    def of(self, t: int) -> DataFrame:
        """The rows (id, x, li, block) of one table."""
        return _located(self.base, self.projections, self.leaves, self.depths, [t])


def _beginning(depth: int | Column) -> Column:
    shift = (DIGITS - depth) * BITS if isinstance(depth, int) else (F.lit(DIGITS) - depth) * BITS
    return F.call_function("shiftright", F.col("code"), F.lit(shift) if isinstance(shift, int) else shift.cast("int"))


def _leaves(counts: DataFrame, bucket_rows: int) -> DataFrame:
    """The shortest beginnings that few rows share, the empty one first; one more digit per round, for what is still open.

    Every few rounds the codes that are open are summed up by the digits of the next ones.
    """
    leaves, left, open_ = None, counts, []
    for depth in range(DIGITS + 1):
        if depth % STEP == 0:
            ends = min(depth + STEP - 1, DIGITS)
            for at, still in open_:
                counts = counts.join(still, (F.col("t") == F.col("_t")) & (_beginning(at) == F.col("_head")), "left_semi")
            cut = (_beginning(ends) * F.lit(1 << ((DIGITS - ends) * BITS))).alias("code")
            left = counts = store(counts, "codes") if depth else counts
            left, open_ = store(left.groupBy("t", cut).agg(F.sum("n").alias("n")), "beginnings"), []
        sums = store(left.groupBy("t", _beginning(depth).alias("head")).agg(F.sum("n").alias("n")), "beginnings")
        done = F.col("n") <= bucket_rows if depth < DIGITS else F.lit(True)
        own = sums.where(done).select("t", F.lit(depth).alias("depth"), "head", F.ceil(F.col("n") / bucket_rows).cast("int").alias("parts"), "n")
        leaves = own if leaves is None else leaves.unionByName(own)
        still = sums.where(~done).select(F.col("t").alias("_t"), F.col("head").alias("_head"))
        if still.isEmpty():
            break
        still = small(still, 24)
        open_ = [(depth, still)]
        left = left.join(still, (F.col("t") == F.col("_t")) & (_beginning(depth) == F.col("_head")), "left_semi")
    return store(leaves, "leaves")


def _starts(t: np.ndarray, code: np.ndarray) -> np.ndarray:
    return (t.astype(np.int64) << (DIGITS * BITS)) | code


def _found(coded: DataFrame, leaves: DataFrame, outer: bool) -> DataFrame:
    """Rows with a code get the leaf that it lies in from the sorted leaves, which every worker holds.

    Leaves are ranges of codes that do not meet, so one search by bisection finds the only one. With
    ``outer`` rows without a leaf stay, at depth -1.
    """
    held = leaves.select("t", "depth", "head", "parts").toArrow()
    t, depth, head, parts = (held.column(c).to_numpy().astype(np.int64) for c in ("t", "depth", "head", "parts"))
    starts = _starts(t, head << ((DIGITS - depth) * BITS))
    order = np.argsort(starts)
    shared = coded.sparkSession.sparkContext.broadcast((starts[order], depth[order].astype(np.int8), parts[order].astype(np.int32)))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, depth, parts = shared.value
        for batch in batches:
            t, code = batch.column("t").to_numpy(), batch.column("code").to_numpy()
            at = np.maximum(np.searchsorted(starts, _starts(t, code), "right") - 1, 0)
            shift = (DIGITS - depth[at].astype(np.int64)) * BITS
            head = code >> shift
            inside = starts[at] == _starts(t, head << shift)
            met = np.arange(len(t)) if outer else np.flatnonzero(inside)
            known = batch.take(pa.array(met))
            found = np.where(inside, depth[at], -1)[met].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*known.columns, pa.array(found), pa.array(head[met]), pa.array(parts[at][met])],
                [*known.schema.names, "depth", "head", "parts"],
            )

    return coded.mapInArrow(find, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in coded.schema) + ", depth int, head bigint, parts int")


def _in_leaves(coded: DataFrame, leaves: DataFrame, depths: tuple[int, ...], outer: bool = False) -> DataFrame:
    """Rows with a code get the leaf (depth, head, parts) that the code lies in."""
    if leaves.count() * LEAF_BYTES <= BROADCAST_BYTES:
        return _found(coded, leaves, outer)
    held = leaves.select(F.col("t").alias("_t"), F.col("depth").alias("_depth"), F.col("head").alias("_head"), "parts")
    each = coded.withColumn("depth", F.explode(F.array(*[F.lit(d) for d in depths])))
    met = each.withColumn("head", _beginning(F.col("depth"))).join(
        held, (F.col("t") == F.col("_t")) & (F.col("depth") == F.col("_depth")) & (F.col("head") == F.col("_head"))
    ).drop("_t", "_depth", "_head")
    if not outer:
        return met
    found = met.select("qid", "t", "depth", "head", "parts")
    return coded.join(found, ["qid", "t"], "left").select(*coded.columns, F.coalesce("depth", F.lit(-1)).alias("depth"), "head", "parts")


def _in_buckets(coded: DataFrame, leaves: DataFrame, depths: tuple[int, ...], part: Column) -> DataFrame:
    """Rows with a code get the number of the bucket that the code lies in."""
    return _in_leaves(coded, leaves, depths).withColumn("part", part).withColumn("block", _block())


def _block() -> Column:
    return F.xxhash64("t", "depth", "head", "part")


def _coded(rows: DataFrame, projections: Projections, tables: Sequence[int]) -> DataFrame:
    """Every row with its code in each of the tables."""
    shared = rows.sparkSession.sparkContext.broadcast(projections)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for batch in batches:
            x = _matrix(batch.column("x"))
            for t in tables:
                codes = p.codes(p.bins(p.values(x, t), t)) if len(x) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(np.full(len(x), t, np.int32)), pa.array(codes)], [*batch.schema.names, "t", "code"]
                )

    return rows.mapInArrow(code, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + f", {_CODES}")


def _located(base: DataFrame, projections: Projections, leaves: DataFrame, depths: tuple[int, ...], tables: Sequence[int]) -> DataFrame:
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    return _in_buckets(_coded(base, projections, tables), leaves, depths, own).select("id", "x", "li", "block")


def build_projection_index(
    vectors: DataFrame,
    k: int = Params.k,
    tables: int = TABLES,
    bucket_rows: int = BUCKET_ROWS,
    sample_rows: int = SAMPLE_ROWS,
    seed: int = Params.seed,
    max_classes: int = Params.max_classes,
) -> ProjectionIndex:
    """Index (id, x, label) for approximate searches of up to k neighbours.

    At most about ``sample_rows`` rows, and 64 MB, decide on the bins; all rows are indexed.
    """
    base = collapse(vectors, k, max_classes)
    rows = min(sample_rows, SAMPLE_BYTES // (8 * base.dims))
    share = int(min(1.0, rows / base.held) * (1 << 30)) + 1
    chosen = base.points.where(F.pmod(F.xxhash64("id", F.lit("bins")), F.lit(1 << 30)) < share)
    sample = _matrix(chosen.select("x").limit(2 * rows).toArrow().column("x"))
    projections = fit_projections(sample if len(sample) else np.zeros((1, base.dims)), tables, seed)
    points = base.points.select("id", "x", "li")
    with temporary(vectors.sparkSession) as kept:
        counts = store(_coded(points.select("x"), projections, range(tables)).groupBy("t", "code").agg(F.count("*").alias("n")), "codes")
        leaves = _leaves(counts, bucket_rows)
        kept.pop()
    by_depth = sorted(leaves.groupBy("depth").agg(F.sum("n")).collect())
    depths = tuple(d for d, _ in by_depth)
    half, digits = sum(n for _, n in by_depth) / 2, depths[-1]
    for depth, n in reversed(by_depth):
        half -= n
        digits = depth
        if half <= 0:
            break
    located = _located(points, projections, leaves, depths, range(tables))
    whole = leaves.where("parts = 1").select("t", "depth", "head", F.lit(0).alias("part"), "n").select(_block().alias("block"), F.col("n").alias("held"))
    dealt = leaves.where("parts > 1").select("t", "depth", "head", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).select(_block().alias("block"))
    sizes = whole.unionByName(located.join(dealt, "block", "left_semi").groupBy("block").agg(F.count("*").alias("held")))
    return ProjectionIndex(located, sizes, leaves, points, projections, base.labels, k, base.rows, base.held, base.dims, depths, digits)


def visits(index: ProjectionIndex, queries: DataFrame, probes: int = PROBES, tables: Sequence[int] | None = None) -> DataFrame:
    """(qid, x, reach, block): every bucket of the tables that each distinct query point looks into, once."""
    shared = queries.sparkSession.sparkContext.broadcast(index.projections)
    digits, columns = index.digits, ["qid", "x", "t", "code"]
    heads = queries.groupBy("x").agg(F.min("id").alias("qid")).select("qid", "x")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                piece = batch.slice(start, 4096)
                x, t, depth = _matrix(piece.column("x")), piece.column("t").to_numpy(), piece.column("depth").to_numpy()
                for table in np.unique(t):
                    at = np.flatnonzero(t == table)
                    codes = probe_codes(p, x[at], table, probes, np.where(depth[at] < 0, digits, depth[at]))
                    rows = piece.select(columns[:3]).take(pa.array(np.repeat(at, codes.shape[1])))
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(codes.ravel())], columns)

    coded = _coded(heads, index.projections, range(index.tables) if tables is None else tables)
    placed = _in_leaves(coded, index.leaves, index.depths, outer=True)
    probed = placed.select("qid", "x", "t", "depth").mapInArrow(probe, f"qid bigint, x array<double>, {_CODES}")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    met = _in_buckets(probed, index.leaves, index.depths, every)
    return met.groupBy("qid", "block").agg(F.first("x").alias("x")).select("qid", "x", F.lit(float("inf")).alias("reach"), "block")


def _nearest_in_buckets(q: np.ndarray, first: np.ndarray, size: np.ndarray, points: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(visit, point, distance) of the k nearest of the ``size`` points from ``first`` on, which come sorted by id.

    Distances are rounded before they are compared, and equal ones go to the smaller id.
    """
    scale, out = 10.0**DECIMALS, []
    order = np.argsort(size, kind="stable")
    start = 0
    while start < len(order):
        some = max(1, PAIRS // max(1, size[order[min(start + PAIRS, len(order)) - 1]]))
        at = order[start : start + some]
        start += some
        place = np.arange(size[at[-1]])
        pick = first[at][:, None] + np.minimum(place, size[at][:, None] - 1)
        square = np.zeros(pick.shape)
        for j in range(points.shape[1]):
            gap = q[at, j, None] - points[pick, j]
            square += gap * gap
        dist = np.floor(np.sqrt(square) * scale + 0.5) / scale
        dist[place >= size[at][:, None]] = np.inf
        best = np.argsort(dist, axis=1, kind="stable")[:, :k]
        dist = np.take_along_axis(dist, best, axis=1)
        row, col = np.nonzero(~np.isinf(dist))
        out.append((at[row], np.take_along_axis(pick, best, axis=1)[row, col], dist[row, col]))
    return tuple(np.concatenate(part) for part in zip(*out))


_NEAR = "qid bigint, d array<double>, nid array<bigint>, li array<int>"


def _look(looks: DataFrame, points: DataFrame, held: int, k: int) -> DataFrame:
    """(qid, d, nid, li): the k best points of each bucket visited, many small buckets to a group.

    The visits of one bucket are dealt out, and its points are copied to each part.
    """
    counts = store(looks.groupBy("block").agg(F.count("*").alias("n")), "counts")
    asked, blocks = counts.agg(F.sum("n"), F.count("*")).first()
    turns = small(counts.select("block", F.ceil(F.col("n") / MOST_QUERIES).cast("int").alias("turns")), 16, rows=blocks)
    packets = -(-((asked or 0) + held) // PACKET_ROWS)
    packet = F.pmod(F.xxhash64("block", "turn"), F.lit(packets)).cast("int").alias("packet")
    dealt = looks.join(turns, "block").withColumn("turn", F.pmod(F.xxhash64("qid"), F.col("turns")).cast("int"))
    copied = points.join(turns, "block").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))

    def search(key, asked: pa.Table, points: pa.Table) -> pa.Table:
        ids, block = points.column("id").to_numpy(), points.column("block").to_numpy()
        turn, li = points.column("turn").to_numpy(), points.column("li").to_numpy()
        order = np.lexsort((ids, turn, block))
        ids, block, turn, li, x = ids[order], block[order], turn[order], li[order], _matrix(points.column("x"))[order]
        firsts = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (turn[1:] != turn[:-1]))[: len(block)])
        units = np.rec.fromarrays([block[firsts], turn[firsts]])
        wanted = np.rec.fromarrays([asked.column("block").to_numpy(), asked.column("turn").to_numpy()])
        at = np.searchsorted(units, wanted) if len(units) else np.zeros(len(wanted), np.int64)
        met = np.flatnonzero(units[np.minimum(at, len(units) - 1)] == wanted) if len(units) else np.zeros(0, np.int64)
        if not len(met):
            return _NEAR_SCHEMA.empty_table()
        sizes = np.diff(np.append(firsts, len(block)))
        visit, point, dist = _nearest_in_buckets(_matrix(asked.column("x"))[met], firsts[at[met]], sizes[at[met]], x, k)
        who = np.flatnonzero(np.append(True, visit[1:] != visit[:-1]))
        ends = pa.array(np.append(who, len(visit)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (dist, ids[point], li[point])]
        return pa.Table.from_arrays([pa.array(asked.column("qid").to_numpy()[met][visit[who]]), *lists], schema=_NEAR_SCHEMA)

    return (
        dealt.select("qid", "x", "block", "turn", packet)
        .groupBy("packet")
        .cogroup(copied.select(*[F.col(c).alias(c) for c in ("id", "x", "li", "block", "turn")], packet).groupBy("packet"))
        .applyInArrow(search, _NEAR)
    )


_NEAR_SCHEMA = pa.schema([("qid", pa.int64()), ("d", pa.list_(pa.float64())), ("nid", pa.list_(pa.int64())), ("li", pa.list_(pa.int32()))])


def approximate_search(index: ProjectionIndex, queries: DataFrame, probes: int = PROBES, skip_same_id: bool = False) -> DataFrame:
    """(id, label, neighbours) of queries (id, x, label): the nearest of the rows in the buckets visited.

    Distances are exact. A query whose buckets are all empty has an empty list.
    """
    other = (F.size("x") != index.dims) | _unusable()
    asked = queries.agg(F.count("*").alias("n"), F.count_if(other).alias("other")).first()
    if asked["other"]:
        raise ValueError(f"queries need {index.dims} finite values each")
    k = index.k + 1 if skip_same_id else index.k
    merged = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))), 1, k).alias("near")
    none = F.lit(None).cast("array<struct<d:double,nid:bigint,li:int>>")
    lists = queries.groupBy("x").agg(F.min("id").alias("qid")).select("qid", "x", none.alias("near"))
    for t in range(index.tables):
        with temporary(queries.sparkSession) as kept:
            looks = store(visits(index, queries, probes, [t]), "visits")
            near = _look(looks, index.of(t), index.held, k).select("qid", F.arrays_zip("d", "nid", "li").alias("near"))
            own = store(near.groupBy("qid").agg(merged), "near")
            kept.pop()
        lists = lists.unionByName(own.select("qid", F.lit(None).cast("array<double>").alias("x"), "near"))
    found = lists.groupBy("qid").agg(F.first("x", ignorenulls=True).alias("x"), merged)
    return _lists_per_row(index, queries, found, asked["n"], skip_same_id, False)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(queries, expected, met, recall) of approximate lists against exact ones, by neighbour ids."""
    ids = lambda c: F.transform(c, lambda v: v["nid"])
    a = found.select("id", ids("neighbours").alias("a"))
    b = exact.select("id", ids("neighbours").alias("b"))
    met = F.sum(F.size(F.array_intersect(F.coalesce("a", F.array().cast("array<bigint>")), "b")))
    return b.join(a, "id", "left").agg(F.count("*").alias("queries"), F.sum(F.size("b")).alias("expected"), met.alias("met")).withColumn(
        "recall", F.col("met") / F.col("expected")
    )
