"""Exact k nearest neighbours as a Spark join.

Plan of the join:

1. Rows with equal features are collapsed: only the first k+1 ids of a point can
   be among anyone's k nearest, and all copies share one search. The limit is
   applied before the shuffle, so a point that holds a third of all rows costs
   no more than any other.
2. Space is cut into blocks by a bounded sample; in many dimensions the space is
   that of the leading components. A block with too many points is cut again by
   a sample of its own rows, and so on, so the points of a block stay bounded
   whatever the number of rows. The deeper cuts are rows of a table, never held
   together.
3. Each query searches its own block, which bounds the distance of its k-th
   neighbour. Then it visits only those other blocks that come closer than that.
4. The lists of a query's blocks are merged by one aggregation.

Blocks cut for fewer points than that are packed into bundles of neighbouring blocks, and queries
visit bundles: the rows that are written and shuffled do not grow with the number of blocks. Inside
a bundle the blocks that none of a group's queries reach are left out.

No pair of blocks is compared unless a query's bound requires it, and no task
emits more than k rows per query. What the driver holds is bounded by the first
sample; counts per block are tables.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from labelwright.functions.labels import literal_array
from labelwright.functions.local import local_table
from labelwright.functions.scaling import fit_scaler, raw_vector
from labelwright.operators.blocks import (
    FEW_DIMS,
    SAMPLE_BYTES,
    SAMPLE_PER_CELL,
    Cells,
    View,
    build_cells,
    fit_view,
    nearest_in_block,
)
from labelwright.sources.scratch import small, store
from labelwright.spec import LabelledSpec, Params

NEIGHBOURS = "array<struct<d:double,nid:bigint,label:string>>"
DECIMALS = 9
# Coordinate differences per group: enough groups for all cores, but as few copies
# of a block's points as the cores allow.
LEAST_WORK = 1 << 22
MOST_WORK = 1 << 32
FEWEST_QUERIES = 128
MOST_QUERIES = 4096
PER_CELL = 512
PER_CELL_MANY_DIMS = 4096
# A block is crowded from this many times the rows that a cell is cut for.
CROWDED = 4
LEVEL_SAMPLE = 16_384
GROUP_ROWS = 65_536
# Bytes that the pairs of queries and cells under way in a task may take.
PAIR_BYTES = 64 << 20
# Points of a bundle of small blocks, and coordinate differences per group there.
BUNDLE_ROWS = 16_384
BUNDLE_WORK = 1 << 34
HOT_KEYS = 1000
HOT_ROWS = 100_000


def feature_vectors(
    df: DataFrame, spec: LabelledSpec, normalize: bool = Params.normalize, scaler=None
) -> DataFrame:
    """(id, x, label) with standardised or raw features; rows without a label are left out."""
    spec.check(df)
    _whole_number_id(df, spec.id_col)
    labelled = df.where(F.col(spec.label_col).isNotNull())
    fitted = scaler or fit_scaler(labelled, spec.feature_cols)
    x = fitted.vector() if normalize else raw_vector(spec.feature_cols)
    return labelled.select(
        F.col(spec.id_col).cast("bigint").alias("id"),
        _plain(x).alias("x"),
        F.col(spec.label_col).cast("string").alias("label"),
    )


def array_vectors(df: DataFrame, id_col: str, array_col: str, label_col: str) -> DataFrame:
    """(id, x, label) from a column that already holds the feature array."""
    _whole_number_id(df, id_col)
    return df.where(F.col(label_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"),
        _plain(F.col(array_col).cast("array<double>")).alias("x"),
        F.col(label_col).cast("string").alias("label"),
    )


def _plain(x: Column) -> Column:
    """Negative zero becomes zero, so that equal vectors are equal as keys too."""
    return F.transform(x, lambda v: v + F.lit(0.0))


def _unusable() -> Column:
    return F.exists(
        "x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    )


def _whole_number_id(df: DataFrame, id_col: str) -> None:
    if not isinstance(df.schema[id_col].dataType, T.IntegralType):
        raise ValueError(f"the neighbour search needs a whole-number id, not {id_col!r}")


@dataclass(frozen=True)
class Collapsed:
    """Points of a table: (id, x, li, head), at most k+1 ids of equal ones; ``distinct`` if none are equal."""

    points: DataFrame
    labels: tuple[str, ...]
    rows: int
    dims: int
    held: int
    distinct: bool


def collapse(vectors: DataFrame, k: int, max_classes: int = Params.max_classes) -> Collapsed:
    """Check (id, x, label) and keep of equal points what can be among the k nearest."""
    if k < 1:
        raise ValueError("k must be at least 1")
    shapes = (
        vectors.groupBy("label")
        .agg(
            F.count("*").alias("n"),
            F.min(F.size("x")).alias("dims"),
            F.max(F.size("x")).alias("widest"),
            F.count_if(_unusable()).alias("nulls"),
        )
        .limit(max_classes + 1)
        .collect()
    )
    if len(shapes) > max_classes:
        raise ValueError(f"more than {max_classes} classes")
    rows = sum(r["n"] for r in shapes)
    if rows < k:
        raise ValueError(f"{k} neighbours need at least {k} rows, found {rows}")
    dims = shapes[0]["dims"]
    if any(r["dims"] != dims or r["widest"] != dims or r["nulls"] for r in shapes):
        raise ValueError("all feature vectors must have the same length and finite values")
    labels = tuple(sorted(r["label"] for r in shapes))
    # The hash leads the sort key, because numbers sort faster than arrays.
    by_point = Window.partitionBy(F.xxhash64("x"), "x").orderBy("id")
    index = F.array_position(literal_array(list(labels)), F.col("label")) - 1
    points = store(
        vectors.withColumn("_n", F.row_number().over(by_point))
        .where(F.col("_n") <= k + 1)
        .select("id", "x", index.cast("int").alias("li"), (F.col("_n") == 1).alias("head")),
        "points",
    )
    held = points.agg(F.count("*").alias("points"), F.count_if("head").alias("heads")).collect()[0]
    return Collapsed(points, labels, rows, dims, held["points"], held["heads"] == rows)


@dataclass(frozen=True)
class Bundles:
    """Neighbouring cells of the first cut that are visited together; one too large is dealt into parts by a hash."""

    of: np.ndarray
    parts: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.parts) - self.parts

    def home(self, cell: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Number of the part of a bundle that each row lies in."""
        bundle = self.of[cell]
        mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        return self.starts[bundle] + (mixed % self.parts[bundle].astype(np.uint64)).astype(np.int64)

    def visited(self, who: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, part of a bundle), each once, from pairs (row, cell)."""
        both = np.unique(who * len(self.parts) + self.of[cell])
        who, bundle = np.divmod(both, len(self.parts))
        n = self.parts[bundle]
        part = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(who, n), np.repeat(self.starts[bundle], n) + part


def bundles(cells: Cells | None, held: np.ndarray, most: int) -> Bundles:
    """The largest subtrees of the cells with at most that many of the ``held`` points."""
    if cells is None:
        return Bundles(np.zeros(1, np.int64), np.maximum(1, -(-held // most)))
    total = np.where(cells.axis < 0, held[cells.cell], 0)
    for node in range(len(total) - 1, -1, -1):
        if cells.axis[node] >= 0:
            total[node] = total[cells.child[node]].sum()
    of, parts, todo = np.zeros(cells.count, np.int64), [], [0]
    while todo:
        node = todo.pop()
        if cells.axis[node] >= 0 and total[node] > most:
            todo.extend(cells.child[node])
            continue
        inside = [node]
        while inside:
            node_ = inside.pop()
            if cells.axis[node_] < 0:
                of[cells.cell[node_]] = len(parts)
            else:
                inside.extend(cells.child[node_])
        parts.append(max(1, -(-int(total[node]) // most)))
    return Bundles(of, np.array(parts, np.int64))


@dataclass(frozen=True)
class NeighbourIndex:
    """Collapsed points of a table and the blocks they lie in; serves any number of searches.

    ``points`` is (id, x, li, head, block), ``sizes`` (block, held), and each of ``deeper``
    a table (block, cut) of the blocks that were cut again.
    """

    points: DataFrame
    labels: tuple[str, ...]
    k: int
    rows: int
    dims: int
    distinct: bool
    view: View
    cells: Cells | None
    sizes: DataFrame
    blocks: int
    deeper: list[DataFrame] = field(default_factory=list)
    bundles: Bundles | None = None


def build_index(
    vectors: DataFrame, k: int = Params.k, max_classes: int = Params.max_classes, per_cell: int | None = None
) -> NeighbourIndex:
    """Index (id, x, label) for searches of up to k neighbours.

    ``per_cell`` is the number of points that cells are cut for, by default after the dimensions.
    """
    base = collapse(vectors, k, max_classes)
    dims, points = base.dims, base.points
    usual = PER_CELL if dims <= FEW_DIMS else PER_CELL_MANY_DIMS
    per_cell = per_cell or usual
    view, cells = _cut_space(points, base.held, dims, k + 1, per_cell)
    located = points.mapInArrow(_home(points, view, cells), POINT + ", block bigint")
    deeper: list[DataFrame] = []
    while True:
        sizes = store(located.groupBy("block").agg(F.count("*").alias("held")), "sizes")
        crowded = sizes.where(F.col("held") > CROWDED * per_cell)
        if crowded.isEmpty():
            break
        deeper.append(_cuts(located, crowded, view, k + 1, per_cell, len(deeper)))
        located = store(_through(located, deeper[-1], _relocate(view), POINT + ", block bigint", "id"), "located")
    packed = None
    if per_cell < usual:
        # At most one count per cell of the first cut.
        home = points.mapInArrow(_home(points, view, cells), POINT + ", block bigint").groupBy("block").count().collect()
        held = np.zeros(1 if cells is None else cells.count, np.int64)
        for cell, n in home:
            held[cell] = n
        packed = bundles(cells, held, BUNDLE_ROWS)
    return NeighbourIndex(
        located, base.labels, k, base.rows, dims, base.distinct, view, cells, sizes, sizes.count(), deeper, packed
    )


def nearest_neighbours(
    vectors: DataFrame,
    k: int = Params.k,
    queries: DataFrame | None = None,
    max_classes: int = Params.max_classes,
    per_cell: int | None = None,
) -> DataFrame:
    """(id, label, neighbours) for every row: its k nearest other rows, nearest first.

    With ``queries`` (id, x, label) those rows are searched among ``vectors`` instead.
    Both are read more than once: store them first if they are costly to compute.
    """
    index = build_index(vectors, k, max_classes, per_cell)
    if queries is not None:
        return search_index(index, queries)
    if index.rows <= k:
        raise ValueError(f"{k} neighbours need at least {k + 1} rows, found {index.rows}")
    heads = index.points.where("head").select(F.col("id").alias("qid"), "x", "block")
    found = _search(index, heads, k + 1)
    return _lists_per_row(index, vectors, found, index.rows, True, index.distinct)


def search_index(
    index: NeighbourIndex, queries: DataFrame, skip_same_id: bool = False
) -> DataFrame:
    """Neighbours of other rows (id, x, label); any further column is kept.

    ``skip_same_id`` is for rows that may be in the index themselves.
    """
    other = (F.size("x") != index.dims) | _unusable()
    asked = queries.agg(F.count("*").alias("n"), F.count_if(other).alias("other")).collect()[0]
    if asked["other"]:
        raise ValueError(f"queries need {index.dims} finite values each")
    heads = queries.groupBy("x").agg(F.min("id").alias("qid")).select("qid", "x")
    heads = heads.mapInArrow(_home(heads, index.view, index.cells), QUERY + ", block bigint")
    for cuts in index.deeper:
        heads = store(_through(store(heads, "heads"), cuts, _relocate(index.view), QUERY + ", block bigint", "qid"), "heads")
    found = _search(index, heads, index.k + 1 if skip_same_id else index.k)
    return _lists_per_row(index, queries, found, asked["n"], skip_same_id, False)


def _lists_per_row(
    index: NeighbourIndex,
    rows: DataFrame,
    found: DataFrame,
    n: int,
    skip_same_id: bool,
    distinct: bool,
) -> DataFrame:
    """One list per row; where no two rows share a point, the query id is the row id."""
    if distinct:
        joined = rows.drop("x").join(found.select(F.col("qid").alias("id"), "near"), "id")
    else:
        joined = _join_on_point(rows, found.select("x", "near"), n)
    near = F.col("near")
    if skip_same_id:
        near = F.filter(near, lambda v: v["nid"] != F.col("id"))
    vocab = literal_array(list(index.labels))
    named = F.transform(
        F.slice(near, 1, index.k),
        lambda v: F.struct(
            v["d"].alias("d"),
            v["nid"].alias("nid"),
            F.element_at(vocab, v["li"] + 1).alias("label"),
        ),
    )
    kept = [c for c in rows.columns if c not in ("id", "x", "label")]
    return joined.select("id", "label", named.alias("neighbours"), *kept)


def _join_on_point(rows: DataFrame, lists: DataFrame, n: int) -> DataFrame:
    """Give every row the list of its point.

    A point shared by very many rows is joined by broadcast: at most HOT_KEYS
    points can hold more than a thousandth of the rows each.
    """
    limit = max(HOT_ROWS, n // HOT_KEYS)
    hot = []
    if n > limit:
        hot = (
            rows.groupBy("x").count().where(F.col("count") > limit).select("x").collect()
        )
    rows = rows.withColumn("_h", F.xxhash64("x"))
    lists = lists.withColumn("_h", F.xxhash64("x"))
    if not hot:
        return rows.join(lists, ["_h", "x"])
    lists = store(lists, "lists")
    keys = local_table(rows.sparkSession, [(r["x"],) for r in hot], "x array<double>")
    few = F.broadcast(keys)
    usual = rows.join(few, "x", "left_anti").join(lists, ["_h", "x"])
    many = rows.join(F.broadcast(lists.join(few, "x", "left_semi")), ["_h", "x"])
    return usual.unionByName(many)


def _search(index: NeighbourIndex, heads: DataFrame, k: int) -> DataFrame:
    """(qid, x, near): the k nearest points of each head (qid, x, block)."""
    near = F.arrays_zip("d", "nid", "li").alias("near")
    if index.bundles is not None:
        heads = _in_bundles(heads.select("qid", "x", "block"), index, "qid")
    first = _visit(heads.select("qid", "x", F.lit(float("inf")).alias("reach"), "block"), index, k)
    if index.blocks == 1:
        return first.select("qid", "x", near)
    first = store(first, "first")
    # A block may hold fewer than k points; then it bounds nothing.
    reach = F.when(F.size("d") >= k, F.element_at("d", -1)).otherwise(F.lit(float("inf")))
    second = _visit(store(_abroad(index, first.select("qid", "x", reach.alias("reach"), "block"), index.bundles), "abroad"), index, k)
    lists = first.select("qid", "x", near).unionByName(second.select("qid", F.lit(None).cast("array<double>").alias("x"), near))
    merged = F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k)
    return lists.groupBy("qid").agg(F.first("x", ignorenulls=True).alias("x"), merged.alias("near"))


def _cut_space(points: DataFrame, total: int, dims: int, k: int, per_cell: int) -> tuple[View, Cells | None]:
    """View and cells from a hashed sample whose size in bytes is bounded whatever the table."""
    if total <= 2 * per_cell:
        return View(), None
    rows = min(total * SAMPLE_PER_CELL // per_cell, SAMPLE_BYTES // (8 * dims))
    share = int(rows / total * (1 << 30)) + 1
    sample = (
        points.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share).select("x").toArrow()
    )
    x = _matrix(sample.column("x"))
    view = fit_view(x)
    if sample.num_rows < 2 * max(k, SAMPLE_PER_CELL):
        return view, None
    return view, build_cells(view(x), k)


def _cuts(located: DataFrame, crowded: DataFrame, view: View, k: int, per_cell: int, depth: int) -> DataFrame:
    """(block, cut) of the crowded blocks, each from a bounded sample of its own points.

    Points that differ, but not in the view, cannot be cut there; their block is dealt into
    parts by a hash, and all parts are visited together.
    """
    wanted = F.least(F.col("held") * SAMPLE_PER_CELL / per_cell, F.lit(float(LEVEL_SAMPLE))) / F.col("held")
    inside = located.join(small(crowded, 16), "block")
    sample = inside.where(F.pmod(F.xxhash64("id", F.lit(depth)), F.lit(1 << 30)) < wanted * (1 << 30))
    shared = located.sparkSession.sparkContext.broadcast(view)

    def cut(key, rows):
        cells = build_cells(shared.value(_matrix(rows.column("x"))), k)
        blob = pickle.dumps(cells) if cells.count > 1 else None
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "cells": pa.array([blob], pa.binary())})

    trees = sample.select("block", "x").groupBy("block").applyInArrow(cut, "block bigint, cells binary")
    parts = F.least(F.lit(4096), F.ceil(F.col("held") / per_cell)).cast("int")
    return store(crowded.join(trees, "block", "left").select("block", "cells", parts.alias("parts")), "cuts")


Apply = Callable[[pa.Table, "Cells | int"], pa.Table]


def _through(rows: DataFrame, cuts: DataFrame, apply: Apply, schema: str, key: str) -> DataFrame:
    """Rows of blocks that were cut get their blocks after the cut; the others stay.

    The rows of one block meet its cut in groups of bounded size.
    """
    names = small(cuts.select("block"), 8)
    inside = rows.join(names, "block", "left_semi")
    turns = store(inside.groupBy("block").agg(F.ceil(F.count("*") / GROUP_ROWS).cast("int").alias("turns")), "turns")
    spread = inside.join(small(turns, 16), "block").withColumn("turn", F.pmod(F.xxhash64(key), F.col("turns")).cast("int"))
    copies = cuts.join(turns, "block").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
    columns = rows.columns
    wanted = pa.schema(_arrow(schema))

    def step(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return wanted.empty_table()
        blob, parts = right.column("cells")[0].as_py(), right.column("parts")[0].as_py()
        out = apply(left.select(columns), pickle.loads(blob) if blob is not None else parts)
        return pa.Table.from_arrays([out.column(c).combine_chunks() for c in wanted.names], schema=wanted)

    moved = spread.select(*columns, "turn").groupBy("block", "turn").cogroup(copies.select(F.col("block").alias("block"), "turn", "cells", "parts").groupBy("block", "turn"))
    return rows.join(names, "block", "left_anti").select(columns).unionByName(moved.applyInArrow(step, schema).select(columns))


def _arrow(schema: str) -> list[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_schema

    return list(to_arrow_schema(T.StructType.fromDDL(schema)))


POINT = "id bigint, x array<double>, li int, head boolean"
QUERY = "qid bigint, x array<double>"


def _below(block: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Number of a part of a block. Should two numbers be equal, their points share a block."""
    h = (block.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0x9E3779B97F4A7C15) + part.astype(np.uint64)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(32))).view(np.int64)


def _relocate(view: View) -> Apply:
    def apply(rows: pa.Table, cut: Cells | int) -> pa.Table:
        block = rows.column("block").to_numpy()
        if isinstance(cut, int):
            ids = rows.column("id" if "id" in rows.column_names else "qid").to_numpy()
            part = _hashed(ids, cut)
        else:
            part = cut.locate(view(_matrix(rows.column("x"))))
        return rows.set_column(rows.column_names.index("block"), "block", pa.array(_below(block, part)))

    return apply


def _hashed(ids: np.ndarray, parts: int) -> np.ndarray:
    mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    return (mixed % np.uint64(parts)).astype(np.int64)


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if len(flat) == 0:
        return np.zeros((0, 0))
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


Batches = Iterator[pa.RecordBatch]
Step = Callable[[Batches], Batches]


def _home(rows: DataFrame, view: View, cells: Cells | None) -> Step:
    """Adds the block of the first cut that a row lies in."""
    shared = rows.sparkSession.sparkContext.broadcast((view, cells))

    def step(batches: Batches) -> Batches:
        view, cells = shared.value
        for batch in batches:
            x = _matrix(batch.column("x"))
            block = np.zeros(len(x), np.int64) if cells is None else cells.locate(view(x))
            yield batch.append_column("block", pa.array(block))

    return step


VISIT = QUERY + ", reach double, home bigint, block bigint"


def _near_cells(view: View, cells: Cells, x: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, cell) where the cell may hold a point within the row's reach."""
    who, cell = [], []
    # A query may stand before every cell at once, with a gap per axis.
    some = int(min(512, max(1, PAIR_BYTES // (32 * cells.count * cells.low.shape[1]))))
    for start in range(0, len(x), some):
        part = x[start : start + some]
        far = reach[start : start + some] + 2.0 * 10.0**-DECIMALS + view.slack(part)
        w, c = cells.within(view(part), far)
        who.append(w + start)
        cell.append(c)
    return np.concatenate([np.zeros(0, np.int64), *who]), np.concatenate([np.zeros(0, np.int64), *cell])


def _in_bundles(rows: DataFrame, index: NeighbourIndex, key: str) -> DataFrame:
    """Rows with their bundle for a block; the block itself is ``inner``."""
    shared = rows.sparkSession.sparkContext.broadcast((index.view, index.cells, index.bundles))

    def step(batches: Batches) -> Batches:
        view, cells, packed = shared.value
        for batch in batches:
            x, ids = _matrix(batch.column("x")), batch.column(key).to_numpy()
            cell = np.zeros(len(x), np.int64) if cells is None or not len(x) else cells.locate(view(x))
            number = pa.array(packed.home(cell, ids))
            columns = [number if c == "block" else batch.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("block")], [*batch.schema.names, "inner"])

    return rows.mapInArrow(step, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", inner bigint")


def _reached(view: View, q: np.ndarray, reach: np.ndarray, p: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The points in blocks that some query reaches; a block is the box around its points in the view."""
    if np.isinf(reach).any():
        return np.arange(len(p))
    order = np.argsort(block, kind="stable")
    starts = np.flatnonzero(np.append(True, np.diff(block[order]) != 0))
    seen, asked = view(p)[order], view(q)
    low, high = np.minimum.reduceat(seen, starts, axis=0), np.maximum.reduceat(seen, starts, axis=0)
    far = reach + 2.0 * 10.0**-DECIMALS + view.slack(q) + view.slack(p).max()
    near = np.zeros(len(starts), bool)
    some = int(max(1, PAIR_BYTES // (32 * len(starts) * seen.shape[1])))
    for start in range(0, len(q), some):
        left = np.flatnonzero(~near)
        part = asked[start : start + some, None]
        gap = np.maximum(np.maximum(low[left] - part, part - high[left]), 0.0)
        near[left] = (np.sqrt((gap * gap).sum(axis=2)) <= far[start : start + some, None]).any(axis=0)
        if near.all():
            return np.arange(len(p))
    return np.sort(order[np.repeat(near, np.diff(np.append(starts, len(p))))])


def _abroad(index: NeighbourIndex, bounded: DataFrame, packed: Bundles | None = None) -> DataFrame:
    """Each query (qid, x, reach, block) with every other block, or bundle, that may hold a closer point."""
    shared = bounded.sparkSession.sparkContext.broadcast((index.view, index.cells))

    def first(batches: Batches) -> Batches:
        view, cells = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            some = 512 if cells is None else int(min(512, max(1, PAIR_BYTES // (16 * cells.count))))
            for start in range(0, batch.num_rows, some):
                piece = batch.slice(start, some)
                x, reach = _matrix(piece.column("x")), piece.column("reach").to_numpy()
                if cells is None:
                    who, cell = np.arange(len(x)), np.zeros(len(x), dtype=np.int64)
                else:
                    who, cell = _near_cells(view, cells, x, reach)
                if packed is not None:
                    who, cell = packed.visited(who, cell)
                # Each pair carries its query's columns.
                pairs = max(1, PAIR_BYTES // (8 * (x.shape[1] + 5)))
                for low in range(0, len(who), pairs):
                    taken = piece.select(["qid", "x", "reach", "block"]).take(pa.array(who[low : low + pairs]))
                    yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(cell[low : low + pairs])], ["qid", "x", "reach", "home", "block"])

    def deeper(rows: pa.Table, cut: Cells | int) -> pa.Table:
        x, reach = _matrix(rows.column("x")), rows.column("reach").to_numpy()
        if isinstance(cut, int):
            who, part = np.repeat(np.arange(len(x)), cut), np.tile(np.arange(cut), len(x))
        else:
            who, part = _near_cells(shared.value[0], cut, x, reach)
        taken = rows.take(pa.array(who))
        block = _below(taken.column("block").to_numpy(), part)
        return taken.set_column(taken.column_names.index("block"), "block", pa.array(block))

    pairs = bounded.mapInArrow(first, VISIT)
    for cuts in index.deeper if packed is None else []:
        pairs = _through(store(pairs, "pairs"), cuts, deeper, VISIT, "qid")
    return pairs.where(F.col("block") != F.col("home")).select("qid", "x", "reach", "block")


def _visit(asked: DataFrame, index: NeighbourIndex, k: int) -> DataFrame:
    """Search the block of each query (qid, x, reach, block).

    Gives one row per query and block with the k best points. Queries of one block
    are dealt over as many groups as keep a group small, and the block's points are
    copied to each of them.
    """
    points, sizes, view = index.points.select("id", "x", "li", "block"), index.sizes, None
    most_work, most_queries, columns = MOST_WORK, MOST_QUERIES, ["id", "x", "li", "block"]
    if index.bundles is not None:
        points, view, columns = _in_bundles(points, index, "id"), index.view, [*columns, "inner"]
        sizes = points.groupBy("block").agg(F.count("*").alias("held"))
        most_work, most_queries = BUNDLE_WORK, BUNDLE_ROWS
    counts = asked.groupBy("block").agg(F.count("*").alias("n")).join(sizes, "block")
    counts = store(counts, "counts")
    context = asked.sparkSession.sparkContext
    cost = F.col("n") * F.col("held").cast("double")
    work, blocks = counts.agg(F.sum(cost), F.count("*")).first()
    goal = min(max((work or 0.0) * index.dims / (4 * context.defaultParallelism), LEAST_WORK), most_work)
    at_once = F.greatest(F.lit(FEWEST_QUERIES), F.least(F.lit(most_queries), F.floor(F.lit(goal) / (F.col("held") * index.dims))))
    groups = small(counts.select("block", F.ceil(F.col("n") / at_once).cast("int").alias("groups")), 16, rows=blocks)
    scale = 10.0**DECIMALS

    def search(key, asked: pa.Table, held: pa.Table) -> pa.Table:
        if asked.num_rows == 0 or held.num_rows == 0:
            return _RESULT.empty_table()
        held = held.sort_by("id")
        if view is not None:
            blocks = held.column("inner").to_numpy()
            held = held.take(pa.array(_reached(view, _matrix(asked.column("x")), asked.column("reach").to_numpy(), _matrix(held.column("x")), blocks)))
        if not held.num_rows:
            return _RESULT.empty_table()
        ids = held.column("id").to_numpy()
        row, col, dist = nearest_in_block(
            _matrix(asked.column("x")),
            asked.column("reach").to_numpy(),
            _matrix(held.column("x")),
            ids,
            k,
            scale,
        )
        who, size = np.unique(row, return_counts=True)
        ends = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
        taken = asked.take(pa.array(who))
        lists = [
            pa.ListArray.from_arrays(ends, pa.array(v))
            for v in (dist, ids[col], held.column("li").to_numpy()[col])
        ]
        known = [taken.column(c).combine_chunks() for c in ("qid", "x", "block")]
        return pa.Table.from_arrays([*known, *lists], schema=_RESULT)

    turn = F.pmod(F.xxhash64("qid"), F.col("groups")).cast("int").alias("turn")
    dealt = asked.join(groups, "block").select("qid", "x", "reach", "block", turn)
    # Both sides may come from the points; a cogroup needs columns of its own on each.
    copied = points.join(groups, "block").select(
        *[F.col(c).alias(c) for c in columns], F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("turn")
    )
    return (
        dealt.groupBy("block", "turn")
        .cogroup(copied.groupBy("block", "turn"))
        .applyInArrow(
            search,
            "qid bigint, x array<double>, block bigint, "
            "d array<double>, nid array<bigint>, li array<int>",
        )
    )


_RESULT = pa.schema(
    [
        ("qid", pa.int64()),
        ("x", pa.list_(pa.float64())),
        ("block", pa.int64()),
        ("d", pa.list_(pa.float64())),
        ("nid", pa.list_(pa.int64())),
        ("li", pa.list_(pa.int32())),
    ]
)
