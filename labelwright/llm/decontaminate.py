"""Benchmark decontamination by binary search in suffix arrays over the training words.

Every shard (a run of documents) gets a suffix array over its words, and each suffix of the
benchmark is searched in it by bisection; the neighbours of the place it falls on hold the
longest verbatim match. A suffix that does not begin with two words of some benchmark item
(or with an item of one word) can match no window, so the array leaves it out. The benchmark
is cut into blocks of a bounded size; all documents are held against each block.

Defined results: a null text has no words; a null or empty item has no window; equal rows
give equal rows; with no items nothing is hit. Other columns are ignored by ``hits`` and
kept by ``clean_rows``. Word ends are exact: a found window is compared byte by byte, so a
hash collision cannot add a hit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from labelwright.llm import arrays
from labelwright.llm.rows import packed
from labelwright.sources.scratch import store

WINDOW = 13
BLOCK_BYTES = 4 << 20

_WORD = arrays.table(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD[65:91] = True
_TAIL = np.uint32(0xFFFFFFFF)


def words(body: np.ndarray, offsets: np.ndarray):
    """Lower-cased bytes, and start, end, row and hash of each word."""
    low = _LOWER[body]
    start, end, row = arrays.spans_of(_WORD[low], offsets)
    return low, start, end, row, arrays.piece_hashes(arrays.prefix_sums(low), start, end)


class Windows:
    """The words, windows and suffixes of a block of benchmark items."""

    def __init__(self, items: list[tuple[object, str | None]], size: int = WINDOW):
        column = pa.array([(t or "").encode() for _, t in items], pa.binary())
        body, offsets = arrays.flat(column)
        low, start, end, row, hashed = words(body, offsets)
        self.size, self.ids = size, [i for i, _ in items]
        self.vocabulary, first, number = np.unique(hashed, return_index=True, return_inverse=True)
        text = low.tobytes()
        self.spelling = [text[start[i] : end[i]] for i in first]
        self.number = (number + 1).astype(np.uint32)
        self.row = row
        self.bounds = np.searchsorted(row, np.arange(len(items) + 1))
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
        left = np.zeros(len(row), bool)
        left[:-1] = row[:-1] == row[1:]
        pairs = self.number[:-1].astype(np.uint64) << np.uint64(32) | self.number[1:]
        self.pairs = np.unique(pairs[left[:-1]]) if len(row) else np.zeros(0, np.uint64)
        n_words = np.diff(self.bounds)
        self.single = np.unique(self.number[self.bounds[:-1][n_words == 1]])
        # Every suffix of every item, cut at the window; those that fill it are windows.
        self.starts = np.arange(len(row))
        there = np.minimum(self.bounds[1:][row] - self.starts, size) if len(row) else self.starts
        whole = np.minimum(n_words, size)[row] if len(row) else self.starts
        self.lengths, self.is_window = there, there == whole
        self.suffixes = _packed(self.number, self.starts, there, size)

    def __bool__(self) -> bool:
        return bool(len(self.row))


def _packed(number: np.ndarray, at: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Up to size words from each place as big-endian numbers, zero after the end."""
    step = np.arange(size)
    grid = number[np.minimum(at[:, None] + step, max(len(number) - 1, 0))] if len(at) else np.zeros((0, size), np.uint32)
    return np.where(step < lengths[:, None], grid, 0).astype(">u4")


def _keys(grid: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(grid).view(f"S{4 * grid.shape[1]}").ravel()


def shard_matches(block: Windows, body: np.ndarray, offsets: np.ndarray):
    """Row of each word, its place, and all matches of one shard.

    Matches are (item suffix, first word in the shard, words matched, is a window).
    """
    low, start, end, row, hashed = words(body, offsets)
    number = np.zeros(len(hashed), np.uint32)
    some = np.flatnonzero(block.maybe[(hashed & np.uint64(0xFFFF)).astype(np.int64)])
    if len(some):
        slot = np.minimum(np.searchsorted(block.vocabulary, hashed[some]), len(block.vocabulary) - 1)
        known = block.vocabulary[slot] == hashed[some]
        number[some[known]] = slot[known] + 1
    none = np.zeros(0, np.int64)
    place = np.flatnonzero(number)
    if len(place):
        follow = np.zeros(len(number), np.uint32)
        follow[:-1] = np.where(row[1:] == row[:-1], number[1:], 0)
        pair = number[place].astype(np.uint64) << np.uint64(32) | follow[place]
        slot = np.minimum(np.searchsorted(block.pairs, pair), max(len(block.pairs) - 1, 0))
        keep = block.pairs[slot] == pair if len(block.pairs) else np.zeros(len(place), bool)
        place = place[keep | np.isin(number[place], block.single)]
    if not len(place):
        return row, start, end, low, none, none, none, none
    last = np.searchsorted(row, row[place], "right")
    there = np.minimum(last - place, block.size)
    grid = _packed(number, place, there, block.size)
    keys = _keys(grid)
    order = np.argsort(keys, kind="stable")
    place, grid, keys = place[order], grid[order], keys[order]
    # Where each benchmark suffix falls, and how long it agrees with its two neighbours.
    at = np.searchsorted(keys, _keys(block.suffixes))
    best, where = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    for near in (at - 1, at):
        ok = (near >= 0) & (near < len(keys))
        same = grid[np.clip(near, 0, len(keys) - 1)] == block.suffixes
        same &= np.arange(block.size) < block.lengths[:, None]
        common = np.where(ok, np.logical_and.accumulate(same, axis=1).sum(axis=1), 0)
        where = np.where(common > best, near, where)
        best = np.maximum(best, common)
    item, first, length, window = [], [], [], []
    full = np.flatnonzero((best == block.lengths) & block.is_window)
    if len(full):
        low_key, high = block.suffixes[full], block.suffixes[full].copy()
        after = np.arange(block.size) >= block.lengths[full][:, None]
        high[after] = _TAIL
        begin = np.searchsorted(keys, _keys(low_key))
        stop = np.searchsorted(keys, _keys(high), "right")
        for s, a, b in zip(full, begin, stop):
            item.append(np.full(b - a, s))
            first.append(place[a:b])
            length.append(np.full(b - a, block.lengths[s]))
            window.append(np.ones(b - a, bool))
    part = np.flatnonzero((best >= 2) & ~((best == block.lengths) & block.is_window))
    item.append(part)
    first.append(place[where[part]])
    length.append(best[part])
    window.append(np.zeros(len(part), bool))
    item, first, length, window = map(np.concatenate, (item, first, length, window))
    real = _spelt_alike(block, low, start, end, number, first[window], length[window])
    ok = np.ones(len(item), bool)
    ok[window] = real
    return row, start, end, low, item[ok], first[ok], length[ok], window[ok]


def _spelt_alike(block: Windows, low, start, end, number, first, length) -> np.ndarray:
    used = np.unique(np.concatenate([np.arange(a, a + n) for a, n in zip(first, length)])) if len(first) else []
    text = low.tobytes() if len(used) else b""
    wrong = np.zeros(len(number) + 1, np.int64)
    for w in used:
        wrong[w + 1] = text[start[w] : end[w]] != block.spelling[number[w] - 1]
    wrong = np.cumsum(wrong)
    return wrong[first + length] == wrong[first]


def _hit_rows(block: Windows, column: pa.Array) -> Iterator[tuple[np.ndarray, list, list]]:
    """Per run: words per document, and per document its hit word ranges and items."""
    body, offsets = arrays.flat(column)
    for a, b in arrays.runs(offsets):
        part, at = body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        row, _, _, _, item, first, length, window = shard_matches(block, part, at)
        n_words = np.bincount(row, minlength=b - a)
        bounds = np.searchsorted(row, np.arange(b - a + 1))
        cover = np.zeros(len(row) + 1, np.int64)
        np.add.at(cover, first[window], 1)
        np.add.at(cover, first[window] + length[window], -1)
        hit = np.cumsum(cover[:-1]) > 0
        start, end, doc = arrays.spans_of(hit, bounds)
        ranges = [[] for _ in range(b - a)]
        for s, e, d in zip(start.tolist(), end.tolist(), doc.tolist()):
            ranges[d].append((s - int(bounds[d])) << 32 | (e - int(bounds[d])))
        found = [set() for _ in range(b - a)]
        for d, i in set(zip(row[first[window]].tolist(), block.row[item[window]].tolist())):
            found[d].add(block.ids[i])
        yield n_words, ranges, [sorted(x, key=str) for x in found]


def _blocks(spark: SparkSession, benchmark: DataFrame, limit: int) -> Iterator[list]:
    """Items in blocks of bounded bytes; only one block is on the driver at a time."""
    items = benchmark.select("item_id", "text").where(F.length("text") > 0)
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = max(1, -(-size // limit))
    if n == 1:
        yield [(r[0], r[1]) for r in items.collect()]
        return
    items = store(items.withColumn("block", F.expr(f"pmod(xxhash64(item_id, text), {2 * n})")), "items")
    for k in range(2 * n):
        yield [(r[0], r[1]) for r in items.where(F.col("block") == k).select("item_id", "text").collect()]


def _digest(ids: list) -> str:
    return hashlib.sha256(",".join(map(str, sorted(map(str, ids)))).encode()).hexdigest()


SCHEMA = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _verdicts(n_words: np.ndarray, ranges: list, found: list) -> list[np.ndarray | list]:
    n_hit = np.array([sum((x & 0xFFFFFFFF) - (x >> 32) for x in r) for r in ranges], np.int64)
    return [
        pa.array(n_words.astype(np.int64)),
        pa.array(n_hit),
        pa.array([len(x) for x in found], pa.int64()),
        pa.array([_digest(x) for x in found], pa.string()),
        pa.array((n_hit > 0) & (20 * n_hit >= n_words)),
    ]


def hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: words, words inside a benchmark window, items, verdict.

    A benchmark of several blocks is matched block by block and merged per document, where
    rows equal in doc_id and text count as one document.
    """
    spark = docs.sparkSession
    source = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    key = source.schema["doc_id"].dataType.simpleString()
    blocks = [spark.sparkContext.broadcast(Windows(x, size)) for x in _blocks(spark, benchmark, block_bytes)]
    if len(blocks) == 1:
        block = blocks[0]

        def verdicts(batches):
            for batch in batches:
                done = 0
                for n_words, ranges, found in _hit_rows(block.value, batch.column(1)):
                    ids = batch.column(0).slice(done, len(n_words))
                    done += len(n_words)
                    yield pa.RecordBatch.from_arrays(
                        [ids, *_verdicts(n_words, ranges, found)],
                        ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
                    )

        return source.mapInArrow(verdicts, f"doc_id {key}, {SCHEMA}")
    return _merged(docs, blocks, key)


def _merged(docs: DataFrame, blocks: list, key: str) -> DataFrame:
    source = docs.select("doc_id", F.xxhash64("text").alias("h"), F.col("text").cast("binary").alias("text"))
    each = []
    for block in blocks:

        def found_rows(batches, block=block):
            for batch in batches:
                done = 0
                for n_words, ranges, found in _hit_rows(block.value, batch.column(2)):
                    ids = [batch.column(i).slice(done, len(n_words)) for i in (0, 1)]
                    done += len(n_words)
                    yield pa.RecordBatch.from_arrays(
                        [*ids, pa.array(n_words.astype(np.int64)), pa.array(ranges, pa.list_(pa.int64())), pa.array([list(map(str, x)) for x in found], pa.list_(pa.string()))],
                        ["doc_id", "h", "n_words", "ranges", "items"],
                    )

        each.append(source.mapInArrow(found_rows, f"doc_id {key}, h long, n_words long, ranges array<long>, items array<string>"))
    rows = each[0]
    for x in each[1:]:
        rows = rows.unionByName(x)
    rows = store(rows, "hits")
    words_in = lambda x: F.sequence(F.shiftright(x, 32), x.bitwiseAND(0xFFFFFFFF) - 1)
    joined = (
        rows.where(F.size("ranges") > 0)
        .groupBy(F.col("doc_id").alias("d"), F.col("h").alias("g"))
        .agg(
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
            F.array_distinct(F.flatten(F.collect_set("ranges"))).alias("ranges"),
        )
        .select("d", "g", F.array_sort("items").alias("items"), F.size(F.array_distinct(F.flatten(F.transform("ranges", words_in)))).cast("long").alias("n_hit"))
    )
    base = docs.select("doc_id", F.xxhash64("text").alias("h")).join(
        rows.groupBy("doc_id", "h").agg(F.max("n_words").alias("n_words")).withColumnRenamed("doc_id", "e").withColumnRenamed("h", "f"),
        F.col("doc_id").eqNullSafe(F.col("e")) & (F.col("h") == F.col("f")),
    )
    out = base.join(joined, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def longest_matches(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per shard and benchmark suffix the longest verbatim match (two words or more) and where it is."""
    spark = docs.sparkSession
    source = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    key = source.schema["doc_id"].dataType.simpleString()
    item_key = benchmark.schema["item_id"].dataType
    out = None
    for items in _blocks(spark, benchmark, block_bytes):
        block = spark.sparkContext.broadcast(Windows(items, size))

        def found(batches, block=block):
            for batch in batches:
                body, offsets = arrays.flat(batch.column(1))
                for a, b in arrays.runs(offsets):
                    row, start, end, low, item, first, length, _ = shard_matches(
                        block.value, body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                    )
                    at = offsets[a : b + 1] - offsets[a]
                    doc = row[first]
                    v = block.value
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(doc + a)),
                            pa.array([str(v.ids[i]) for i in v.row[item]], pa.string()),
                            pa.array((item - v.bounds[v.row[item]]).astype(np.int64)),
                            pa.array(start[first] - at[doc]),
                            pa.array((end[first + length - 1] if len(first) else first) - at[doc]),
                            pa.array(length.astype(np.int64)),
                        ],
                        ["doc_id", "item_id", "item_word", "byte_start", "byte_end", "n_words"],
                    )

        part = source.mapInArrow(found, f"doc_id {key}, item_id string, item_word long, byte_start long, byte_end long, n_words long")
        out = part if out is None else out.unionByName(part)
    return out.withColumn("item_id", F.col("item_id").cast(item_key))


def clean_rows(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of docs that the rule does not call contaminated, all columns kept."""
    texts = docs.select("doc_id", "text")
    keyed = texts.select(F.struct("doc_id", F.xxhash64("text").alias("h")).alias("doc_id"), "text")
    bad = hits(keyed, benchmark, size).where("contaminated").select("doc_id.*").distinct()
    bad = bad.select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"))
    match = F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("_row.text") == F.col("_h"))
    return packed(docs).join(bad, match, "left_anti").select("_row.*")
