"""Removal of byte strings that occur twice anywhere, by suffix arrays over shards.

All windows of ``length`` bytes are judged on the input, so what matters is which of them are
equal. A window belongs to the smallest hash of the 64-byte grams in it; equal windows share
it, so neighbouring windows with the same smallest hash make a segment, and segments are dealt
out by that hash. Equal segments are collapsed to one with a count: all their windows repeat.
What is left are hashes with several different segments, or with a segment that holds its gram
twice. Their bytes are fetched, packed into
shards, and each shard gets a suffix array by two-stage sorting: only suffixes smaller than
their successors are sorted directly, the others are induced by scans over the buckets of
first bytes. Adjacent common prefixes of at least ``length`` are the repeats.

A hash that a great many different segments share (``HOT`` or more, as at the edges of a
passage that many documents hold) would make a shard of any size. Its windows are first
counted by the hash of the whole window, which needs no gathering, and only the repeats go on.

Documents are addressed by id and two hashes of their text: rows equal in both are the same
bytes, and each of them counts as an occurrence. Defined results: null is the empty text;
texts shorter than the window keep everything.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from labelwright.llm import arrays
from labelwright.sources.scratch import store

LENGTH = 400
GRAM = 64
HOT = 512
SHARD_BYTES = 1 << 19


def _sliding(values: np.ndarray, width: int, pick, fill: int) -> np.ndarray:
    """Smallest or largest of every width neighbours, from running ones of blocks."""
    size = -(-len(values) // width) * width
    padded = np.full(size, np.uint64(fill))
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    before = pick.accumulate(blocks, axis=1).ravel()
    after = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return pick(after[:count], before[width - 1 : width - 1 + count])


def _segments(body: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Row, first window, windows, smallest gram hash, content hash of segments, and whether
    the gram stands in it twice (only then can a segment repeat a window of its own)."""
    none = np.zeros(0, np.int64)
    n_windows = np.maximum(np.diff(offsets) - length + 1, 0)
    if not n_windows.sum():
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(bool)
    sums = arrays.prefix_sums(body)
    at = np.arange(len(body) - gram + 1)
    grams = arrays.piece_hashes(sums, at, at + gram)
    width = length - gram + 1
    smallest = _sliding(grams, width, np.minimum, (1 << 64) - 1)
    row = np.repeat(np.arange(len(n_windows)), n_windows)
    first = np.repeat(offsets[:-1] - np.concatenate([[0], np.cumsum(n_windows)[:-1]]), n_windows)
    start = first + np.arange(len(row))
    key = smallest[start]
    new = np.ones(len(start), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    n_in = np.diff(np.append(begin, len(start)))
    a, key = start[begin], key[begin]
    content = arrays.piece_hashes(sums, a, a + n_in + length - 1)
    # Places that are the smallest of some window; windows over row ends do not count.
    inside = np.zeros(len(smallest) + 2 * (width - 1), np.uint64)
    inside[start + width - 1] = smallest[start]
    chosen = np.flatnonzero(grams == _sliding(inside, width, np.maximum, 0)[: len(grams)])
    low, high = np.searchsorted(chosen, a), np.searchsorted(chosen, a + n_in + width - 1)
    owner = np.repeat(np.arange(len(a)), high - low)
    which = np.arange(len(owner)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[owner]
    times = np.bincount(owner[grams[chosen[which]] == key[owner]], minlength=len(a))
    return row[begin], a - offsets[row[begin]], n_in, key, content, times > 1


def _window_hashes(raw: bytes, length: int) -> np.ndarray:
    body = np.frombuffer(raw, np.uint8)
    sums = arrays.prefix_sums(body)
    at = np.arange(len(body) - length + 1)
    return arrays.piece_hashes(sums, at, at + length)


def _words8(body: np.ndarray) -> np.ndarray:
    """The eight bytes from every place as one number; zero after the end."""
    out = np.zeros(len(body), np.uint64)
    padded = np.concatenate([body, np.zeros(8, np.uint8)]).astype(np.uint64)
    for k in range(8):
        out = out << np.uint64(8) | padded[k : k + len(body)]
    return out


def two_stage_order(body: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of at least their first depth bytes.

    Suffixes smaller than their successors are sorted directly. Every other one is larger
    than its successor, so it is met when the scan reaches the successor and takes the next
    free place of its bucket. Within a bucket the induced suffixes come before the direct ones.
    """
    n = len(body)
    if not n:
        return np.zeros(0, np.int64)
    # Smaller than the successor: at the next change of byte, the byte goes up.
    up = np.zeros(n, bool)
    change = np.flatnonzero(body[:-1] != body[1:])
    if len(change):
        rises = body[change] < body[change + 1]
        to = np.searchsorted(change, np.arange(n))
        ok = to < len(change)
        up[ok] = rises[to[ok]]
    direct = _sorted_directly(body, np.flatnonzero(up), depth)
    sizes = np.bincount(body, minlength=256)
    ends = np.cumsum(sizes)
    heads = (ends - sizes).copy()
    order = np.zeros(n, np.int64)
    byte = body[direct]
    n_direct = np.bincount(byte, minlength=256)
    place = ends - n_direct
    order[np.repeat(place - np.concatenate([[0], np.cumsum(n_direct)[:-1]]), n_direct) + np.arange(len(direct))] = direct

    def induce(found: np.ndarray) -> None:
        previous = found[found > 0] - 1
        previous = previous[~up[previous]]
        if len(previous):
            to = body[previous]
            by = np.argsort(to, kind="stable")
            counts = np.bincount(to, minlength=256)
            spots = np.repeat(heads - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(len(previous))
            order[spots] = previous[by]
            heads[:] += counts

    # The last suffix is larger than the empty one after it, which comes first of all.
    order[heads[body[n - 1]]] = n - 1
    heads[body[n - 1]] += 1
    for b in np.flatnonzero(sizes):
        done = ends[b] - sizes[b]
        while done < heads[b]:
            upto = int(heads[b])
            induce(order[done:upto])
            done = upto
        induce(order[place[b] : ends[b]])
    return order


def _sorted_directly(body: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """Order of the wanted suffixes: by numbers of eight bytes first, ties by their bytes."""
    words = _words8(body)
    wanted = wanted[np.argsort(words[wanted], kind="stable")]
    key = words[wanted]
    same = key[1:] == key[:-1]
    for k in (8, 16):
        tied = np.zeros(len(wanted), bool)
        tied[1:] = same
        tied[:-1] |= same
        at = np.flatnonzero(tied)
        if not len(at):
            return wanted
        group = np.cumsum(np.append(True, ~same))[at]
        inside = wanted[at]
        more = np.where(inside + k < len(body), words[np.minimum(inside + k, len(body) - 1)], 0)
        wanted[at] = inside[np.lexsort((more, group))]
        new = np.zeros(len(wanted), np.uint64)
        new[at] = np.where(wanted[at] + k < len(body), words[np.minimum(wanted[at] + k, len(body) - 1)], 0)
        same = same & (new[1:] == new[:-1])
    tied = np.zeros(len(wanted), bool)
    tied[1:] = same
    tied[:-1] |= same
    at = np.flatnonzero(tied)
    raw = body.tobytes()
    # Groups of ties follow one another, so sorting all of them at once keeps the groups.
    wanted[at] = sorted(wanted[at].tolist(), key=lambda i: raw[i : i + depth])
    return wanted


def common_prefixes(body: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in order, up to limit."""
    out = np.zeros(len(order), np.int64)
    if len(order) < 2:
        return out
    words = _words8(body)
    n = len(body)
    live, done = np.arange(1, len(order)), 0
    while len(live) and done < limit:
        a, b = order[live - 1] + done, order[live] + done
        room = n - np.maximum(a, b)
        differ = words[np.minimum(a, n - 1)] ^ words[np.minimum(b, n - 1)]
        same = np.full(len(live), 8)
        for k in range(8):
            same = np.where((differ >> np.uint64(56 - 8 * k) & np.uint64(255) != 0) & (same == 8), k, same)
        same = np.minimum(same, np.maximum(room, 0))
        out[live] += same
        live, done = live[same == 8], done + 8
    return np.minimum(out, limit)


def repeated_windows(texts: list[bytes], counts: list[int], length: int) -> list[np.ndarray]:
    """Per text the windows that start at its first counts places and occur twice in all texts."""
    body = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    starts = np.cumsum(sizes) - sizes
    valid = np.zeros(len(body), bool)
    for s, c in zip(starts, counts):
        valid[s : s + c] = True
    order = two_stage_order(body, length)
    order = order[valid[order]]
    twin = common_prefixes(body, order, length) >= length
    hit = np.zeros(len(body), bool)
    hit[order[twin]] = True
    hit[order[:-1][twin[1:]]] = True
    return [np.flatnonzero(hit[s : s + c]) for s, c in zip(starts, counts)]


def _ranges(places: np.ndarray) -> list[tuple[int, int]]:
    """First place and number of consecutive ones."""
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) > 1) + 1
    first = places[np.concatenate([[0], cut])]
    last = places[np.concatenate([cut - 1, [len(places) - 1]])]
    return list(zip(first.tolist(), (last - first + 1).tolist()))


KEY = ["_k1", "_k2"]


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    return docs.select("doc_id", text.alias("_text")).withColumns(
        {"_k1": F.xxhash64("doc_id", "_text"), "_k2": F.xxhash64("_text", "doc_id", F.lit(97))}
    )


def _all_segments(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    def cut(batches):
        for batch in batches:
            body, offsets = arrays.flat(batch.column(2))
            for a, b in arrays.runs(offsets):
                row, first, n, key, content, twice = _segments(body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], length, gram)
                rows = pa.array(row + a)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(first.astype(np.int32)),
                        pa.array(n.astype(np.int32)),
                        pa.array(key.view(np.int64)),
                        pa.array(content.view(np.int64)),
                        pa.array(twice),
                    ],
                    [*KEY, "_a", "_n", "_key", "_sid", "_twice"],
                )

    return keyed.select(*KEY, "_text").mapInArrow(cut, "_k1 long, _k2 long, _a int, _n int, _key long, _sid long, _twice boolean")


def _repeats_in_shards(open_texts: DataFrame, length: int) -> DataFrame:
    """Ranges of repeated windows of segments, from the suffix arrays of shards."""

    def shards(batches):
        keys, rows, size = [], [], 0
        for batch in batches:
            for key, sid, n, raw in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                # A shard ends between keys, so segments of one key share a suffix array.
                if size >= SHARD_BYTES and rows and key != rows[-1][0]:
                    yield search(rows)
                    rows, size = [], 0
                rows.append((key, sid, n, raw))
                size += len(raw)
        if rows:
            yield search(rows)

    def search(rows) -> pa.RecordBatch:
        found = repeated_windows([r[3] for r in rows], [r[2] for r in rows], length)
        out = [(k, s, n, _ranges(f)) for (k, s, n, _), f in zip(rows, found) if len(f)]
        k, s, n, r = zip(*out) if out else ((), (), (), ())
        kind = pa.list_(pa.struct([("o", pa.int32()), ("c", pa.int32())]))
        return pa.RecordBatch.from_arrays(
            [pa.array(k, pa.int64()), pa.array(s, pa.int64()), pa.array(n, pa.int32()), pa.array([[{"o": o, "c": c} for o, c in x] for x in r], kind)],
            ["_key", "_sid", "_n", "_found"],
        )

    dealt = open_texts.repartition(F.col("_key")).sortWithinPartitions("_key")
    return dealt.mapInArrow(shards, "_key long, _sid long, _n int, _found array<struct<o:int,c:int>>")


def _texts_of(keyed: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Bytes of the wanted segments, each from the document that represents it."""
    lists = wanted.groupBy(F.col("_r1"), F.col("_r2")).agg(F.collect_list(F.struct("_key", "_sid", "_n", "_ra")).alias("_list"))
    # Rows equal in both hashes hold the same bytes; one of them is enough.
    texts = keyed.join(lists, (F.col("_k1") == F.col("_r1")) & (F.col("_k2") == F.col("_r2")))
    each = texts.select("_text", F.explode("_list").alias("x"))
    raw = F.expr(f"substring(_text, x._ra + 1, x._n + {length - 1})")
    return each.select("x._key", "x._sid", "x._n", raw.alias("_raw")).dropDuplicates(["_key", "_sid", "_n"])


def _met_again(rows: DataFrame) -> DataFrame:
    """Rows whose key and window another row has too."""
    again = rows.groupBy(F.col("_key").alias("_hk"), F.col("_w").alias("_hw")).agg(F.count(F.lit(1)).alias("_c")).where("_c > 1")
    again = store(again, "again")
    # Windows of more than a thousandth of the rows, fewer than 1,000, are broadcast, as each would land in one task.
    many = rows.count() // 1000
    common, other = F.broadcast(again.where(F.col("_c") > many)), again.where(F.col("_c") <= many)
    same = (F.col("_key") == F.col("_hk")) & (F.col("_w") == F.col("_hw"))
    return rows.join(common, same, "left_semi").unionByName(rows.join(common, same, "left_anti").join(other, same, "left_semi"))


def _hot_windows(texts: DataFrame, length: int) -> DataFrame:
    """Repeated windows of hot keys, by the hash of the whole window."""

    def windows(batches):
        for batch in batches:
            for key, sid, n, raw in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                hashed = _window_hashes(raw, length)[:n].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, key)), pa.array(np.full(n, sid)), pa.array(np.full(n, n, np.int32)), pa.array(np.arange(n, dtype=np.int32)), pa.array(hashed)],
                    ["_key", "_sid", "_n", "_o", "_w"],
                )

    hit = _met_again(store(texts.mapInArrow(windows, "_key long, _sid long, _n int, _o int, _w long"), "windows"))
    # Windows one behind the other become one range; a segment has a bounded number of them.
    segment = ["_key", "_sid", "_n"]
    island = F.col("_o") - F.row_number().over(Window.partitionBy(*segment).orderBy("_o"))
    ranges = hit.select(*segment, "_o", island.alias("_island")).groupBy(*segment, "_island").agg(F.min("_o").alias("o"), F.count(F.lit(1)).cast("int").alias("c"))
    return ranges.groupBy(*segment).agg(F.collect_list(F.struct("o", "c")).alias("_found"))


def repeated_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT):
    """The keyed documents, and per document key the (first window, windows) that repeat."""
    keyed = _keyed(docs)
    segments = store(_all_segments(keyed, length, gram), "segments")
    kinds = segments.groupBy("_key", "_sid", "_n").agg(
        F.count(F.lit(1)).alias("_copies"), F.min(F.struct("_k1", "_k2", "_a")).alias("_rep"), F.max("_twice").alias("_twice")
    )
    kinds = store(kinds, "kinds")
    several = kinds.groupBy(F.col("_key").alias("_q")).agg(F.count(F.lit(1)).alias("_kinds"), F.max("_twice").alias("_any")).where("_kinds > 1 or _any")
    marked = kinds.join(several, F.col("_key") == F.col("_q"))
    open_ = marked.select("_key", "_sid", "_n", "_kinds", F.col("_rep._k1").alias("_r1"), F.col("_rep._k2").alias("_r2"), F.col("_rep._a").alias("_ra"))
    texts = store(_texts_of(keyed, open_, length), "texts")
    busy = open_.where(F.col("_kinds") >= hot).select(F.col("_key").alias("_b")).distinct()
    cold = texts.join(busy, F.col("_key") == F.col("_b"), "left_anti")
    warm = texts.join(busy, F.col("_key") == F.col("_b"), "left_semi")
    partly = _repeats_in_shards(cold.select("_key", "_sid", "_n", "_raw"), length).unionByName(
        _hot_windows(warm.select("_key", "_sid", "_n", "_raw"), length)
    )
    whole = kinds.where("_copies > 1").select(
        "_key", "_sid", "_n", F.array(F.struct(F.lit(0).alias("o"), F.col("_n").alias("c"))).alias("_found")
    )
    found = whole.unionByName(partly).select(F.col("_key").alias("_fk"), F.col("_sid").alias("_fs"), F.col("_n").alias("_fn"), "_found")
    hit = segments.join(found, (F.col("_key") == F.col("_fk")) & (F.col("_sid") == F.col("_fs")) & (F.col("_n") == F.col("_fn")))
    each = hit.select(*KEY, F.transform("_found", lambda x: F.struct((F.col("_a") + x["o"]).alias("a"), x["c"].alias("c"))).alias("r"))
    return keyed, each.groupBy(F.col("_k1").alias("_d1"), F.col("_k2").alias("_d2")).agg(F.flatten(F.collect_set("r")).alias("_ranges"))


def _cut(raw: bytes, ranges: list, length: int) -> tuple[list[tuple[int, int]], bytes]:
    """Removed spans, and what is left."""
    spans: list[list[int]] = []
    for a, c in sorted((r["a"], r["c"]) for r in ranges):
        end = a + c + length - 1
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([a, end])
    left, place = [], 0
    for a, b in spans:
        left.append(raw[place:a])
        place = b
    return [(a, b) for a, b in spans], b"".join([*left, raw[place:]])


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """One row per document: sizes, hash of what is left, removed spans, and the bytes left."""
    keyed, ranges = repeated_ranges(docs, length, gram, hot)
    kind = keyed.schema["doc_id"].dataType.simpleString()
    joined = keyed.join(ranges, (F.col("_k1") == F.col("_d1")) & (F.col("_k2") == F.col("_d2")), "left")
    source = joined.select("doc_id", "_text", F.coalesce("_ranges", F.expr("cast(array() as array<struct<a:int,c:int>>)")).alias("_r"))

    def cut(batches):
        for batch in batches:
            for part in range(0, len(batch), 256):
                rows = batch.slice(part, 256)
                raws = rows.column(1).to_pylist()
                done = [_cut(raw, r, length) for raw, r in zip(raws, rows.column(2).to_pylist())]
                spans = [d[0] for d in done]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array([len(r) for r in raws], pa.int64()),
                        pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()),
                        pa.array([len(s) for s in spans], pa.int64()),
                        pa.array([hashlib.sha256(d[1]).hexdigest() for d in done], pa.string()),
                        pa.array([",".join(f"{a}:{b}" for a, b in s) for s in spans], pa.string()),
                        pa.array([d[1] for d in done], pa.binary()),
                    ],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"],
                )

    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans string, kept binary"
    return source.mapInArrow(cut, schema)
