"""Near duplicates by order MinHash, verified by banded alignment.

Five-word shingles are labelled with their occurrence in the text, so repeats count. A sketch
takes the three smallest labelled shingles under one hash and keeps them in text order, which
makes agreement follow edit similarity and not only the set of shingles. As texts are also alike
if their sets of shingles are, whatever was moved or repeated, further sketches take the three
smallest of the distinct shingles without order or label. Texts that agree in one of the
sketches are candidates, and every candidate pair is verified unless other links connect it.
Every text is first held against the hub of its bucket, the text that shares most places with
others, in two rounds that give one pair per member. What is still of different labels in one
bucket is then held against one another: pair by pair in small buckets, in blocks in large ones,
where a block of texts meets another as one row and shared shingles are counted by matrix
products. A link needs an alignment of the labelled shingles, in order and within the band that
a similarity allows, that covers ``similarity`` of both texts' shingles; texts whose parts were
moved or repeated are taken on the Jaccard similarity of their shingle sets.

Equal texts are one text from the start. Rows grow with the input whatever a group's size; the
counting in blocks grows with the square of the texts of a bucket that hubs do not link.

Defined results: texts of one to four words have one shingle, the words themselves; null texts
and texts without a word are alike to nothing, each of them its own class; classes are named by
their smallest doc_id; rows equal in doc_id and text are in the same class.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from labelwright.llm import arrays
from labelwright.llm.components import components
from labelwright.llm.rows import packed
from labelwright.sources.scratch import store

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 14
SET_SKETCHES = 10
KEPT = 3
HUB_ROUNDS = 2
#: Members of an open bucket up to which its pairs are rows of their own; members and bytes of a block beyond.
PAIRED = 12
BLOCK = 256
BLOCK_BYTES = 1 << 20
#: Distinct shingles that a matrix product takes at once.
WIDE = 4096

_WORD = arrays.table(r"[^\x20\x09-\x0D]")


def shingles(body: np.ndarray, offsets: np.ndarray, size: int = SHINGLE):
    """Hash and row of each shingle, in text order."""
    start, end, row = arrays.spans_of(_WORD[body], offsets)
    words = arrays.piece_hashes(arrays.prefix_sums(body), start, end)
    n = np.bincount(row, minlength=len(offsets) - 1)
    first = np.cumsum(n) - n
    # A text with fewer words has one shingle that ends with its words.
    count = np.where(n > 0, np.maximum(n - size + 1, 1), 0)
    owner = np.repeat(np.arange(len(n)), count)
    at = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    h = np.full(len(owner), np.uint64(size))
    for k in range(size):
        there = at + k < (first + n)[owner]
        word = words[np.minimum(at + k, max(len(words) - 1, 0))] if len(words) else h
        h = np.where(there, arrays.mixed(h ^ word) + np.uint64(k + 1), h)
    return arrays.mixed(h), owner


def labelled(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Shingle hashes joined with their occurrence number in the text."""
    if not len(hashes):
        return hashes
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    begin = np.flatnonzero(new)
    nth = np.arange(len(h)) - np.repeat(begin, np.diff(np.append(begin, len(h))))
    out = np.empty(len(h), np.uint64)
    out[order] = h + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return out


def distinct(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of each row in the order of their hashes, and their rows."""
    by = np.lexsort((hashes, owner))
    h, o = hashes[by], owner[by]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    return h[new], o[new]


def sketches(labels: np.ndarray, owner: np.ndarray, n_rows: int, count: int = SKETCHES, kept: int = KEPT, first: int = 0) -> np.ndarray:
    """(rows, count) hashes of the smallest labelled shingles in the order given; rows without any get 0."""
    out = np.zeros((n_rows, count), np.uint64)
    if not len(labels):
        return out
    begin = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    rows = owner[begin]
    group = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(owner))))
    top = ~np.uint64(0)
    for t in range(count):
        h = arrays.mixed(labels ^ arrays.mixed(np.array([first + t + 1], np.uint64)))
        places = []
        for _ in range(kept):
            least = np.minimum.reduceat(h, begin)
            hit = np.flatnonzero((h == least[group]) & (least[group] != top))
            # Equal hashes are as good as impossible; the first place stands for them.
            place = np.full(len(begin), len(labels))
            place[group[hit][::-1]] = hit[::-1]
            places.append(place)
            h[hit] = top
        places = np.sort(np.stack(places), axis=0)
        value = np.zeros(len(begin), np.uint64)
        padded = np.append(labels, np.uint64(0))
        for p in places:
            value = arrays.mixed(value ^ padded[p]) + np.uint64(1)
        out[rows, t] = value
    return out


def similarity(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray, wanted: float = SIMILARITY) -> float:
    """The larger of the banded alignment similarity and the Jaccard similarity of the sets."""
    if not len(a) or not len(b):
        return 0.0
    total = len(a) + len(b)
    # At similarity s, matches cover s / (1 + s) of all, so paths stray no farther than this.
    band = int(total * (1 - wanted) / (1 + wanted)) + 1
    _, i, j = np.intersect1d(la, lb, assume_unique=True, return_indices=True)
    near = np.abs(i - j) <= band
    by = np.argsort(i[near])
    tails: list[int] = []
    for x in j[near][by].tolist():
        k = bisect_left(tails, x)
        if k == len(tails):
            tails.append(x)
        else:
            tails[k] = x
    aligned = len(tails) / (total - len(tails))
    if aligned >= wanted:
        return aligned
    ua, ub = np.unique(a), np.unique(b)
    both = len(np.intersect1d(ua, ub, assume_unique=True))
    return max(aligned, both / (len(ua) + len(ub) - both))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    return docs.select("doc_id", text.alias("_text")).withColumns({"_k1": F.xxhash64("_text"), "_k2": F.xxhash64("_text", F.lit(53))})


def _sketched(keyed: DataFrame, size: int, count: int, kept: int) -> DataFrame:
    """One row per distinct text with a word: its keys, a number and its sketches."""

    def sketched(batches):
        for batch in batches:
            body, offsets = arrays.flat(batch.column(2))
            for a, b in arrays.runs(offsets):
                hashes, owner = shingles(body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size)
                ordered = sketches(labelled(hashes, owner), owner, b - a, count, kept)
                sets = sketches(*distinct(hashes, owner), b - a, SET_SKETCHES, kept, first=1 << 16)
                found = np.hstack([ordered, sets])
                rows = np.unique(owner)
                at = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * found.shape[1])
                take = pa.array(rows + a)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(take),
                        batch.column(1).take(take),
                        pa.ListArray.from_arrays(at, pa.array(found[rows].ravel().view(np.int64))),
                    ],
                    ["_k1", "_k2", "_sketches"],
                )

    rows = keyed.select("_k1", "_k2", "_text").mapInArrow(sketched, "_k1 long, _k2 long, _sketches array<long>")
    return store(rows.dropDuplicates(["_k1", "_k2"]).withColumn("_id", F.monotonically_increasing_id()), "sketches")


def _verified(pairs: DataFrame, texts: DataFrame, size: int, wanted: float) -> DataFrame:
    """Pairs (u, v) that are similar enough."""
    left = texts.select(F.col("_id").alias("_i"), F.col("_text").alias("_a"))
    right = texts.select(F.col("_id").alias("_j"), F.col("_text").alias("_b"))
    joined = pairs.join(left, F.col("u") == F.col("_i")).join(right, F.col("v") == F.col("_j")).select("u", "v", "_a", "_b")

    def verified(batches):
        for batch in batches:
            for part in range(0, len(batch), 64):
                rows = batch.slice(part, 64)
                sides = []
                for column in (2, 3):
                    body, offsets = arrays.flat(rows.column(column))
                    hashes, owner = shingles(body, offsets, size)
                    bounds = np.searchsorted(owner, np.arange(len(rows) + 1))
                    sides.append((hashes, labelled(hashes, owner), bounds))
                (ha, la, ba), (hb, lb, bb) = sides
                good = []
                for k in range(len(rows)):
                    a, b = slice(ba[k], ba[k + 1]), slice(bb[k], bb[k + 1])
                    good.append(similarity(ha[a], la[a], hb[b], lb[b], wanted) >= wanted)
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1)], ["u", "v"]).filter(pa.array(good, pa.bool_()))

    return joined.mapInArrow(verified, "u long, v long")


def _shared_buckets(sketched: DataFrame) -> DataFrame:
    """Members of buckets of two or more, with the number of places they share: (_id, _band, _value, _rank)."""
    members = sketched.select("_id", F.posexplode("_sketches").alias("_band", "_value"))
    sizes = members.groupBy(F.col("_band").alias("_b"), F.col("_value").alias("_v")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    members = members.join(sizes, (F.col("_band") == F.col("_b")) & (F.col("_value") == F.col("_v"))).drop("_b", "_v")
    members = store(members, "members")
    # A text that its copies were made from shares more places than the copies do.
    rank = members.groupBy(F.col("_id").alias("_i")).agg(F.sum("_n").alias("_shared"))
    ranked = members.join(rank, F.col("_id") == F.col("_i"))
    return store(ranked.select("_id", "_band", "_value", F.struct("_shared", (-F.col("_id")).alias("_minus")).alias("_rank")), "members")


def linked_texts(
    sketched: DataFrame, keyed: DataFrame, size: int, wanted: float, rounds: int = HUB_ROUNDS, paired: int = PAIRED, block: int = BLOCK
) -> DataFrame:
    """Similar pairs (u, v) of distinct texts, enough of them to connect every class.

    A round holds the members of each bucket against one of them, its hub, and the next round
    against the next hub. Linked members carry the label of their component; only members with
    another label than the hub are compared, and a bucket of one label is done. After the rounds
    every pair of different labels that is left in a bucket is verified.
    """
    spark = sketched.sparkSession
    members = _shared_buckets(sketched).withColumn("_label", F.col("_id"))
    chosen = sketched.join(members.select("_id").distinct(), "_id", "left_semi").select("_id", F.col("_k1").alias("_p"), F.col("_k2").alias("_q"))
    texts = keyed.select("_k1", "_k2", "_text").join(chosen, (F.col("_k1") == F.col("_p")) & (F.col("_k2") == F.col("_q")))
    texts = store(texts.select("_id", "_text").dropDuplicates(["_id"]), "texts")
    found = tried = spark.createDataFrame([], "u long, v long")
    for _ in range(rounds):
        top = F.max(F.struct("_rank", "_label")).alias("_top")
        hubs = members.groupBy(F.col("_band").alias("_b"), F.col("_value").alias("_v")).agg(top, F.min("_label").alias("_low"), F.max("_label").alias("_high"))
        hubs = hubs.where("_low != _high").select("_b", "_v", F.col("_top._rank").alias("_hub_rank"), F.col("_top._label").alias("_hub_label"))
        hub = -F.col("_hub_rank._minus")
        met = members.join(hubs, (F.col("_band") == F.col("_b")) & (F.col("_value") == F.col("_v"))).where(F.col("_id") != hub).drop("_b", "_v")
        met = store(met.withColumns({"u": F.greatest("_id", hub), "v": F.least("_id", hub)}), "met")
        fresh = met.where("_label != _hub_label").select("u", "v").distinct()
        fresh = store(fresh.join(tried, ["u", "v"], "left_anti"), "pairs")
        found = found.unionByName(store(_verified(fresh, texts, size, wanted), "good"))
        tried = tried.unionByName(fresh)
        labels = components(found).select(F.col("node").alias("_i"), F.col("root").alias("_root"))
        members = met.join(labels, F.col("_id") == F.col("_i"), "left").select("_id", "_band", "_value", "_rank", F.coalesce("_root", "_id").alias("_label"))
    open_ = members.groupBy(F.col("_band").alias("_b"), F.col("_value").alias("_v")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_label").alias("_low"), F.max("_label").alias("_high")
    )
    rest = members.join(open_.where("_low != _high"), (F.col("_band") == F.col("_b")) & (F.col("_value") == F.col("_v")))
    rest = store(rest.select("_id", "_band", "_value", "_label", "_n"), "rest")
    few = _pairs_left(rest.where(F.col("_n") <= paired), tried)
    found = found.unionByName(store(_verified(few, texts, size, wanted), "good"))
    many = _blocks_left(rest.where(F.col("_n") > paired), sketched, texts, block)
    return found.unionByName(store(_verified_blocks(many, size, wanted), "good"))


def _pairs_left(rest: DataFrame, tried: DataFrame) -> DataFrame:
    """Untested pairs (u, v) of different labels in one bucket."""
    left = rest.select("_band", "_value", F.col("_id").alias("u"), F.col("_label").alias("_lu"))
    right = rest.select(F.col("_band").alias("_b"), F.col("_value").alias("_v"), F.col("_id").alias("v"), F.col("_label").alias("_lv"))
    met = left.join(right, (F.col("_band") == F.col("_b")) & (F.col("_value") == F.col("_v")) & (F.col("u") > F.col("v")) & (F.col("_lu") != F.col("_lv")))
    return met.select("u", "v").distinct().join(tried, ["u", "v"], "left_anti")


def _blocks_left(rest: DataFrame, sketched: DataFrame, texts: DataFrame, block: int) -> DataFrame:
    """(_band, _same, _left, _right): every two blocks of a bucket, and each with itself; blocks hold texts."""
    held = rest.join(sketched.select(F.col("_id").alias("_i"), "_sketches"), F.col("_id") == F.col("_i")).drop("_i")
    held = held.join(texts.select(F.col("_id").alias("_i"), "_text"), F.col("_id") == F.col("_i")).drop("_i")
    held = store(held, "held")
    sizes = held.groupBy(F.col("_band").alias("_b"), F.col("_value").alias("_v")).agg(
        F.ceil(F.greatest(F.max("_n") / block, F.sum(F.octet_length("_text")) / BLOCK_BYTES)).cast("int").alias("_blocks")
    )
    dealt = held.join(sizes, (F.col("_band") == F.col("_b")) & (F.col("_value") == F.col("_v")))
    dealt = dealt.withColumn("_block", F.pmod(F.xxhash64("_id"), F.col("_blocks")).cast("int"))
    one = F.collect_list(F.struct("_id", "_label", "_sketches", "_text"))
    blocks = store(dealt.groupBy("_band", "_value", "_blocks", "_block").agg(one.alias("_many")), "blocks")
    # A block goes to every block from its own on, so that a bucket's meetings are dealt out one by one.
    left = blocks.select("_band", "_value", F.col("_block").alias("_from"), F.col("_many").alias("_left"), F.explode(F.sequence(F.col("_block"), F.col("_blocks") - 1)).alias("_to"))
    right = blocks.select(F.col("_band").alias("_b"), F.col("_value").alias("_v"), F.col("_block").alias("_at"), F.col("_many").alias("_right"))
    met = left.join(right, (F.col("_band") == F.col("_b")) & (F.col("_value") == F.col("_v")) & (F.col("_to") == F.col("_at")))
    return met.select("_band", (F.col("_from") == F.col("_to")).alias("_same"), "_left", "_right")


def jaccard(a: np.ndarray, ra: np.ndarray, na: int, b: np.ndarray, rb: np.ndarray, nb: int) -> np.ndarray:
    """Similarity of every set of one side to every set of the other: hashes without repeats in a row, and their rows."""
    both = np.zeros((na, nb), np.float64)
    if a is b:  # one side with itself: what a single row has is shared by none
        common, times = np.unique(a, return_counts=True)
        common = common[times > 1]
    else:
        common = np.intersect1d(a, b)
    sides = []
    for hashes, rows in ((a, ra), (b, rb)):
        at = np.minimum(np.searchsorted(common, hashes), max(len(common) - 1, 0))
        here = np.flatnonzero(common[at] == hashes) if len(common) else np.zeros(0, np.int64)
        by = here[np.argsort(at[here], kind="stable")]
        sides.append((at[by], rows[by]))
    for first in range(0, len(common), WIDE):
        width = min(WIDE, len(common) - first)
        filled = []
        for (at, rows), n in zip(sides, (na, nb)):
            lo, hi = np.searchsorted(at, (first, first + width))
            matrix = np.zeros((n, width), np.float32)
            matrix[rows[lo:hi], at[lo:hi] - first] = 1
            filled.append(matrix)
        both += filled[0] @ filled[1].T
    total = np.bincount(ra, minlength=na)[:, None] + np.bincount(rb, minlength=nb)[None, :]
    return both / np.maximum(total - both, 1)


class _Block:
    """The texts of a block: ids, labels, sketches, shingles, labelled shingles and distinct ones."""

    def __init__(self, many: pa.StructArray, size: int):
        self.ids, self.labels = (many.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        self.n = len(self.ids)
        self.sketches = many.field(2).flatten().to_numpy(zero_copy_only=False).reshape(self.n, -1)
        self.hashes, self.owner = shingles(*arrays.flat(many.field(3)), size)
        self.marked = labelled(self.hashes, self.owner)
        self.bounds = np.searchsorted(self.owner, np.arange(self.n + 1))
        self.kinds, self.kind_owner = distinct(self.hashes, self.owner)

    def text(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.bounds[k], self.bounds[k + 1])
        return self.hashes[at], self.marked[at]


def links_between(a: _Block, b: _Block, same: bool, band: int, wanted: float) -> list[tuple[int, int]]:
    """Similar pairs of two blocks of a bucket, enough of them to connect what is similar."""
    asked = a.labels[:, None] != b.labels[None, :]
    if same:
        asked = np.triu(asked, 1)
    # Two texts that share an earlier bucket have met there.
    for t in range(band):
        asked &= a.sketches[:, t][:, None] != b.sketches[:, t][None, :]
    if not asked.any():
        return []
    sets = jaccard(a.kinds, a.kind_owner, a.n, b.kinds, b.kind_owner, b.n) >= wanted
    # No alignment covers more than the labelled shingles that both texts have; the margin is for rounding only.
    may = jaccard(a.marked, a.owner, a.n, b.marked, b.owner, b.n) >= wanted - 1e-9
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    good = []
    for i, j in np.argwhere(asked & (sets | may)).tolist():
        x, y = find(int(a.labels[i])), find(int(b.labels[j]))
        if x != y and (sets[i, j] or similarity(*a.text(i), *b.text(j), wanted) >= wanted):
            parent[x] = y
            good.append((max(int(a.ids[i]), int(b.ids[j])), min(int(a.ids[i]), int(b.ids[j]))))
    return good


def _verified_blocks(meetings: DataFrame, size: int, wanted: float) -> DataFrame:
    """Pairs (u, v) of blocks that are similar enough."""

    def verified(batches):
        for batch in batches:
            for k in range(len(batch)):
                row = batch.slice(k, 1)
                same = row.column(1)[0].as_py()
                left = _Block(row.column(2).flatten(), size)
                right = left if same else _Block(row.column(3).flatten(), size)
                good = links_between(left, right, same, row.column(0)[0].as_py(), wanted)
                yield pa.RecordBatch.from_pydict({"u": pa.array([g[0] for g in good], pa.int64()), "v": pa.array([g[1] for g in good], pa.int64())})

    # A row holds two blocks, so batches are short.
    return meetings.mapInArrow(verified, "u long, v long")


def _classes(keyed: DataFrame, size: int, wanted: float, count: int, kept: int) -> DataFrame:
    """Per distinct text with a word: its class, and the text and document that stand for the class."""
    sketched = _sketched(keyed, size, count, kept)
    found = components(linked_texts(sketched, keyed, size, wanted))
    sizes = keyed.groupBy(F.col("_k1").alias("_p"), F.col("_k2").alias("_q")).agg(F.min("doc_id").alias("_least"), F.count(F.lit(1)).alias("_copies"))
    named = sketched.select("_id", "_k1", "_k2").join(sizes, (F.col("_k1") == F.col("_p")) & (F.col("_k2") == F.col("_q")))
    named = named.join(found, F.col("_id") == F.col("node"), "left").select("_p", "_q", "_least", "_copies", F.coalesce("root", "_id").alias("_root"))
    named = store(named, "classes")
    # A missing id comes after all others.
    owner = F.min(F.struct(F.col("_least").isNull().alias("none"), F.col("_least").alias("id"), F.col("_p").alias("p"), F.col("_q").alias("q")))
    classes = named.groupBy(F.col("_root").alias("_r")).agg(owner.alias("_owner"), F.count(F.lit(1)).alias("_texts"))
    return named.join(classes, F.col("_root") == F.col("_r")).select("_p", "_q", "_copies", "_texts", "_owner")


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE, wanted: float = SIMILARITY, count: int = SKETCHES, kept: int = KEPT
) -> DataFrame:
    """One row per document: class_id, n_copies (rows of the same text), n_texts (texts of its class)."""
    keyed = _keyed(docs)
    classes = _classes(keyed, size, wanted, count, kept)
    out = keyed.select("doc_id", "_k1", "_k2").join(classes, (F.col("_k1") == F.col("_p")) & (F.col("_k2") == F.col("_q")), "left")
    return out.select(
        "doc_id",
        F.when(F.col("_texts").isNull(), F.col("doc_id")).otherwise(F.col("_owner.id")).alias("class_id"),
        F.coalesce("_copies", F.lit(1)).cast("long").alias("n_copies"),
        F.coalesce("_texts", F.lit(1)).cast("long").alias("n_texts"),
    )


def one_of_each(
    docs: DataFrame, size: int = SHINGLE, wanted: float = SIMILARITY, count: int = SKETCHES, kept: int = KEPT
) -> DataFrame:
    """The rows of docs with one row per class, the one that names it; rows without a word all stay."""
    key = lambda *salt: F.xxhash64(F.coalesce(F.col("_row.text").cast("binary"), F.lit("").cast("binary")), *salt)
    classes = _classes(_keyed(docs), size, wanted, count, kept)
    rows = packed(docs).withColumns({"_k1": key(), "_k2": key(F.lit(53))})
    joined = rows.join(classes, (F.col("_k1") == F.col("_p")) & (F.col("_k2") == F.col("_q")), "left")
    stands = (F.col("_owner.p") == F.col("_k1")) & (F.col("_owner.q") == F.col("_k2")) & F.col("_owner.id").eqNullSafe(F.col("_row.doc_id"))
    kept_rows = joined.where(F.col("_texts").isNull() | stands)
    single = kept_rows.where(F.col("_texts").isNull() | (F.col("_copies") == 1)).select("_row.*")
    several = kept_rows.where(F.col("_copies") > 1).dropDuplicates(["_k1", "_k2"]).select("_row.*")
    return single.unionByName(several)
