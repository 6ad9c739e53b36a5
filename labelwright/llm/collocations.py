"""Collocations: phrases of two to five words that occur more often than their parts suggest.

Texts are cut into pieces at punctuation and line ends, pieces into words. Words with enough
occurrences get ids by falling frequency, over all languages together, and every text is
written once as a sequence of ids. Adjacent ids are then counted by direct addressing: a pair
falls into a tile of the grid of id pairs; tiles with many pairs are counted with numpy's
bincount into a dense tile that a task keeps, the others as sorted coordinates. Frequent pairs
are ranked in their turn and meet the word that follows them, and so on up to five words.

Ids are given to at most ``ranked`` words or phrases of each length, so what is broadcast does
not follow the corpus. Frequent ones beyond that are known by a bitmap of fixed size, and
windows that may hold them are counted under their text. Both ways give exact counts; a word is
recognised by 128 bits of hash among the ranked ones. Only phrases, never occurrences, are
shuffled, and each task adds up its own first.

A language is a text's ``lang``, null being `und`. Scores use exact decimals. Null texts have
no words, a table without words gives no row, equal rows count each time, ties are settled by
the order of the phrase's bytes, and other columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from labelwright.llm.arrays import flat, mixed, runs, spans_of, table
from labelwright.llm.rows import small_side
from labelwright.sources.scratch import store

LEAST = 100
LONGEST = 5
TOP = 2000
RANKED = 1 << 18
SIEVE_BITS = 1 << 24
TILE = 256
GRID = 8
DENSE_FROM = TILE * TILE // 8
COORDINATES = 1 << 21
TEXTS = 1 << 17
RUN_BYTES = 4 << 20
HOT = 4096
SALTS = 32
UNKNOWN = "und"

_NONE, _MAYBE = -1, -2
_CUT, _GAP = table(r"[.,;:!?\x0A-\x0D]"), table(r"[\x20\x09]")
_LOWER = np.where(table("[A-Z]"), np.arange(256) + 32, np.arange(256)).astype(np.uint8)
_LANES = 64
_K = np.uint64(0x9FB21C651E98DF25)
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)
_SCHEMA = "left int, right int, lang string, phrase string, n long"


def _tag(lang: str) -> tuple[int, int]:
    d = hashlib.blake2b(lang.encode(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little"), int.from_bytes(d[8:], "little")


def word_hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray, tag: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each slice and the tag of its language, eight bytes at a time."""
    size = end - start
    a = mixed(tag[:, 0] ^ size.astype(np.uint64) ^ np.uint64(seed))
    b = mixed(tag[:, 1] + size.astype(np.uint64) * _K)
    padded = np.concatenate([low, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(low) + 1,), np.uint64, buffer=padded, strides=(1,))
    who = np.arange(len(size))
    for j in range(_LANES):
        who = who[size[who] > 8 * j]
        if not len(who):
            return a, b
        v = lanes[start[who] + 8 * j] & _KEEP[np.minimum(size[who] - 8 * j, 8)]
        a[who] = mixed(a[who] ^ v)
        b[who] = mixed(b[who] * _K + v)
    for i in who[size[who] > 8 * _LANES]:
        d = hashlib.blake2b(low[start[i] : end[i]].tobytes(), digest_size=16).digest()
        a[i] ^= np.uint64(int.from_bytes(d[:8], "little"))
        b[i] ^= np.uint64(int.from_bytes(d[8:], "little"))
    return a, b


def _hashes_of(langs: list[str], words: list[str], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    raw = [w.encode() for w in words]
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    tags = {x: _tag(x) for x in set(langs)}
    tag = np.array([tags[x] for x in langs], np.uint64).reshape(-1, 2)
    return word_hashes(np.frombuffer(b"".join(raw), np.uint8), bounds[:-1], bounds[1:], tag, seed)


@dataclass
class Words:
    """The words of a run of texts: places in the lower-cased bytes, language, whether one follows the last."""

    low: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    follows: np.ndarray

    def strings(self, which: np.ndarray) -> pa.Array:
        size = self.end[which] - self.start[which]
        bounds = np.concatenate([[0], np.cumsum(size)])
        body = self.low[np.repeat(self.start[which] - bounds[:-1], size) + np.arange(bounds[-1])]
        return pa.Array.from_buffers(pa.string(), len(which), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(body)])


def words_of(body: np.ndarray, offsets: np.ndarray) -> Words:
    start, end, row = spans_of(~(_CUT | _GAP)[body], offsets)
    cuts = np.cumsum(_CUT[body], dtype=np.int32)[start] if len(start) else start
    follows = np.zeros(len(start), bool)
    follows[1:] = (row[1:] == row[:-1]) & (cuts[1:] == cuts[:-1])
    return Words(_LOWER[body], start, end, row, follows)


def _runs(batch: pa.RecordBatch):
    """Words of a run of rows, and the languages of those rows."""
    body, offsets = flat(batch.column(1))
    langs = batch.column(0).to_pylist()
    for first, last in runs(offsets, RUN_BYTES):
        at = offsets[first : last + 1]
        yield words_of(body[at[0] : at[-1]], at - at[0]), langs[first:last]


def _tags(langs: list[str]) -> np.ndarray:
    known = {x: _tag(x) for x in set(langs)}
    return np.array([known[x] for x in langs], np.uint64).reshape(-1, 2)


def _counted_words(batches):
    """(lang, word, n) of each run; the empty word carries all words of the language."""
    for batch in batches:
        for words, langs in _runs(batch):
            a, b = word_hashes(words.low, words.start, words.end, _tags(langs)[words.row])
            order = np.argsort(a, kind="stable")
            new = np.append(True, (a[order[1:]] != a[order[:-1]]) | (b[order[1:]] != b[order[:-1]]))[: len(order)]
            at = np.flatnonzero(new)
            which = order[at]
            each = np.diff(np.append(at, len(order)))
            named = pa.array(langs, pa.string())
            yield pa.RecordBatch.from_arrays([named.take(pa.array(words.row[which])), words.strings(which), pa.array(each, pa.int64())], ["lang", "word", "n"])
            total = np.bincount(words.row, minlength=len(langs))
            yield pa.RecordBatch.from_arrays([named, pa.array([""] * len(langs), pa.string()), pa.array(total, pa.int64())], ["lang", "word", "n"])


def _step(n: Column) -> Column:
    """Counts in steps of a 32nd of a power of two."""
    return F.floor(F.log2(n) * 32)


def _lowest_step(counts: DataFrame, limit: int) -> int:
    """The lowest step such that it and those above hold at most limit rows."""
    total, lowest = 0, 1 << 20
    for step, size in sorted(counts.groupBy(_step(F.col("n")).alias("s")).count().collect(), reverse=True):
        total += size
        if total > limit:
            break
        lowest = step
    return lowest


@dataclass
class Vocabulary:
    """Ranked words by hash; langs, strings and hashes by id; what may be frequent beyond them."""

    a: np.ndarray
    b: np.ndarray
    ids: np.ndarray
    langs: list[str]
    strings: list[str]
    by_id: np.ndarray
    sieve: np.ndarray | None
    seed: int

    def codes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not len(self.a):
            return np.full(len(a), _NONE, np.int32)
        at = np.minimum(np.searchsorted(self.a, a), len(self.a) - 1)
        return np.where((self.a[at] == a) & (self.b[at] == b), self.ids[at], _NONE).astype(np.int32)


@dataclass
class Phrases:
    """Ranked phrases of one length by (id of all words but the last, id of the last)."""

    keys: np.ndarray
    ids: np.ndarray
    sieve: np.ndarray | None

    def codes(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), _NONE, np.int32)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ids[at], _NONE).astype(np.int32)


def _in(sieve: np.ndarray, h: np.ndarray) -> np.ndarray:
    bit = h % np.uint64(len(sieve) * 64)
    return (sieve[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def _chained(h: np.ndarray, following: np.ndarray) -> np.ndarray:
    return mixed(h * _K ^ following)


def _sieve(beyond: DataFrame, seed: int, bits: int) -> np.ndarray | None:
    """A bitmap of the hashes of (lang, phrase), of a fixed size."""

    def marked(batches):
        for batch in batches:
            langs, phrases = batch.column(0).to_pylist(), [p.split(" ") for p in batch.column(1).to_pylist()]
            if phrases:
                n = len(phrases[0])
                h = _hashes_of([x for x in langs for _ in range(n)], [w for p in phrases for w in p], seed)[0].reshape(-1, n)
                one = h[:, 0]
                for k in range(1, n):
                    one = _chained(one, h[:, k])
                bit = one % np.uint64(bits)
                mask = (np.uint64(1) << (bit & np.uint64(63))).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array((bit >> np.uint64(6)).astype(np.int64)), pa.array(mask)], ["i", "m"])

    got = beyond.select("lang", "phrase").mapInArrow(marked, "i long, m long").groupBy("i").agg(F.bit_or("m").alias("m")).toPandas()
    if not len(got):
        return None
    sieve = np.zeros(bits // 64, np.uint64)
    sieve[got["i"]] = got["m"].to_numpy(np.int64).view(np.uint64)
    return sieve


def _named(frame: DataFrame, langs: list[str], phrases: list[str]) -> DataFrame:
    """(id, lang, phrase) as a written table of bounded size."""
    rows = pa.table({"id": pa.array(range(len(langs)), pa.int32()), "lang": pa.array(langs, pa.string()), "phrase": pa.array(phrases, pa.string())})
    return store(frame.sparkSession.createDataFrame(rows), "ranked")


def _vocabulary(words: DataFrame, ranked: int, bits: int) -> Vocabulary:
    lowest = _lowest_step(words, ranked)
    inside = _step(F.col("n")) >= lowest
    top = words.where(inside).toPandas().sort_values(["n", "lang", "phrase"], ascending=[False, True, True])
    langs, strings = top["lang"].tolist(), top["phrase"].tolist()
    seed = 0
    a, b = _hashes_of(langs, strings)
    while len(np.unique(a)) < len(a):
        seed += 1
        a, b = _hashes_of(langs, strings, seed)
    order = np.argsort(a)
    return Vocabulary(a[order], b[order], order.astype(np.int32), langs, strings, a, _sieve(words.where(~inside), seed, bits), seed)


def _encoded(source: DataFrame, sent) -> DataFrame:
    """Id sequences: -1 ends a stretch, -2 and below name a word of the row's own list."""

    def encode(batches):
        v = sent.value
        for batch in batches:
            for words, langs in _runs(batch):
                a, b = word_hashes(words.low, words.start, words.end, _tags(langs)[words.row], v.seed)
                code = v.codes(a, b)
                own_langs, own = [], pa.array([], pa.string())
                if v.sieve is not None:
                    rest = np.flatnonzero(code == _NONE)
                    rest = rest[_in(v.sieve, a[rest])]
                    spelled = words.strings(rest).to_pylist()
                    place = {}
                    for i, w in zip(rest, spelled):
                        code[i] = _MAYBE - place.setdefault((langs[words.row[i]], w), len(place))
                    own_langs, own = [x for x, _ in place], pa.array([w for _, w in place], pa.string())
                line = np.full(len(code) + int((~words.follows).sum()), _NONE, np.int32)
                line[np.arange(len(code)) + np.cumsum(~words.follows)] = code
                edge = np.concatenate([[_NONE], line, [_NONE]])
                alone = (edge[:-2] == _NONE) & (edge[2:] == _NONE)
                line = line[~alone]
                if len(line):
                    line = line[(line != _NONE) | (np.append(_NONE, line[:-1]) != _NONE)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([line.tobytes()], pa.binary()), pa.array([own_langs], pa.list_(pa.string())), pa.array([own.to_pylist()], pa.list_(pa.string()))],
                    ["codes", "langs", "words"],
                )

    return source.mapInArrow(encode, "codes binary, langs array<string>, words array<string>")


class Tiles:
    """Counts of pairs of ids: dense tiles for the frequent corner, sorted coordinates for the rest."""

    def __init__(self) -> None:
        self.dense: dict[int, np.ndarray] = {}
        self.keys = [np.zeros(0, np.int64)]
        self.n = [np.zeros(0, np.int64)]

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        corner = (left < GRID * TILE) & (right < GRID * TILE)
        tile = (left[corner] // TILE * GRID + right[corner] // TILE).astype(np.uint8)
        sizes = np.bincount(tile, minlength=GRID * GRID)
        use = sizes >= DENSE_FROM
        use[list(self.dense)] = sizes[list(self.dense)] > 0
        order = np.argsort(tile, kind="stable")
        ends = np.cumsum(sizes)
        l, r = left[corner][order], right[corner][order]
        for t in np.flatnonzero(use):
            part = slice(ends[t] - sizes[t], ends[t])
            counts = np.bincount(l[part] % TILE * TILE + r[part] % TILE, minlength=TILE * TILE)
            self.dense[int(t)] = self.dense.get(int(t), 0) + counts
        loose = ~use[tile[order]]
        left = np.concatenate([left[~corner], l[loose]]).astype(np.int64)
        right = np.concatenate([right[~corner], r[loose]]).astype(np.int64)
        keys = np.sort(left << 32 | right)
        at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        self.keys.append(keys[at])
        self.n.append(np.diff(np.append(at, len(keys))))

    def full(self) -> bool:
        """Whether the coordinates, once merged, are many."""
        if sum(map(len, self.keys)) < COORDINATES:
            return False
        self._merge()
        return len(self.keys[0]) >= COORDINATES // 2

    def _merge(self) -> None:
        keys, n = np.concatenate(self.keys), np.concatenate(self.n)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        self.keys, self.n = [keys[at]], [np.add.reduceat(n[order], at) if len(at) else n]

    def sparse(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Left ids, right ids and counts of the coordinates, which are then forgotten."""
        self._merge()
        keys, n = self.keys[0], self.n[0]
        self.keys, self.n = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        return (keys >> 32), (keys & 0xFFFFFFFF), n

    def tiles(self):
        for t, counts in self.dense.items():
            at = np.flatnonzero(counts)
            yield t // GRID * TILE + at // TILE, t % GRID * TILE + at % TILE, counts[at]


def _hashed(c: np.ndarray, v: Vocabulary, langs: list[str], words: list[str]) -> np.ndarray:
    """The hash of each word of a sequence."""
    by_code = np.concatenate([_hashes_of(langs, words, v.seed)[0][::-1], np.zeros(1, np.uint64), v.by_id])
    return by_code[c + len(words) + 1]


def _symbols(c: np.ndarray, levels: list[Phrases], h: np.ndarray | None) -> np.ndarray:
    """For each place the id of the longest ranked length there, -2 if it may be frequent, -1 if not."""
    s, chain = np.maximum(c, _MAYBE), h
    for k, level in enumerate(levels, 2):
        at = np.flatnonzero((s[:-1] != _NONE) & (s[1:] != _NONE))
        last = c[at + k - 1]
        known = (s[at] >= 0) & (last >= 0)
        new = np.full(max(len(s) - 1, 0), _NONE, np.int32)
        new[at[known]] = level.codes(s[at[known]].astype(np.int64) << 32 | last[known])
        if h is not None:
            chain = _chained(chain[:-1], h[k - 1 :])
        if level.sieve is not None:
            rest = at[new[at] == _NONE]
            new[rest[_in(level.sieve, chain[rest])]] = _MAYBE
        s = new
    return s


def _rows(left=None, right=None, langs=None, phrases=None, n=()):
    for i in range(0, len(n), 1 << 16):
        part = slice(i, i + (1 << 16))
        size = len(n[part])
        ids = [pa.nulls(size, pa.int32()) if x is None else pa.array(x[part], pa.int32()) for x in (left, right)]
        texts = [pa.nulls(size, pa.string()) if x is None else pa.array(x[part], pa.string()) for x in (langs, phrases)]
        yield pa.RecordBatch.from_arrays([*ids, *texts, pa.array(n[part], pa.int64())], ["left", "right", "lang", "phrase", "n"])


def _counted(encoded: DataFrame, sent, sent_levels) -> DataFrame:
    """Partial counts of the phrases one word longer than the levels given."""

    def count(batches):
        v, levels = sent.value, sent_levels.value
        m = len(levels) + 2
        hashed = any(x.sieve is not None for x in levels)
        tiles, loose = Tiles(), {}
        for batch in batches:
            for raw, langs, words in zip(*(batch.column(i).to_pylist() for i in range(3))):
                c = np.frombuffer(raw, np.int32)
                if len(c) < m:
                    continue
                s = _symbols(c, levels, _hashed(c, v, langs, words) if hashed else None)
                at = np.flatnonzero((s[:-1] != _NONE) & (s[1:] != _NONE))
                last = c[at + m - 1]
                known = (s[at] >= 0) & (last >= 0)
                tiles.add(s[at[known]], last[known])
                if tiles.full():
                    yield from _sparse_rows(tiles)
                for i in at[~known]:
                    codes = c[i : i + m].tolist()
                    text = " ".join(v.strings[x] if x >= 0 else words[_MAYBE - x] for x in codes)
                    lang = v.langs[codes[0]] if codes[0] >= 0 else langs[_MAYBE - codes[0]]
                    loose[lang, text] = loose.get((lang, text), 0) + 1
                    if len(loose) >= TEXTS:
                        yield from _rows(langs=[x for x, _ in loose], phrases=[x for _, x in loose], n=list(loose.values()))
                        loose = {}
        yield from _sparse_rows(tiles)
        for left, right, n in tiles.tiles():
            yield from _rows(left, right, n=n)
        yield from _rows(langs=[x for x, _ in loose], phrases=[x for _, x in loose], n=list(loose.values()))

    return encoded.mapInArrow(count, _SCHEMA)


def _sparse_rows(tiles: Tiles):
    left, right, n = tiles.sparse()
    yield from _rows(left, right, n=n)


def _with_count(rows: DataFrame, key: str, out: str, counts: DataFrame, hot: DataFrame) -> DataFrame:
    """Count of each row's (lang, key): of a bounded number of frequent ones by broadcast.

    Rows served that way look up a key of their own in the shuffled join, so they spread.
    """
    first = F.broadcast(hot.select(F.col("lang").alias("_l1"), F.col("phrase").alias("_p1"), F.col("n").alias("_n1")))
    rest = counts.select(F.col("lang").alias("_l2"), F.col("phrase").alias("_p2"), F.col("n").alias("_n2"))
    rows = rows.join(first, (F.col("lang") == F.col("_l1")) & (F.col(key) == F.col("_p1")), "left")
    rows = rows.withColumn("_own", F.when(F.col("_n1").isNull(), F.col(key)).otherwise(F.col("phrase")))
    rows = rows.join(rest, (F.col("lang") == F.col("_l2")) & (F.col("_own") == F.col("_p2")), "left")
    return rows.withColumn(out, F.coalesce("_n1", "_n2")).drop("_l1", "_p1", "_n1", "_l2", "_p2", "_n2", "_own")


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, ranked: int = RANKED, bits: int = SIEVE_BITS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, m, n) of all words and phrases with at least ``least`` occurrences; (lang, n) of all words."""
    spark = docs.sparkSession
    source = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("_text"))
    counted = source.mapInArrow(_counted_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counted = store(counted.where((F.col("n") >= least) | (F.col("word") == "")), "words")
    totals = counted.where("word = ''").select("lang", "n")
    words = counted.where("word != ''").select("lang", F.col("word").alias("phrase"), "n")
    v = _vocabulary(words, ranked, bits)
    sent = spark.sparkContext.broadcast(v)
    found = words.select("lang", "phrase", F.lit(1).alias("m"), "n")
    names = of_word = _named(docs, v.langs, v.strings)
    encoded = store(_encoded(source, sent), "encoded")
    levels: list[Phrases] = []
    for m in range(2, longest + 1):
        sums = _counted(encoded, sent, spark.sparkContext.broadcast(levels))
        sums = sums.groupBy("left", "right", "lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        before = F.broadcast(names.select(F.col("id").alias("_i"), F.col("lang").alias("_lang"), F.col("phrase").alias("_head")))
        after = F.broadcast(of_word.select(F.col("id").alias("_j"), F.col("phrase").alias("_tail")))
        sums = sums.join(before, F.col("left") == F.col("_i"), "left").join(after, F.col("right") == F.col("_j"), "left")
        level = store(
            sums.select("left", "right", F.coalesce("lang", "_lang").alias("lang"), F.coalesce("phrase", F.concat_ws(" ", "_head", "_tail")).alias("phrase"), "n"),
            "phrases",
        )
        found = found.unionByName(level.select("lang", "phrase", F.lit(m).alias("m"), "n"))
        if m == longest:
            break
        able = level.where("left is not null")
        inside = F.col("left").isNotNull() & (_step(F.col("n")) >= _lowest_step(able, ranked))
        top = level.where(inside).toPandas().sort_values(["n", "left", "right"], ascending=[False, True, True])
        keys = top["left"].to_numpy(np.int64) << 32 | top["right"].to_numpy(np.int64)
        order = np.argsort(keys)
        levels = [*levels, Phrases(keys[order], order.astype(np.int32), _sieve(level.where(~inside), v.seed, bits))]
        names = _named(docs, top["lang"].tolist(), top["phrase"].tolist())
    return found, totals


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, ranked: int = RANKED, bits: int = SIEVE_BITS) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    counts, totals = phrase_counts(docs, least, longest, ranked, bits)
    long = counts.where("m > 1")
    inner = long.where("m > 2").select(
        "lang", "n", F.explode(F.array(F.expr("substring_index(phrase, ' ', m - 1)"), F.expr("substring_index(phrase, ' ', 1 - m)"))).alias("_inner")
    )
    inner = inner.groupBy(F.col("lang").alias("_lang"), "_inner").agg(F.max("n").alias("_most"))
    kept = long.join(inner, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_inner")), "left")
    kept = kept.where(F.col("_most").isNull() | (F.col("_most") < F.col("n"))).select("lang", "phrase", "m", F.col("n").alias("a"))
    parts = kept.select("*", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    parts = parts.withColumn("_first", F.expr("substring_index(phrase, ' ', k)")).withColumn("_rest", F.expr("substring_index(phrase, ' ', k - m)"))
    hot = counts.where(_step(F.col("n")) >= _lowest_step(counts, HOT))
    parts = _with_count(_with_count(parts, "_first", "l", counts, hot), "_rest", "r", counts, hot)
    totals = small_side(totals.select(F.col("lang").alias("_lang"), F.col("n").alias("n")), 64)
    parts = parts.join(totals, F.col("lang") == F.col("_lang"))
    score = F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(18,0)) * cast(n as decimal(18,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    best = parts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b"))
    rows = best.select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score")
    # First within shares of a language, so that no task sees a whole one.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
