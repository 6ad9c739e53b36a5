"""Spelling variants: words one edit from a much more frequent word are its variants.

Letters are hashed to a few symbols, so a word becomes a reduced word over a tiny alphabet. Two
words one edit apart have reduced words that are equal or one edit apart; therefore the one-edit
neighbourhood of every reduced word is generated and joined with the reduced vocabulary. Each
pair is to be met from one side: an inserted symbol is the deletion seen from the longer word,
and of two substitutions the one towards the larger symbol is made. An edit leaves one half of
the word as it was; the letters of that half are part of the key, so that words which merely
reduce alike do not meet. Keys are 64-bit hashes, computed for all edits of all words at once
from prefix sums; pairs that meet are verified on the words themselves.

Words of up to ``CARRIED`` letters travel with their keys and are verified where they meet;
longer ones are known by their id until then, so a very long word costs in proportion to its
length. A word has at most about 120 neighbours per letter; no group grows with the corpus. A null or empty text
has no words, a null id is an empty one, equal rows count each time, ties go to the word that
comes first in code-point order, and other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from labelwright.llm.arrays import mixed, piece_hashes, powers, prefix_sums
from labelwright.sources.scratch import store

LEAST_CHARS = 7
LEAST_COUNT = 2
TIMES = 10
SYMBOLS = 4
EVERY = 31
DISTINCT = 1 << 18
RUN_LETTERS = 1 << 17
CARRIED = 24

_RUN = re.compile(b"[A-Za-z\xc0-\xff]{%d,}" % LEAST_CHARS)
_FIRST, _LAST = np.uint64(0x8CB92BA72F3D8DD7), np.uint64(0xAAAAAAAB5A17C1E3)


def words_of(doc_id: str, text: str) -> Counter:
    """Words of one text with their counts, one letter dropped where the hash says so.

    In Latin-1 every letter of a run is one byte, and bytes are lower-cased for A-Z only.
    """
    found = Counter(_RUN.findall(text.encode("latin-1", "replace").lower()))
    base = zlib.crc32(f"{doc_id}:".encode())
    out = Counter()
    for run, n in found.items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), base)
        if h % EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_CHARS:
                continue
        out[run] += n
    return out


def vocabulary(docs: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that occur often enough."""
    source = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.coalesce("text", F.lit("")).alias("_text"))

    def batch_of(total):
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in total], pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    def counted(batches):
        total = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                total.update(words_of(doc_id.as_py(), text.as_py()))
                if len(total) >= DISTINCT:
                    yield batch_of(total)
                    total = Counter()
        yield batch_of(total)

    words = source.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return words.where(F.col("n") >= least_count)


def symbols_of(symbols: int) -> np.ndarray:
    """The symbol of each letter, a hash of its code point."""
    return (mixed(np.arange(256, dtype=np.uint64) + np.uint64(17)) % np.uint64(symbols)).astype(np.uint8)


def _keys(reduced: np.ndarray, side: np.ndarray, half: np.ndarray) -> np.ndarray:
    return mixed(reduced ^ mixed(half ^ side)).view(np.int64)


class _Letters:
    """Words as one array of letters, with hashes of any part of them or of their reduced form."""

    def __init__(self, raws: list[bytes], symbols: int):
        size = np.array([len(r) for r in raws], np.int64)
        self.end = np.cumsum(size)
        self.start = self.end - size
        self.size = size
        letters = np.frombuffer(b"".join(raws), np.uint8)
        self.letters = letters
        self.reduced = symbols_of(symbols)[letters]
        self.exact_sums = prefix_sums(letters)
        self.reduced_sums = prefix_sums(self.reduced)
        self.power, self.back = powers(len(letters) + 2)

    def half(self, start, end):
        return piece_hashes(self.exact_sums, start, end)

    def shifted(self, sums):
        """The sum of a whole word's symbols as if it began at place 0."""
        return sums * self.back[self.start]

    def own(self) -> np.ndarray:
        return self.shifted(self.reduced_sums[self.end] - self.reduced_sums[self.start])


def probes(w: _Letters) -> tuple[np.ndarray, np.ndarray]:
    """Row and key of the vocabulary itself: the reduced word with its first, and with its last half."""
    reduced, middle = w.own(), w.start + w.size // 2
    rows = np.arange(len(w.size))
    first = _keys(reduced, _FIRST, w.half(w.start, middle))
    last = _keys(reduced, _LAST, w.half(middle, w.end))
    return np.concatenate([rows, rows]), np.concatenate([first, last])


def neighbourhoods(w: _Letters, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and key of every edit of every reduced word, with the half that the edit leaves alone."""
    row = np.repeat(np.arange(len(w.size)), w.size)
    at = np.arange(len(row))
    place = at - w.start[row]
    whole = w.own()
    # Towards a larger symbol, one position at a time.
    middle = w.start + w.size // 2
    first, last = w.half(w.start, middle), w.half(middle, w.end)
    keep_first = at >= middle[row]
    side = np.where(keep_first, _FIRST, _LAST)
    half = np.where(keep_first, first[row], last[row])
    rows, keys = [], []
    for step in range(1, symbols):
        can = w.reduced + step < symbols
        moved = whole[row[can]] + np.uint64(step) * w.power[place[can]]
        rows.append(row[can])
        keys.append(_keys(moved, side[can], half[can]))
    # Equal symbols: the word itself, with either half.
    rows_own, keys_own = probes(w)
    # One symbol less: what lies behind the place moves one step down.
    before = (w.reduced_sums[at] - w.reduced_sums[w.start[row]]) * w.back[w.start[row]]
    behind = (w.reduced_sums[w.end[row]] - w.reduced_sums[at + 1]) * w.back[w.start[row]] * w.back[1]
    shorter = (w.size - 1) // 2
    first = w.half(w.start, w.start + shorter)
    last = w.half(w.start + shorter + 1, w.end)
    keep_first = place >= shorter[row]
    side = np.where(keep_first, _FIRST, _LAST)
    half = np.where(keep_first, first[row], last[row])
    rows, keys = np.concatenate([*rows, rows_own, row]), np.concatenate([*keys, keys_own, _keys(before + behind, side, half)])
    order = np.lexsort((keys, rows))
    rows, keys = rows[order], keys[order]
    new = np.append(True, (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1]))[: len(rows)]
    return rows[new], keys[new]


def _keyed(words: DataFrame, symbols: int, edits: bool) -> DataFrame:
    """(key, id, word) of the words themselves or of their neighbourhoods; a long word is left out."""

    def made(batches):
        for batch in batches:
            ids, raws = batch.column(0).to_numpy(), [x.encode("latin-1") for x in batch.column(1).to_pylist()]
            ends = np.cumsum([len(r) for r in raws])
            first = 0
            while first < len(raws):
                before = ends[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(ends, before + RUN_LETTERS, "right")))
                w = _Letters(raws[first:last], symbols)
                row, key = neighbourhoods(w, symbols) if edits else probes(w)
                named = pa.array([x.decode("latin-1") if len(x) <= CARRIED else None for x in raws[first:last]], pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids[first:last][row]), named.take(pa.array(row))], ["key", "id", "word"])
                first = last

    return words.select("id", "word").mapInArrow(made, "key long, id long, word string")


def near_pairs(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(x, nx, y, ny) of the words one edit apart, each pair once; words is (id, word, n)."""
    ours = _keyed(words, symbols, edits=True).select("key", F.col("id").alias("i"), F.col("word").alias("a"))
    theirs = _keyed(words, symbols, edits=False).select("key", F.col("id").alias("j"), F.col("word").alias("b"))
    may_be = F.coalesce(F.levenshtein("a", "b", 1) == 1, F.lit(True))
    met = ours.join(theirs, "key").where((F.col("i") != F.col("j")) & may_be).select("i", "j").distinct()
    x = words.select(F.col("id").alias("i"), F.col("word").alias("x"), F.col("n").alias("nx"))
    y = words.select(F.col("id").alias("j"), F.col("word").alias("y"), F.col("n").alias("ny"))
    pairs = met.join(x, "i").join(y, "j").where(F.levenshtein("x", "y", 1) == 1)
    # Words of one length meet under the key of their own symbols from both sides.
    same = F.length("x") == F.length("y")
    return pairs.select(
        F.when(same, F.least("x", "y")).otherwise(F.col("x")).alias("x"),
        F.when(same, F.greatest("x", "y")).otherwise(F.col("y")).alias("y"),
        F.when(same & (F.col("x") > F.col("y")), F.col("ny")).otherwise(F.col("nx")).alias("nx"),
        F.when(same & (F.col("x") > F.col("y")), F.col("nx")).otherwise(F.col("ny")).alias("ny"),
    ).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(form, root) of the words that are forms, by doubling the step along the forms.

    Counts rise tenfold with each step, so the longest way has a logarithm of the counts.
    """
    links = forms.where("form IS NOT NULL").select("word", "form")
    targets = links.select(F.col("form").alias("word")).distinct()
    ways = store(targets.join(links, "word", "left").select("word", F.coalesce("form", "word").alias("root")), "forms")
    while True:
        ahead = ways.select(F.col("word").alias("_word"), F.col("root").alias("_next"))
        further = store(ways.join(ahead, F.col("root") == F.col("_word")).select("word", F.col("_next").alias("root"), (F.col("_next") != F.col("root")).alias("moved")), "forms")
        ways = further.select("word", "root")
        if not further.where("moved").limit(1).count():
            return ways


def variants(docs: DataFrame, least_count: int = LEAST_COUNT, times: int = TIMES, symbols: int = SYMBOLS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = store(vocabulary(docs, least_count).select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")
    pairs = near_pairs(words, symbols)
    each = F.explode(
        F.array(
            F.struct(F.col("x").alias("word"), F.col("y").alias("other"), F.col("ny").alias("other_n")),
            F.struct(F.col("y").alias("word"), F.col("x").alias("other"), F.col("nx").alias("other_n")),
        )
    )
    best = F.min(F.struct((-F.col("e.other_n")).alias("less"), F.col("e.other").alias("other")))
    near = pairs.select(each.alias("e")).groupBy(F.col("e.word").alias("_word")).agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.join(near, F.col("word") == F.col("_word"), "left")
    much = -F.col("best.less") >= times * F.col("n")
    found = joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(much, F.col("best.other")).alias("form"),
        F.when(much, -F.col("best.less")).alias("form_n"),
    )
    found = store(found, "forms")
    ways = _roots(found).select(F.col("word").alias("_form"), F.col("root").alias("_root"))
    rows = found.join(ways, F.col("form") == F.col("_form"), "left")
    return rows.select("word", "form", F.coalesce("_root", "word").alias("root"), "n", "n_near", "form_n")
