"""Cross-document line frequency, with per-document counts of words, lines and repeats.

A line is normalised to its words in lower case, digits as 0, and hashed. Lines found in more
than ``max_docs`` distinct documents of one host are removed; a document that loses more than
``max_lost`` of its words so is depleted and rejected. One Arrow pass counts and hashes; its
small result is written once, so that lines are counted and held against documents by row
number. Hosts are dealt out by (host, line), with partial counts first.

Defined results: a null text has no words; a null host is a host of its own; equal rows are
documents of their own; a text without words is failed, never an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from labelwright.llm import arrays
from labelwright.llm.rows import small_side
from labelwright.sources.scratch import store

MAX_DOCS = 20
MAX_LOST = 0.5
MIN_WORDS = 50

_WORD = arrays.table(r"[^\x20\x09-\x0D]")
_SYMBOL = arrays.table(r"[#*$%&|<>]")
_START = np.array([b & 0xC0 != 0x80 for b in range(256)])
_NORMAL = np.arange(256, dtype=np.uint8)
_NORMAL[65:91] += 32
_NORMAL[48:58] = 48

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _sequences(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of runs of 64-bit values."""
    p, back = arrays.powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * p[: len(values)], out=sums[1:])
    return arrays.mixed((sums[last] - sums[first]) * back[first])


def _repeats(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs twice or more."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    twin = np.zeros(len(s), bool)
    if len(s):
        twin[1:] = s[1:] == s[:-1]
        twin[:-1] |= s[1:] == s[:-1]
    out = np.zeros(len(s), bool)
    out[order] = twin
    return out


def lines_of(body: np.ndarray, offsets: np.ndarray):
    """Words and the lines that hold one: (word start, end, row; line's first word, start, end, row)."""
    start, end, row = arrays.spans_of(_WORD[body], offsets)
    breaks = np.flatnonzero(body == 10)
    after = np.searchsorted(breaks, start)
    edge = np.concatenate([[-1], breaks, [len(body)]])
    begin = np.maximum(edge[after] + 1, offsets[row])
    new = np.ones(len(start), bool)
    new[1:] = (begin[1:] != begin[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    stop = np.minimum(edge[after[first] + 1], offsets[row[first] + 1])
    return start, end, row, first, begin[first], stop, row[first]


def measure(body: np.ndarray, offsets: np.ndarray):
    """Per row the base counts; per line with a word its row, normalised hash and words."""
    n = len(offsets) - 1
    start, end, row, first, begin, stop, line_row = lines_of(body, offsets)
    inside = _WORD[body]
    salt = arrays.mixed(np.arange(1, n + 1, dtype=np.uint64))
    hashed = arrays.piece_hashes(arrays.prefix_sums(body), start, end)
    whole = arrays.piece_hashes(arrays.prefix_sums(body), begin, stop) ^ salt[line_row] if len(first) else hashed[:0]
    distinct = np.unique(whole, return_index=True)[1]
    n_lines = np.bincount(line_row, minlength=n)
    dup = n_lines - np.bincount(line_row[distinct], minlength=n)
    again = np.zeros(len(row), bool)
    if len(row) > 2:
        same = row[2:] == row[:-2]
        a, b, c = hashed[:-2][same], hashed[1:-1][same], hashed[2:][same]
        keys = arrays.mixed(arrays.mixed(arrays.mixed(a ^ salt[row[2:][same]]) + b) + c)
        at = np.flatnonzero(same)[_repeats(keys)]
        for k in range(3):
            again[at + k] = True
    normal = arrays.piece_hashes(arrays.prefix_sums(_NORMAL[body]), start, end)
    last = np.append(first[1:], len(start))
    counts = {
        "n_words": np.bincount(row, minlength=n),
        "word_chars": arrays.row_sums(inside & _START[body], offsets),
        "n_symbols": arrays.row_sums(_SYMBOL[body], offsets),
        "n_dup_lines": dup,
        "n_repeat_words": np.bincount(row[again], minlength=n),
    }
    return counts, line_row, _sequences(normal, first, last), last - first


def _measured(docs: DataFrame, host: str, keep: list[str]) -> DataFrame:
    kept = [F.col(c) for c in keep]
    source = docs.select(F.col("text").cast("binary").alias("_text"), F.col(host).alias("_host"), F.struct("doc_id", *kept).alias("_row"))
    types = {f.name: f.dataType.simpleString() for f in source.schema.fields}

    def measured(batches):
        for batch in batches:
            body, offsets = arrays.flat(batch.column(0))
            for a, b in arrays.runs(offsets):
                counts, line_row, hashed, words = measure(body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                at = pa.array(np.searchsorted(line_row, np.arange(b - a + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).slice(a, b - a),
                        batch.column(2).slice(a, b - a),
                        *[pa.array(counts[m].astype(np.int64)) for m in MEASURES],
                        pa.ListArray.from_arrays(at, pa.array(hashed.view(np.int64))),
                        pa.ListArray.from_arrays(at, pa.array(words.astype(np.int32))),
                    ],
                    ["_host", "_row", *MEASURES, "_lines", "_words"],
                )

    schema = f"_host {types['_host']}, _row {types['_row']}, " + ", ".join(f"{m} long" for m in MEASURES) + ", _lines array<long>, _words array<int>"
    rows = source.mapInArrow(measured, schema)
    return store(rows.withColumn("_at", F.monotonically_increasing_id()), "lines")


def _frequent(rows: DataFrame, max_docs: int) -> DataFrame:
    """(host, line) found in more than max_docs documents.

    Rows are counted first; only lines of enough rows have their distinct documents counted.
    """
    each = rows.select("_host", F.col("_row.doc_id").alias("_doc"), F.explode(F.array_distinct("_lines")).alias("_line"))
    counted = each.groupBy("_host", "_line").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > max_docs)
    often = small_side(store(counted.select(F.col("_host").alias("_h"), F.col("_line").alias("_l")), "often"), 64)
    held = each.join(often, F.col("_host").eqNullSafe(F.col("_h")) & (F.col("_line") == F.col("_l"))).select("_h", "_l", "_doc").where("_doc is not null")
    documents = held.distinct().groupBy("_h", "_l").agg(F.count(F.lit(1)).alias("_docs"))
    return documents.where(F.col("_docs") > max_docs).select("_h", "_l")


def _matched(rows: DataFrame, max_docs: int) -> DataFrame:
    """Lines of documents that are frequent in their host: (_at, _line, n words)."""
    each = rows.select("_at", "_host", F.explode(F.arrays_zip("_lines", "_words")).alias("x"))
    each = each.select("_at", "_host", F.col("x._lines").alias("_line"), F.col("x._words").alias("_n"))
    common = _frequent(rows, max_docs)
    return each.join(common, F.col("_host").eqNullSafe(F.col("_h")) & (F.col("_line") == F.col("_l")), "inner")


def line_quality(
    docs: DataFrame,
    host: str = "source",
    max_docs: int = MAX_DOCS,
    max_lost: float = MAX_LOST,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """One row per document: base counts, frequent lines and words lost with them, verdict."""
    rows = _measured(docs, host, [])
    lost = _matched(rows, max_docs).groupBy(F.col("_at").alias("_a")).agg(F.count(F.lit(1)).alias("_n_lines"), F.sum("_n").alias("_n_lost"))
    out = rows.drop("_lines", "_words").join(lost, F.col("_at") == F.col("_a"), "left")
    zero = F.lit(0).cast("long")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    n_lost = F.coalesce("_n_lost", zero)
    return out.select(
        "_row.doc_id",
        *MEASURES,
        failed.alias("base_failed"),
        (~failed & (n_lost <= max_lost * F.col("n_words"))).alias("kept"),
        F.coalesce("_n_lines", zero).alias("n_frequent_lines"),
        n_lost.alias("n_lost_words"),
    )


def without_frequent_lines(docs: DataFrame, host: str = "source", max_docs: int = MAX_DOCS) -> DataFrame:
    """doc_id and text of every document without the lines that are frequent in its host."""
    rows = _measured(docs, host, ["text"])
    gone = _matched(rows, max_docs).groupBy(F.col("_at").alias("_a")).agg(F.collect_set("_line").alias("_gone"))
    out = rows.join(gone, F.col("_at") == F.col("_a"), "left").select(
        "_row.doc_id", F.col("_row.text").alias("text"), F.coalesce("_gone", F.array().cast("array<long>")).alias("_gone")
    )
    schema = docs.select("doc_id", "text").schema

    def cut(batches):
        for batch in batches:
            texts = []
            for text, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if gone:
                    raw = text.encode()
                    body = np.frombuffer(raw, np.uint8)
                    offsets = np.array([0, len(body)])
                    _, _, _, _, begin, stop, _ = lines_of(body, offsets)
                    _, _, hashed, _ = measure(body, offsets)
                    drop = np.isin(hashed.view(np.int64), np.array(gone, np.int64))
                    keep, place = [], 0
                    for s, e in zip(begin[drop].tolist(), stop[drop].tolist()):
                        keep.append(raw[place:s])
                        place = min(e + 1, len(raw))
                    text = b"".join([*keep, raw[place:]]).decode()
                texts.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return out.mapInArrow(cut, schema)
