"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters in lower case and single spaces make the n-grams. Counts per language and bucket are
summed in Spark over a bounded number of labelled documents per language; the matrix of
logarithms (languages x buckets) is broadcast, and batches of whole texts are scored with
sparse sums over it. The score is the posterior probability of the best language.

Defined results: `und` and score 0 for a null text, one without a letter, and when nothing
could be learned; ties go to the smaller language name; equal rows get equal results. The
language column is read only to learn.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

UNKNOWN = "und"
ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
DOCS_PER_LANGUAGE = 5_000
MAX_LANGUAGES = 256
SMOOTHING = 0.5
RUN_CHARS = 1 << 19
MIN_SCORE = 0.5


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(texts: list[str]):
    """Bucket of every n-gram, row of each, for each order; letters per row."""
    low = [t.lower() for t in texts]
    n_chars = np.array([len(t) + 1 for t in low])
    codes = np.frombuffer("\n".join([*low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(low)), n_chars)
    letter = _letters()[codes]
    found = np.bincount(row[letter], minlength=len(low))
    keep = letter.copy()
    keep[1:] |= letter[:-1] & (row[1:] == row[:-1])
    x = np.where(letter, codes, np.uint32(32))[keep].astype(np.uint64)
    row = row[keep]
    out = []
    for n in ORDERS:
        if len(x) < n:
            continue
        h = np.full(len(x) - n + 1, np.uint64(n * 0x9E37))
        for k in range(n):
            h = (h ^ x[k : len(x) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        same = row[: len(h)] == row[n - 1 :]
        out.append(((h[same] % np.uint64(BUCKETS)).astype(np.int64), row[: len(h)][same]))
    return out, found


def _batches(batch: pa.RecordBatch, column: int):
    """Texts in runs of bounded length: (first row, texts)."""
    texts = batch.column(column).to_pylist()
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > RUN_CHARS:
            yield first, [x or "" for x in texts[first:i]]
            first, size = i, 0
        size += len(t or "")
    if first < len(texts):
        yield first, [x or "" for x in texts[first:]]


class Model:
    """Language names in order, and the logarithms of their n-gram probabilities."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        total = counts.sum(axis=0) + SMOOTHING * BUCKETS
        self.logs = np.log((counts + SMOOTHING) / total).astype(np.float32)

    def score(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        found, letters = grams(texts)
        sums = np.zeros((len(texts), len(self.names)))
        for bucket, row in found:
            if len(row):
                at = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
                sums[row[at]] += np.add.reduceat(self.logs[bucket], at, axis=0, dtype=np.float64)
        if not self.names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        best = sums.argmax(axis=1)
        share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
        names = [self.names[b] if n else UNKNOWN for b, n in zip(best, letters)]
        return names, np.where(letters > 0, share, 0.0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(labelled: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """Learn from text and lang of at most about docs_per_language documents per language.

    Rows are chosen by a hash of the text, so the choice does not depend on partitioning.
    """
    rows = labelled.select("text", F.col("lang").alias("lang")).where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    names = sorted(sizes)
    if not names:
        return Model([], np.zeros((BUCKETS, 0)))
    share = F.create_map([F.lit(x) for n in names for x in (n, min(1.0, docs_per_language / sizes[n]))])
    chosen = rows.where(F.pmod(F.xxhash64("text", F.lit("learn")), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000)
    index = {n: i for i, n in enumerate(names)}

    def counted(batches):
        total = np.zeros((len(names), BUCKETS), np.int64)
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for first, texts in _batches(batch, 0):
                lang = np.array([index[x] for x in langs[first : first + len(texts)]])
                for bucket, row in grams(texts)[0]:
                    total += np.bincount(lang[row] * BUCKETS + bucket, minlength=total.size).reshape(total.shape)
        at, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bucket), pa.array(total[at, bucket])], ["lang", "bucket", "n"])

    sums = chosen.mapInArrow(counted, "lang long, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((BUCKETS, len(names)))
    counts[sums["bucket"], sums["lang"]] = sums["n"]
    return Model(names, counts)


def predict(docs: DataFrame, model: Model, keep: list[str] = ("doc_id",)) -> DataFrame:
    """The kept columns, lang_pred and score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col("text").alias("_text"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"))

    def scored(batches):
        for batch in batches:
            for first, texts in _batches(batch, 0):
                names, share = sent.value.score(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(first, len(texts)), pa.array(names, pa.string()), pa.array(share, pa.float64())],
                    ["_row", "_lang", "_score"],
                )

    kind = source.schema["_row"].dataType.simpleString()
    return source.mapInArrow(scored, f"_row {kind}, _lang string, _score double")


def identify(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows that are not held out."""
    model = fit(docs.where(~held_out(F.col("doc_id"))), docs_per_language)
    return predict(docs, model).select(
        "_row.doc_id", held_out(F.col("_row.doc_id")).alias("held_out"), F.col("_lang").alias("lang_pred"), F.col("_score").alias("score")
    )


def recognised(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of docs with a learned language, all columns kept."""
    model = fit(docs.where(~held_out(F.col("doc_id"))), docs_per_language)
    found = predict(docs, model, docs.columns)
    return found.where((F.col("_lang") != UNKNOWN) & (F.col("_score") >= min_score)).select("_row.*")
