"""Personal data, and the words that would give it away.

Fixed patterns find protected entities: mail and network addresses, card and phone numbers.
The corpus says how strongly a word reveals an entity: of the df(t) documents with the word,
co(e, t) hold the entity too, so whoever sees the word can name the entity with a probability
of co / df, which leaves -log2(co / df) bits of it untold. The probability is taken at the lower
end of a confidence interval (Wilson), whose sample are distinct contents, so copies of a
document prove nothing and one document alone never does. Words that leave at most ``left``
bits are disclosing: everywhere in the documents that hold the entity, numbers are generalised
to their shape and other words removed.

Words are counted over whole documents. Entities that stand in the same documents are counted
as one, and only words are paired with them that are rare enough to be disclosing at all, so
pairs grow with the documents that hold entities. Document frequencies cover every word of
every document and are summed in the workers before they are dealt out.

Defined results: null is the empty text; equal rows are scanned each on their own; entities
are compared in lower case.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from labelwright.llm import arrays
from labelwright.sources.scratch import store

KINDS = ("email", "ip", "card", "phone", "term")
LEFT = 1.0
CONFIDENCE = 1.2816  # one-sided 90 %
FLUSH = 1_000_000

# Fixed patterns; possessive digits and the look behind only keep long runs linear.
_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IN_WORD = arrays.table(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def entities(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed kinds, in order."""
    out, last = [], 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, 0, m.end()))
            last = m.end()
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _digits(m[0])
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def words_of(text: str, found: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end in code points of every word outside the entities, as word frequencies hash them."""
    raw = text.encode()
    low = _LOWER[np.frombuffer(raw, np.uint8)]
    start, end, _ = arrays.spans_of(_IN_WORD[low], np.array([0, len(low)]))
    hashed = arrays.piece_hashes(arrays.prefix_sums(low), start, end).view(np.int64)
    # Code points up to a byte are those bytes that do not continue one.
    points = np.concatenate([[0], np.cumsum((low & 0xC0) != 0x80)])
    start, end = points[start], points[end]
    protected = np.zeros(len(text) + 1, np.int64)
    for s, _, e in found:
        protected[s:e] = 1
    inside = np.concatenate([[0], np.cumsum(protected)])
    free = inside[end] == inside[start]
    return hashed[free], start[free], end[free]


def _name(kind: int, value: str) -> int:
    return xxhash.xxh64_intdigest(f"{kind}:{value.lower()}") - (1 << 63)


_WORDS_TYPE = pa.list_(pa.struct([("t", pa.int64()), ("s", pa.int32()), ("f", pa.int32())]))
_WORDS = "array<struct<t:long,s:int,f:int>>"
_SPANS_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _listed(columns: list[np.ndarray], bounds: list[int]) -> pa.Array:
    parts = pa.StructArray.from_arrays([pa.array(columns[0], pa.int64()), *(pa.array(c, pa.int32()) for c in columns[1:])], ["t", "s", "f"])
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), parts)


def _scanned(docs: DataFrame, keep_text: bool) -> DataFrame:
    """Per document its base spans and content hash; of those with entities also these and all words. Stored."""
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    key = source.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "_base", "_content", "_entities", "_words", *(["_text"] if keep_text else [])]
    nothing = (np.zeros(0, np.int64),) * 3

    def scanned(batches):
        for batch in batches:
            for part in range(0, len(batch), 256):
                rows = batch.slice(part, 256)
                spans, content, named, words, bounds = [], [], [], [], [0]
                for text in rows.column(1):
                    text = text.as_py()
                    found = entities(text)
                    spans.append([{"start": s, "kind": k, "end": e} for s, k, e in found])
                    content.append(xxhash.xxh64_intdigest(text) - (1 << 63))
                    named.append(sorted({_name(k, text[s:e]) for s, k, e in found}))
                    words.append(words_of(text, found) if found else nothing)
                    bounds.append(bounds[-1] + len(words[-1][0]))
                columns = [
                    rows.column(0),
                    pa.array(spans, _SPANS_TYPE),
                    pa.array(content, pa.int64()),
                    pa.array(named, pa.list_(pa.int64())),
                    _listed([np.concatenate(c) for c in zip(*words)], bounds),
                ]
                yield pa.RecordBatch.from_arrays(columns + ([rows.column(1)] if keep_text else []), names)

    schema = f"doc_id {key}, _base {_SPANS}, _content long, _entities array<long>, _words {_WORDS}" + (", _text string" if keep_text else "")
    return store(source.mapInArrow(scanned, schema).withColumn("_at", F.monotonically_increasing_id()), "entities")


def word_frequencies(docs: DataFrame) -> DataFrame:
    """(_t, _df): documents with each word, every word of every document."""

    def counted(batches):
        words, counts, held = [], [], 0

        def summed():
            w, index = np.unique(np.concatenate(words), return_inverse=True)
            n = np.bincount(index, np.concatenate(counts)).astype(np.int64)
            return w, n

        for batch in batches:
            body, offsets = arrays.flat(batch.column(0))
            for a, b in arrays.runs(offsets):
                low, at = _LOWER[body[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a]
                start, end, row = arrays.spans_of(_IN_WORD[low], at)
                if not len(start):
                    continue
                hashed = arrays.piece_hashes(arrays.prefix_sums(low), start, end)
                order = np.lexsort((row, hashed))
                h, r = hashed[order], row[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
                w, n = np.unique(h[new], return_counts=True)
                words.append(w)
                counts.append(n)
                held += len(w)
                if held > FLUSH:
                    w, n = summed()
                    words, counts, held = [w], [n], len(w)
                    if held > FLUSH // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n)], ["_t", "_n"])
                        words, counts, held = [], [], 0
        if words:
            w, n = summed()
            yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n)], ["_t", "_n"])

    source = docs.select(F.col("text").cast("binary").alias("_text"))
    return source.mapInArrow(counted, "_t long, _n long").groupBy("_t").agg(F.sum("_n").alias("_df"))


def lower_bound(share, n, z: float):
    """Lower end of the Wilson interval of a share of n cases; columns or numbers."""
    root = (share * (1 - share) / n + z * z / (4 * n * n)) ** 0.5
    return (share + z * z / (2 * n) - z * root) / (1 + z * z / n)


def least_contents(left: float, z: float) -> int:
    """Distinct contents that a word needs at least, if it never stands without the entity."""
    n = 1
    while lower_bound(1.0, n, z) < 2.0**-left:
        n += 1
    return n


def disclosing(scanned: DataFrame, docs: DataFrame, left: float = LEFT, confidence: float = CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """Documents of entity classes (_at, _class), and the words that disclose them (_class, _t, _share)."""
    least, share = least_contents(left, confidence), 2.0**-left
    held = scanned.select("_at", "_content", F.explode("_entities").alias("_e"))
    per_content = held.groupBy("_e", "_content").agg(F.count(F.lit(1)).alias("_n"), F.bit_xor(F.xxhash64("_at")).alias("_x"), F.bit_xor(F.xxhash64("_at", F.lit(1))).alias("_y"))
    entity = per_content.groupBy("_e").agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_contents"), F.bit_xor("_x").alias("_x"), F.bit_xor("_y").alias("_y"))
    # Entities of the same documents have the same sums over them.
    entity = entity.where(F.col("_contents") >= least).select("_e", "_rows", F.xxhash64("_x", "_y", "_rows").alias("_class"))
    entity = store(entity.withColumnRenamed("_e", "_name"), "named")
    classes = held.join(entity, F.col("_e") == F.col("_name")).groupBy("_at", "_content", "_class").agg(F.max("_rows").alias("_rows"))
    classes = store(classes, "classes")
    widest = F.col("_rows") / share
    reach = classes.groupBy(F.col("_at").alias("_a")).agg(F.max(widest).alias("_reach"))
    most = reach.agg(F.max("_reach")).first()[0] or 0.0
    frequency = word_frequencies(docs).where((F.col("_df") >= least) & (F.col("_df") <= most)).select(F.col("_t").alias("_w"), "_df")
    words = scanned.join(reach, F.col("_at") == F.col("_a")).select("_at", "_reach", F.explode(F.array_distinct(F.transform("_words", lambda w: w["t"]))).alias("_t"))
    words = words.join(frequency, F.col("_t") == F.col("_w")).where(F.col("_df") <= F.col("_reach")).select(F.col("_at").alias("_a"), "_t", "_df")
    pairs = classes.join(words, F.col("_at") == F.col("_a")).where(F.col("_df") <= widest)
    by_content = pairs.groupBy("_class", "_t", "_df", "_content").agg(F.count(F.lit(1)).alias("_n"))
    together = by_content.groupBy("_class", "_t", "_df").agg(F.sum("_n").alias("_co"), F.count(F.lit(1)).alias("_contents"))
    # A hash that two words share may make a word seem rarer than it is, never the other way round.
    told = F.least(F.col("_co") / F.col("_df"), F.lit(1.0))
    known = together.withColumn("_share", lower_bound(told, F.col("_contents") / told, confidence))
    return classes.select("_at", "_class"), known.where(F.col("_share") >= share).select("_class", "_t", "_share")


def _disclosed_spans(scanned: DataFrame, docs: DataFrame, left: float, confidence: float) -> DataFrame:
    classes, told = disclosing(scanned, docs, left, confidence)
    words = told.select(F.col("_class").alias("_c"), F.col("_t").alias("_told"))
    wanted = classes.join(words, F.col("_class") == F.col("_c")).select(F.col("_at").alias("_a"), "_told").distinct()
    wanted = store(wanted, "told")
    rows = scanned.join(wanted.select(F.col("_a").alias("_b")).distinct(), F.col("_at") == F.col("_b"), "left_semi")
    each = rows.select("_at", F.explode("_words").alias("w"))
    hit = each.join(wanted, (F.col("_at") == F.col("_a")) & (F.col("w.t") == F.col("_told")))
    span = F.struct(F.col("w.s").alias("start"), F.lit(4).alias("kind"), F.col("w.f").alias("end"))
    return hit.groupBy(F.col("_at").alias("_a")).agg(F.collect_set(span).alias("_terms"))


def _written(spans) -> object:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def personal_data(docs: DataFrame, left: float = LEFT, confidence: float = CONFIDENCE) -> DataFrame:
    """One row per document: counts and hash of the fixed kinds, all spans, and the number of disclosing words."""
    rows = _scanned(docs, False)
    terms = _disclosed_spans(rows, docs, left, confidence)
    out = rows.select("_at", "doc_id", "_base").join(terms, F.col("_at") == F.col("_a"), "left")
    more = F.coalesce("_terms", F.array().cast(_SPANS))
    count = lambda kind: F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long")
    return out.select(
        "doc_id",
        *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:4])],
        F.sha2(_written(F.col("_base")), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat("_base", more))).alias("spans"),
        F.size(more).cast("long").alias("n_terms"),
    )


def generalised(word: str) -> str:
    """What stands for a disclosed word: its shape if it holds a digit, else nothing."""
    if any(c.isdigit() for c in word):
        return "".join("0" if c.isdigit() else "x" for c in word)
    return ""


def sanitised(docs: DataFrame, left: float = LEFT, confidence: float = CONFIDENCE) -> DataFrame:
    """doc_id and text: entities replaced by their kind, disclosing words generalised or removed."""
    rows = _scanned(docs, True)
    terms = _disclosed_spans(rows, docs, left, confidence)
    out = rows.select("_at", "doc_id", "_text", "_base").join(terms, F.col("_at") == F.col("_a"), "left")
    spans = F.array_sort(F.concat("_base", F.coalesce("_terms", F.array().cast(_SPANS))))
    source = out.select("doc_id", "_text", spans.alias("_spans"))
    key = source.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                left, place = [], 0
                for s in spans:
                    if s["start"] < place:
                        place = max(place, s["end"])
                        continue
                    kind = KINDS[s["kind"]]
                    new = generalised(text[s["start"] : s["end"]]) if kind == "term" else f"[{kind.upper()}]"
                    left += [text[place : s["start"]], new]
                    place = s["end"]
                texts.append("".join([*left, text[place:]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return source.mapInArrow(cut, f"doc_id {key}, text string")

