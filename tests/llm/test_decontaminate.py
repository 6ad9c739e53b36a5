"""Decontamination against a brute-force version of the rule."""

import hashlib
import re

import pytest

from labelwright.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, size=D.WINDOW):
    windows = {}
    for i, text in items:
        w = words(text)
        if w:
            n = min(len(w), size)
            for s in range(len(w) - n + 1):
                windows.setdefault(tuple(w[s : s + n]), set()).add(i)
    lengths = {len(w) for w in windows}
    out = []
    for d, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                got = windows.get(tuple(w[s : s + n]))
                if got:
                    hit.update(range(s, s + n))
                    found |= got
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


ITEMS = [
    (1, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (2, "Short item here"),
    (3, "solo"),
    (4, None),
    (5, " .,;"),
    (6, "Größe ÄÖ 東京 mixed-case Words a a a a a a a a a a a"),
    (7, "Short item here"),
    (8, "a a a"),
]
DOCS = [
    (1, "x ONE, two three four five six seven eight nine ten eleven twelve thirteen fourteen y"),
    (2, None),
    (3, ""),
    (4, "short ITEM\nhere short item here"),
    (5, "solo"),
    (6, "a " * 5000),
    (7, "größe äö 東京"),
    (7, "two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (8, "word " * 400 + "solo"),
    (8, "word " * 400 + "solo"),
    (None, "Größe ÄÖ 東京 mixed case words a a a a a a a a a a a"),
    (9, "short item\x00here " * 3 + "z" * 300_000),
]


@pytest.mark.parametrize("limit", [D.BLOCK_BYTES, 100])
def test_rule(spark, limit):
    docs = spark.createDataFrame([(*d, 7) for d in DOCS], "doc_id long, text string, n_hit int")
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    got = D.hits(docs, items, block_bytes=limit).collect()
    assert sorted(map(tuple, got), key=str) == brute(DOCS, ITEMS)
    kept = D.clean_rows(docs, items)
    assert kept.columns == docs.columns
    bad = sum(r[-1] for r in brute(DOCS, ITEMS))
    assert kept.count() == len(DOCS) - bad


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert D.hits(docs.limit(0), items).count() == 0
    assert {r.n_hit for r in D.hits(docs, items.limit(0)).collect()} == {0}


def test_real_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows, [tuple(r) for r in items.collect()])
    assert sorted(map(tuple, D.hits(docs, items).collect()), key=str) == want
    longest = D.longest_matches(docs, items)
    assert longest.where("byte_end <= byte_start").count() == 0
    top = longest.where(f"n_words = {D.WINDOW}").limit(1).collect()
    if top:
        r, text = top[0], dict(rows)
        piece = text[r.doc_id].encode()[r.byte_start : r.byte_end].decode()
        item = dict(tuple(x) for x in items.collect())[r.item_id]
        assert words(piece) == words(item)[r.item_word : r.item_word + r.n_words]
