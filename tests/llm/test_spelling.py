"""Variants against a brute-force version over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from labelwright.llm import spelling as S

LOWER = {c: c + 32 for c in range(65, 91)}


def brute_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    n = brute_words(rows)
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(4)
    base = ["reading", "leading", "Größenwahn", "aaaaaaaa", "bbbbbbbbb", "abababab", "naïveté", "information", "ÀÉÎÕÜÿ÷×", "committee"]
    letters = "abdegnré"
    rows = []
    for i in range(400):
        words = []
        for _ in range(30):
            w = rng.choice(base[: rng.choice([1, 2, 4, 10])])
            for _ in range(rng.choice([0] * 12 + [1, 1, 2])):
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :]])
            words.append(rng.choice([w, w.upper(), w]))
        rows.append((i, rng.choice([" ", ", ", "1", "-日-"]).join(words)))
    long = "q" * 3000 + "longword"
    rows.append((600, "chainxaaaaa " * 2000 + "chainxaaaab " * 200 + "chainxaaabb " * 20 + "chainxaabbb " * 2))
    return rows + [(None, "reading Reading"), (500, None), (501, ""), (502, long), (502, long), (503, long[:-1] + " " + long[:-1]), (7, rows[7][1]), (504, "short x"), (505, "é" * 9 + " " + "É" * 9)]


ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "x", 1) for r in ROWS], "doc_id long, text string, word string, n int").repartition(6).cache()


def test_equals_brute_force(docs, monkeypatch):
    want = brute(ROWS)
    assert sum(r[1] is not None for r in want) > 50 and any(r[1] and r[2] != r[1] for r in want)
    for symbols, distinct, run, carried in ((4, 1 << 18, 1 << 17, 24), (2, 7, 50, 0), (9, 100, 1, 8)):
        monkeypatch.setattr(S, "CARRIED", carried)
        monkeypatch.setattr(S, "DISTINCT", distinct)
        monkeypatch.setattr(S, "RUN_LETTERS", run)
        assert sorted(map(tuple, S.variants(docs, symbols=symbols).collect()), key=str) == want


def test_every_near_pair_meets_under_a_key():
    """All words of a small alphabet: the keys of near pairs meet, whatever letters share a symbol."""
    rng = random.Random(1)
    words = sorted({"".join(rng.choices("abcé", k=rng.choice([7, 8]))) for _ in range(500)})
    for symbols in (1, 2, 3, 5):
        w = S._Letters([x.encode("latin-1") for x in words], symbols)
        own, met = {}, set()
        for row, key in zip(*S.probes(w)):
            own.setdefault(int(key), []).append(int(row))
        for row, key in zip(*S.neighbourhoods(w, symbols)):
            met.update((int(row), j) for j in own.get(int(key), ()))
        for i, a in enumerate(words):
            for j in range(i):
                if one_edit(a, words[j]):
                    assert (i, j) in met or (j, i) in met


def test_a_long_word_costs_in_proportion():
    w = S._Letters([b"ab" * 100_000], 4)
    row, key = S.neighbourhoods(w, 4)
    assert len(row) < 200_000 * 4 and len(np.unique(key)) == len(key)


def test_empty(docs):
    assert S.variants(docs.limit(0)).count() == 0
    assert S.variants(docs.where("doc_id = 504")).count() == 0


def test_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n = brute_words([tuple(r) for r in table.select("doc_id", "text").collect()])
    got = {r.word: r for r in S.variants(table).collect()}
    assert {w: r.n for w, r in got.items()} == n
    for w in random.Random(0).sample(sorted(got), 60):
        found = [v for v in n if one_edit(w, v)]
        best = min(found, key=lambda v: (-n[v], v), default=None)
        assert got[w].n_near == len(found)
        assert got[w].form == (best if best and n[best] >= 10 * n[w] else None)
