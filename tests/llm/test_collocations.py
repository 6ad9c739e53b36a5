"""Phrases against a brute-force count, with every way of counting, and exact scores."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from labelwright.llm import collocations as C

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least, longest=5, top=2000):
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i : i + m])] += 1
    long = {k: n for k, n in f.items() if n >= least and len(k[1]) > 1}
    gone = {
        (lang, p[i : i + k])
        for (lang, p), n in long.items()
        for k in range(2, len(p))
        for i in range(len(p) - k + 1)
        if n >= f[lang, p[i : i + k]]
    }
    out = {}
    for (lang, p), a in long.items():
        if (lang, p) not in gone:
            cuts = [(1000 * a * total[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, total[lang], -s) for lang, found in out.items() for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)
    )


def corpus(seed=1, n=120):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "New", "york", "city", "größe", "x" * 30, "y" * 600, "ß\xa0ß", "日本", "a\x0bb", "tail", "über-lang", "q"]
    rows = []
    for i in range(n):
        words = []
        while len(words) < 60:
            words += rng.choice([["new", "York", "city"], ["the", "of"], ["ON", "the", "other", "hand", "side", "too"], rng.choices(vocabulary, k=3), [f"rare{rng.random()}"]])
        text = "".join(w + rng.choice([" "] * 9 + ["\t", "  ", ", ", ".", "\r\n", " ! "]) for w in words)
        rows.append((text, rng.choice(["en", "en", "de", None, "und"])))
    return rows + [(None, "en"), ("", "fr"), (" \t", None), ("one", "fr"), (rows[0][0], rows[0][1]), ("the of " * 30_000, "zz"), ("z" * 20_000 + " the", "zz")]


ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, g, 1, "x") for i, (t, g) in enumerate(ROWS)], "doc_id long, text string, lang string, n int, phrase string").repartition(5).cache()


@pytest.mark.parametrize("ranked,bits", [(C.RANKED, C.SIEVE_BITS), (0, 64), (5, 128), (9, 1 << 16), (40, 64)])
def test_equals_brute_force(docs, ranked, bits, monkeypatch):
    """All ids ranked; none; a few, with a bitmap that lets nearly everything through or little."""
    monkeypatch.setattr(C, "RUN_BYTES", 5_000)
    monkeypatch.setattr(C, "TEXTS", 50)
    for least in (8, 3) if ranked == 9 else (8,):
        got = C.collocations(docs, least, ranked=ranked, bits=bits).collect()
        assert sorted(map(tuple, got)) == brute(ROWS, least)


def test_short_lists_and_ties(docs):
    got = C.collocations(docs, 4, top=7).collect()
    assert sorted(map(tuple, got)) == brute(ROWS, 4, top=7)


def test_empty(docs):
    assert C.collocations(docs.limit(0)).count() == 0
    assert C.collocations(docs.where("lang = 'fr'"), 1).count() == 0


@pytest.mark.parametrize("dense_from,coordinates", [(1, 1 << 21), (1 << 30, 4), (40, 64)])
def test_tiles(monkeypatch, dense_from, coordinates):
    monkeypatch.setattr(C, "DENSE_FROM", dense_from)
    monkeypatch.setattr(C, "COORDINATES", coordinates)
    rng, tiles, want, got = np.random.default_rng(0), C.Tiles(), Counter(), Counter()

    def take(part):
        for l, r, n in zip(*part):
            got[int(l), int(r)] += int(n)

    for size in (0, 5, 900, 3000):
        left, right = (rng.zipf(1.3, size).clip(1, 100_000).astype(np.int32) - 1 for _ in range(2))
        tiles.add(left, right)
        want.update(zip(left.tolist(), right.tolist()))
        if tiles.full():
            take(tiles.sparse())
    take(tiles.sparse())
    for part in tiles.tiles():
        take(part)
    assert got == want


def test_scores_beyond_64_bits(spark, monkeypatch):
    """Counts as of a very large corpus: products need more than 64 bits and stay exact."""
    big = 3_000_000_000_001
    counts = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big - 7), ("en", "a b", 2, big - 11)], "lang string, phrase string, m int, n long")
    totals = spark.createDataFrame([("en", 90_000_000_000_017)], "lang string, n long")
    monkeypatch.setattr(C, "phrase_counts", lambda *_: (counts, totals))
    got = C.collocations(counts).first()
    assert got.score == 1000 * (big - 11) * 90_000_000_000_017 // (big * (big - 7))
