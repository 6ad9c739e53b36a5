"""Suffix arrays against sorting, and removal against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from labelwright.llm import suffix_dedup as S


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.binary(max_size=80), st.text(alphabet="ab", max_size=120).map(str.encode), st.lists(st.sampled_from([b"abcabc", b"aaaa", b"zz", b"\0"]), max_size=25).map(b"".join)))
def test_order_and_prefixes(raw):
    body = np.frombuffer(raw, np.uint8)
    order = S.two_stage_order(body, 400).tolist()
    assert order == sorted(range(len(raw)), key=lambda i: raw[i:])
    prefixes = S.common_prefixes(body, np.array(order, np.int64), 30)
    for k in range(1, len(order)):
        a, b = raw[order[k - 1] :], raw[order[k] :]
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert prefixes[k] == min(n, 30)


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (d, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        left = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(t), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def made_rows():
    rng = random.Random(5)
    prose = lambda n: "".join(rng.choice("abcdefghijklmnop \né") for _ in range(n))
    passage, other = prose(70), prose(55)
    rows = [(i, prose(rng.randint(0, 120)) + passage + prose(rng.randint(0, 90))) for i in range(40)]
    rows += [(100 + i, prose(30) + other[: 40 + i] + prose(20)) for i in range(15)]
    rows += [(200, "ab" * 300), (201, "a" * 500), (202, prose(39)), (203, passage[:40]), (204, passage[:39]), (205, None), (206, "")]
    same = prose(300)
    rows += [(300, same), (300, same), (301, same), (None, same[:200] + "x" + same[201:]), (None, None), (302, passage + passage), (303, "x" * 40)]
    return rows


@pytest.mark.parametrize("hot", [3, 512])
def test_against_brute_force(spark, hot):
    rows = made_rows()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_bytes int").repartition(5)
    got = S.without_repeats(docs, length=40, gram=8, hot=hot).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute(rows, 40)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)
    assert S.without_repeats(docs.limit(0)).count() == 0


def test_real_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = S.without_repeats(docs).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute([tuple(r) for r in docs.collect()], S.LENGTH)


def test_common_windows_are_not_gathered(spark):
    """One window in half of the rows; shuffled by window, these would be one task's."""
    rows = [(1, i, 2, 0, 77) for i in range(4000)] + [(1, i, 2, 1, 1000 + i // 2 * (i < 3000) + i * (i >= 3000)) for i in range(4000)]
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "_key long, _sid long, _n int, _o int, _w long").repartition(8)
        found = S._met_again(df).withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    times = Counter(r[4] for r in rows)
    assert sorted(tuple(r)[:5] for r in found) == sorted(r for r in rows if times[r[4]] > 1)
    assert max(Counter(r.part for r in found).values()) < 0.3 * len(found)


def test_passages_of_many_words_go_from_the_contract_size_on(spark):
    """Passages of over 50 words in two documents each: whole from 400 bytes on, not at all below; sizes stay those of the input."""
    rng = random.Random(7)
    words = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 11))) for _ in range(n))
    passages = [words(rng.randint(51, 60)) for _ in range(20)]
    rows = [(2 * i + k, f"{words(40)} #{k} {p} {k}# {words(30)}") for i, p in enumerate(passages) for k in (0, 1)]
    rows += [(1000 + i, words(150)) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in S.without_repeats(docs).collect()}
    assert sorted((tuple(r)[:5] for r in got.values()), key=str) == brute(rows, S.LENGTH)
    lengths = {d: len(passages[d // 2]) + 2 for d, _ in rows if d < 1000}  # with the space on either side
    assert min(lengths.values()) < S.LENGTH < max(lengths.values())
    assert all(got[d].n_removed == (lengths.get(d, 0) if lengths.get(d, 0) >= S.LENGTH else 0) for d, _ in rows)
