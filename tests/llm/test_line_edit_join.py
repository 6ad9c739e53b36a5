"""Edit join of lines against all pairs, and the bit-parallel distance against the plain one."""

import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from labelwright.llm import line_edit_join as L
from tests.llm.test_order_minhash import roots


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        at, kind = rng.randrange(len(out) + 1), rng.randrange(3)
        if kind == 0:
            out.insert(at, rng.choice("abé🤗"))
        elif out and kind == 1:
            out.pop(min(at, len(out) - 1))
        elif out:
            out[min(at, len(out) - 1)] = rng.choice("abé🤗")
    return "".join(out)


@pytest.mark.parametrize("edits", [0, 1, 2, 3, 5])
def test_distance(spark, edits):
    rng = random.Random(edits)
    pairs = [("", ""), ("a", ""), ("", "ab"), ("abc", "abc"), ("ab", "ba"), ("aaaa", "aa"), ("a" * 70, "a" * 71)]
    for _ in range(400):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(0, 40)))
        pairs.append((a, edited(rng, a, rng.randint(0, edits + 2))))
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", L.edit_distance(F.col("a"), F.col("b"), edits).alias("d")).collect()
    for r in rows:
        d = distance(r.a, r.b)
        assert r.d == (d if d <= edits else None), r


def brute(rows, edits, min_chars):
    docs = list(dict.fromkeys(rows))
    places, texts = {}, {}
    for d, t in docs:
        for i, line in enumerate((t or "").split("\n")):
            line = line.strip(" ")
            if len(line) >= min_chars:
                places.setdefault(line, []).append((d is None, d or 0, t, i))
    lines = sorted(places)
    pairs = [(a, b) for x, a in enumerate(lines) for b in lines[x + 1 :] if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits]
    root = roots(lines, pairs)
    n_links = {a: sum(a in p for p in pairs) for a in lines}
    groups = {}
    for a in lines:
        groups.setdefault(root[a], []).extend(places[a])
    linked = {a for a in lines if len(places[a]) > 1 or n_links[a]}
    out = []
    for d, t in rows:
        kept, links, gone, names, n = [], 0, 0, set(), 0
        for i, raw in enumerate((t or "").split("\n")):
            line = raw.strip(" ")
            n += len(line) >= min_chars
            if line in linked:
                first = min(groups[root[line]], key=lambda p: p[:2])
                firsts = [p for p in groups[root[line]] if p[:2] == first[:2]]
                assert len({p[2] for p in firsts}) == 1
                first = min(firsts, key=lambda p: p[3])
                links += n_links[line]
                names.add(f"{'' if first[0] else first[1]}:{first[3]}")
                if first[2:] != (t, i) or first[:2] != (d is None, d or 0):
                    gone += 1
                    continue
            kept.append(raw)
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((d, n, links, gone, digest, ",".join(sorted(names))))
    return sorted(out, key=str)


def made_rows():
    rng = random.Random(11)
    line = lambda n: "".join(rng.choice("abcdefg ") for _ in range(n)).strip() or "x"
    bases = [line(rng.randint(12, 40)) for _ in range(25)]
    rows = []
    for i in range(60):
        parts = [edited(rng, rng.choice(bases), rng.randint(0, 3)) for _ in range(rng.randint(1, 4))] + [line(rng.randint(0, 30))]
        rows.append((i, "\n".join(parts)))
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, bases[0] + "\n" + bases[0] + "\n  " + bases[0] + "  "), (103, "other " + bases[1])]
    rows += [(104, "short"), (105, "short"), (3, rows[3][1]), (None, bases[2] + "z"), (106, "y" * 3000 + "\n" + "y" * 3001)]
    head = "common beginning of very many lines "
    rows += [(200 + i, head + line(14)) for i in range(40)]
    return rows


@pytest.mark.parametrize("hot", [5, 64])
def test_lines(spark, hot):
    rows = made_rows()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_links int").repartition(5)
    got = L.near_equal_lines(docs, min_chars=10, hot=hot).collect()
    want = brute(rows, L.EDITS, 10)
    assert sorted(map(tuple, got), key=str) == want
    if hot == 64:
        assert L.near_equal_lines(docs.limit(0)).count() == 0
        kept = L.without_near_equal_lines(docs, min_chars=10)
        assert kept.columns == docs.columns
        left = sorted(hashlib.sha256((r.text or "").encode()).hexdigest() for r in kept.collect())
        empty = hashlib.sha256(b"").hexdigest()
        gone = [w[4] for w in want if not w[3] or w[4] != empty]
        assert [x for x in left if x != empty] == sorted(x for x in gone if x != empty)


def test_the_query_holds_short_lines_against_one_another(spark, tmp_path):
    from labelwright.llm.queries import QUERIES

    rows = [(1, "All rights kept\nAnd.\nThe."), (2, "All rights kept\nits own line of words\nAnd."), (3, "All right kept.\nAnd\n\n\n"), (4, "123456789\n12345678")]
    rows += [(5, "12345678\n1234567"), (6, "x123456789"), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_lines, r.n_links, r.n_removed) for r in QUERIES["op8_line_edit_join"](spark, str(tmp_path)).collect()}
    # Nine characters and more within two edits, shorter ones if they are equal.
    assert got == {1: (3, 1, 0), 2: (3, 1, 2), 3: (2, 1, 1), 4: (2, 1, 0), 5: (2, 0, 1), 6: (1, 1, 1), 7: (0, 0, 0)}
    assert sorted(map(tuple, L.near_equal_lines(docs).collect()), key=str) == brute(rows, 2, 9)


def test_real_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").where("doc_id < 30")
    rows = [tuple(r) for r in docs.collect()]
    assert sorted(map(tuple, L.near_equal_lines(docs).collect()), key=str) == brute(rows, L.EDITS, L.MIN_CHARS)


def test_one_long_document_of_repeated_lines(spark):
    """The cost of a document grows with its lines, not with lines times removals."""
    rows = [(1, "\n".join(f"line number {i % 50:05} {i % 50:05}" for i in range(60_000))), (2, "first here\n" * 3)]
    began = time.time()
    got = {r.doc_id: r for r in L.near_equal_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert time.time() - began < 90
    assert got[1].n_lines == 60_000 and got[1].n_removed >= 60_000 - 50 and got[2].n_removed == 2
