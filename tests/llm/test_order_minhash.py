"""Near-duplicate classes against all pairs, and components against union-find."""

import random

import numpy as np
from pyspark.sql import functions as F

from labelwright.llm import order_minhash as O
from labelwright.llm.components import components


def roots(n, pairs):
    parent = {x: x for x in n}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in n}


def test_components(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(90)]
    pairs += [(7, 7), (1, 0)]
    got = components(spark.createDataFrame(pairs, "u long, v long")).collect()
    nodes = {x for p in pairs for x in p if p[0] != p[1]}
    want = roots(nodes, pairs)
    assert sorted((r.node, r.root) for r in got) == sorted(want.items())
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def shingles(text):
    w = [x for x in (text or "").encode().replace(b"\n", b" ").replace(b"\t", b" ").split(b" ") if x]
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute(rows, wanted=0.8):
    """Classes by the Jaccard similarity of all pairs of distinct texts."""
    texts = {}
    for d, t in rows:
        texts.setdefault(t or "", []).append(d)
    sets = {t: shingles(t) for t in texts}
    order = sorted((t for t in texts if sets[t]), key=lambda t: len(sets[t]))
    pairs = []
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            if len(sets[a]) < wanted * len(sets[b]):
                break
            both = len(sets[a] & sets[b])
            if both >= wanted * (len(sets[a]) + len(sets[b]) - both):
                pairs.append((a, b))
    root = roots(order, pairs)
    least = {}
    for t in order:
        ids = [d for d in texts[t] if d is not None]
        least[root[t]] = min(least.get(root[t], 10**9), *ids, 10**9)
    return [(d, d if not sets[t or ""] else least[root[t or ""]]) for d, t in rows]


def made_rows():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    rows, ident = [], iter(range(10_000))
    for size in (30, 120, 400):
        for _ in range(6):
            base = [word() for _ in range(size)]
            rows.append((next(ident), " ".join(base)))
            for _ in range(4):
                copy = list(base)
                for _ in range(max(1, size // 60)):
                    copy[rng.randrange(size)] = word()
                rows.append((next(ident), " ".join(copy)))
            rows.append((next(ident), " ".join(base[: size // 2])))
    passage = [word() for _ in range(40)]
    rows += [(next(ident), " ".join(passage + [word() for _ in range(60)])) for _ in range(60)]
    rows += [(9000, None), (9001, ""), (9002, " \n"), (9003, "one two"), (9004, "one  two"), (9005, "one"), (9003, "one two"), (None, "one two three")]
    rows += [(9100 + i, "same line again and again\n" * (50 + i)) for i in range(3)]
    rows += [(9200, rows[0][1]), (9201, rows[0][1]), (9202, "z " * 30_000 + "end")]
    return rows


def test_classes(spark):
    rows = made_rows()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, class_id int").repartition(6)
    got = O.near_duplicates(docs).collect()
    want = brute(rows)
    key = lambda x: (str(x[0]), str(x[1]))
    assert sorted(((r.doc_id, r.class_id) for r in got if r.doc_id is not None), key=key) == sorted((w for w in want if w[0] is not None), key=key)
    assert O.near_duplicates(docs.limit(0)).count() == 0
    kept = O.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted({str(c) for d, c in want if d is not None} | {"None"})


def test_moved_parts_are_found_by_sets():
    text = [f"w{i}" for i in range(300)]
    sides = []
    for t in (" ".join(text), " ".join(text[150:] + text[:150])):
        body = np.frombuffer(t.encode(), np.uint8)
        h, owner = O.shingles(body, np.array([0, len(body)]))
        sides += [h, O.labelled(h, owner)]
    assert O.similarity(*sides) > 0.9


def variants(n, changed, seed):
    """Copies of one text with words replaced, most pairs of them just under the similarity."""
    rng = random.Random(seed)
    base, rows = [f"w{i}" for i in range(300)], []
    for d in range(n):
        copy = list(base)
        for at in rng.sample(range(250), changed):
            copy[at] = f"v{d}x{at}"
        rows.append((d, " ".join(copy)))
    return rows


def test_every_candidate_of_a_group_just_under_the_similarity_is_verified(spark):
    rows = variants(300, 5, 2)
    want = dict(brute(rows))
    assert 100 < len(set(want.values())) < 290
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert dict(O.near_duplicates(docs).select("doc_id", "class_id").collect()) == want


def test_small_blocks_and_pairs_find_the_same(spark):
    rows = variants(90, 4, 3)
    want = roots([r[0] for r in rows], [])
    keyed = O._keyed(spark.createDataFrame(rows, "doc_id long, text string"))
    sketched = O._sketched(keyed, O.SHINGLE, O.SKETCHES, O.KEPT)
    names = sketched.join(keyed, ["_k1", "_k2"]).select("_id", "doc_id")
    ids = {r._id: r.doc_id for r in names.collect()}
    for paired, block in ((0, 8), (0, 1000), (10**6, 8)):
        links = O.linked_texts(sketched, keyed, O.SHINGLE, O.SIMILARITY, rounds=1, paired=paired, block=block)
        root = roots(list(want), [(ids[r.u], ids[r.v]) for r in links.collect()])
        assert sorted(root.items()) == sorted(brute(rows))


def test_real_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = dict(O.near_duplicates(docs).select("doc_id", "class_id").collect())
    assert got == dict(brute(rows))


def changed(kind, rng):
    """A text and one alike by its shingles: repeated, moved, edited, or repeated and moved."""
    paragraphs = [[f"v{rng.randrange(10**6)}" for _ in range(40)] for _ in range(10)]
    flat = lambda p: " ".join(w for x in p for w in x)
    text = flat(paragraphs)
    if kind == "repeated":
        return text, " ".join([text] * rng.choice([2, 3, 5, 10]))
    moved = rng.sample(paragraphs, len(paragraphs))
    if kind == "moved":
        return text, flat(moved)
    if kind == "both":
        return text, flat(moved + paragraphs[:5])
    words = text.split()
    for at in rng.sample(range(len(words)), 6):
        words[at] = f"u{at}"
    return text, " ".join(words)


def test_recall_of_ids_divisible_by_20_against_all_rows(spark):
    """Every kind of pair the relation takes: at least 0.9 of what brute force links."""
    rng = random.Random(9)
    rows = []
    for i in range(160):
        a, b = changed(("repeated", "moved", "edited", "both")[i % 4], rng)
        rows += [(20 * i, a), (20 * i + 1 + i % 19, b)]
    rows += [(20 * i + 7, " ".join(f"x{rng.randrange(10**6)}" for _ in range(300))) for i in range(160, 300)]
    want = dict(brute(rows))
    got = dict(O.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).select("doc_id", "class_id").collect())
    asked = [d for d, _ in rows if d % 20 == 0]
    linked = [d for d in asked if sum(want[e] == want[d] for e, _ in rows) > 1]
    assert len(linked) >= 150
    assert sum(got[d] == want[d] and sum(got[e] == got[d] for e, _ in rows) > 1 for d in linked) >= 0.97 * len(linked)
    assert all(got[d] == d for d, _ in rows if d >= 3200 + 7)
