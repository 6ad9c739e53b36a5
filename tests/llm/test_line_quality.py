"""Line frequency and base counts against a brute-force version."""

import re
from collections import Counter, defaultdict

from labelwright.llm import line_quality as L

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DIGIT = re.compile("[0-9]")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, max_docs=2, max_lost=0.5):
    lines = [[(x, tuple(DIGIT.sub("0", w.translate(LOWER)) for w in WORD.findall(x))) for x in (t or "").split("\n")] for _, t, _ in rows]
    lines = [[x for x in doc if x[1]] for doc in lines]
    seen = defaultdict(set)
    for i, ((_, _, host), doc) in enumerate(zip(rows, lines)):
        for _, words in doc:
            if rows[i][0] is not None:
                seen[host, words].add(rows[i][0])
    out = []
    for (d, text, host), doc in zip(rows, lines):
        text = text or ""
        w = WORD.findall(text)
        grams = Counter(zip(w, w[1:], w[2:]))
        again = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for k in range(3)}
        dup = len(doc) - len({x for x, _ in doc})
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        hot = [words for _, words in doc if len(seen[host, words]) > max_docs]
        lost = sum(map(len, hot))
        kept = not failed and lost <= max_lost * len(w)
        out.append((d, len(w), sum(map(len, w)), sum(map(text.count, "#*$%&|<>")), dup, len(again), failed, kept, len(hot), lost))
    return sorted(out, key=str)


PROSE = " ".join(f"w{i}" for i in range(60))
ROWS = [
    (1, "Licence 2020 text\n" + PROSE, "a"),
    (2, "licence  2021 TEXT \n\n" + PROSE.replace("w", "x"), "a"),
    (3, "LICENCE 1999\ttext\n" + "a b c " * 40, "a"),
    (4, "licence 2020 text", "b"),
    (5, None, "a"),
    (6, "", None),
    (7, " \n\t\n\x0b", None),
    (8, "é\x85ü ö #*$%&|<> same\nsame\nsame\nsame \n", None),
    (9, "long " * 50_000 + "end\n" + "y" * 400_000, "c"),
    *[(10 + i // 2, "one two three four five\n" * 3 + PROSE.replace("w", f"v{i}"), None) for i in range(4)],
    *[(30 + 10 * i, "\n".join(f"shared line number {k} of many" for k in "abcdefghijklm"), "d") for i in range(4)],
    (None, "aa\naa", "c"),
    (31, "tail without break", "c"),
]


def test_against_brute_force(spark):
    docs = spark.createDataFrame([(*r, 1) for r in ROWS], "doc_id long, text string, source string, n_words int")
    got = L.line_quality(docs, max_docs=2).collect()
    assert sorted(map(tuple, got), key=str) == brute(ROWS)
    assert L.line_quality(docs.limit(0)).count() == 0


def test_repeated_rows_are_one_document(spark):
    """The same rows twice have the same frequent lines."""
    rows = [(i, f"line {chr(97 + i % 7)} of many\nown {chr(97 + i // 26)}{chr(97 + i % 26)} words", "h") for i in range(60)]
    count = lambda r: sum(x.n_frequent_lines for x in L.line_quality(spark.createDataFrame(r, "doc_id long, text string, source string"), max_docs=1).collect())
    assert count(rows) == 60 and count(rows * 2) == 120


def test_removed_lines(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in L.without_frequent_lines(docs, max_docs=2).collect()}
    assert got[1] == PROSE
    assert got[2] == "\n" + PROSE.replace("w", "x")
    assert got[4] == "licence 2020 text"
    assert got[30] == ""
    assert got[5] is None


def test_real_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    got = L.line_quality(docs, max_docs=3).collect()
    assert sorted(map(tuple, got), key=str) == brute([tuple(r) for r in docs.collect()], 3)
