"""The pipeline against brute-force stages, and on awkward tables."""

import hashlib

import corpus_pipeline as P
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from labelwright.llm import line_edit_join
from tests.llm import test_decontaminate, test_line_edit_join, test_order_minhash


def brute_lines(rows):
    """Texts after the line stage, from the brute-force classes."""
    out = []
    for d, text in rows:
        kept = []
        for i, raw in enumerate((text or "").split("\n")):
            line = raw.strip(" ")
            # First place of a line that is near equal, by brute force over all lines.
            if line and FIRST[line] != (d, i):
                continue
            kept.append(raw)
        new = "\n".join(kept)
        if new == (text or "") or new.strip(" \n\t\r"):
            out.append((d, new))
    return out


FIRST = {}


def first_places(rows):
    places = {}
    for d, t in sorted(rows):
        for i, line in enumerate((t or "").split("\n")):
            if line.strip(" "):
                places.setdefault(line.strip(" "), (d, i))
    lines = sorted(places, key=len)
    pairs = []
    for x, a in enumerate(lines):
        # Shorter lines are held for equality.
        for b in lines[x + 1 :] if len(a) >= line_edit_join.MIN_CHARS else []:
            if len(b) - len(a) > line_edit_join.EDITS:
                break
            # Equal halves or thirds are needed for so few edits; others are not compared.
            k = len(a) // 3
            if a[:k] in b or a[k : 2 * k] in b or a[2 * k :] in b:
                if test_line_edit_join.distance(a, b) <= line_edit_join.EDITS:
                    pairs.append((a, b))
    root = test_order_minhash.roots(lines, [tuple(sorted(p)) for p in pairs])
    least = {}
    for a in lines:
        least[root[a]] = min(least.get(root[a], places[a]), places[a])
    FIRST.clear()
    FIRST.update({a: least[root[a]] for a in lines})


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = P.language(spark, docs, sf_dir).cache()
    assert first.columns == docs.columns
    rows = [tuple(r) for r in first.select("doc_id", "text").collect()]
    assert len(rows) >= 0.95 * docs.count()
    first_places(rows)
    rows = brute_lines(rows)
    classes = test_order_minhash.brute(rows)
    rows = [r for r, (d, c) in zip(rows, classes) if d == c]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    bad = {r[0] for r in test_decontaminate.brute(rows, items) if r[-1]}
    rows = [r for r in rows if r[0] not in bad]
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(P.MODEL))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for d, t in rows:
        ids = model.encode(t)
        want.append((d, len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids))))
    assert sorted(map(tuple, P.run(spark, sf_dir).collect())) == sorted(want)


def test_awkward_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40).withColumns({"_k1": F.col("doc_id"), "_id": F.col("doc_id"), "_row": F.col("doc_id"), "_h": F.col("doc_id"), "n_words": F.lit(None).cast("int"), "class_id": F.lit(0)})
    odd = docs.withColumns({c: F.lit(None).cast(t) for c, t in docs.dtypes}).limit(2)
    long = docs.limit(1).withColumn("text", F.repeat(F.lit("the long words of it "), 20_000))
    for table in (docs.limit(0), docs.unionByName(odd).unionByName(docs.limit(5)).unionByName(long)):
        for name, stage in P.STAGES:
            out = stage(spark, table, sf_dir).cache()
            out.count()
            if name != P.STAGES[-1][0]:
                assert out.dtypes == docs.dtypes
                assert out.where("not (_k1 <=> doc_id and _id <=> doc_id and _row <=> doc_id and _h <=> doc_id)").count() == 0
                table = out
