"""Encoding and decoding against the library."""

import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from labelwright.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ours = pieces.Pieces(MODEL)
theirs = sentencepiece.SentencePieceProcessor(model_file=MODEL)

TEXTS = [
    "", " ", "   ", "\n", "a", "  a b", "a   b    c  ", "a\nb", "a\x00b", "<0x0A><s></s><unk>", "a▁b", "▁", "▁▁ ▁a",
    "tab\tx\r\n", "日本語テキスト 🤗", "﻿a　x", "é", "퟿\U0010ffff", "a" * 3000, " " * 999, "ab" * 1000 + "\U0010ffff" * 9,
    "Öffentlichkeitsarbeit größte", "===========---------//////", "\n\n\n  \n", "the the thethe th e", "x" + "▁" * 40 + "y",
]


@pytest.mark.parametrize("text", TEXTS)
def test_texts(text):
    ids = ours.encode(text)
    assert ids == theirs.encode(text)
    assert ours.decode(ids) == theirs.decode(ids)


@settings(max_examples=600, deadline=None)
@given(st.one_of(st.text(), st.text(alphabet="aehinrst \n▁", min_size=1, max_size=60), st.text(alphabet="=-_/\\ <>0x1\t\r", max_size=50)))
def test_any_text(text):
    ids = ours.encode(text)
    assert ids == theirs.encode(text)
    assert ours.decode(ids) == theirs.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(3, len(theirs) - 1), max_size=30))
def test_decode_of_valid_bytes(ids):
    ids = [i for i in ids if not theirs.is_byte(i)]
    assert ours.decode(ids) == theirs.decode(ids)


def test_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-1, None), (-2, ""), (None, "x" * 200_000), (-3, "a b"), (-3, "a b")], docs.schema)
    docs = docs.unionByName(extra)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for d, t in docs.collect():
        ids = theirs.encode(t or "")
        want.append((d, len(ids), sha(",".join(map(str, ids))), sha(theirs.decode(ids))))
    assert sorted(map(tuple, pieces.token_digests(docs, MODEL).collect()), key=str) == sorted(want, key=str)
    full = pieces.tokens(docs.where("doc_id < 20"), MODEL).collect()
    texts = dict(docs.where("doc_id < 20").collect())
    assert all(list(r.ids) == theirs.encode(texts[r.doc_id] or "") for r in full)
    assert pieces.token_digests(docs.limit(0), MODEL).count() == 0
