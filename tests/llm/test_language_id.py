"""Held-out accuracy and the defined results of language identification."""

from labelwright.llm import language_id as I


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = I.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 20
    assert all(0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == r.lang for r in got) >= 0.97 * len(got)


def test_same_for_any_batches(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one = I.identify(docs.coalesce(1)).select("doc_id", "lang_pred").collect()
    many = I.identify(docs.repartition(7)).select("doc_id", "lang_pred").collect()
    assert sorted(one) == sorted(many)


def test_score_is_the_plain_sum(spark):
    """Batched sums equal one row at a time."""
    docs = spark.createDataFrame([(i, t, l) for i, (t, l) in enumerate([("the cat", "en"), ("der hund", "de")] * 8)], "doc_id long, text string, lang string")
    model = I.fit(docs)
    texts = ["the dog", "", "x", "hund und katze", "ΩΣ", "a" * 70_000, "İstanbul"]
    names, share = model.score(texts)
    for t, n, s in zip(texts, names, share):
        assert model.score([t])[0] == [n]
        assert abs(model.score([t])[1][0] - s) < 1e-9
    assert names[0] == "en" and names[3] == "de"


def test_defined_results(spark):
    rows = [(1, None, "en", 0), (2, "", "en", 0), (3, "123 !?", "de", 0), (None, "hello there", "en", 0), (5, "guten tag", "de", 0), (6, "hello", None, 0), (6, "hello", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = {r.doc_id: r for r in I.identify(docs).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3
    assert got[None].held_out is False
    assert I.identify(docs).count() == len(rows)
    assert I.identify(docs.limit(0)).count() == 0
    kept = I.recognised(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {None, 5, 6}
    nothing = docs.withColumn("lang", docs.lang.substr(0, 0)).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in I.identify(nothing).collect()} == {"und"}
