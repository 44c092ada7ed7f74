"""Empty tables, very long texts, repeated rows, ties and columns of clashing names, operator by operator."""

import numpy as np
from pyspark.sql import functions as F

from voxtile.llm import jaccard_join, order_minhash, repetition, toxicity

LONG = " ".join(f"w{i % 70_000}" for i in range(200_000))


def test_toxicity_rows(spark):
    labels = spark.createDataFrame([(i, int(i % 2), 1, 9) for i in range(40)] + [(1, None, 1, 9), (None, 1, 1, 9)], "doc_id long, toxic int, quality int, text int")
    docs = spark.createDataFrame([(i, "awful nasty" if i % 2 else "kind words", 5, 5) for i in range(40)] + [(1, "awful nasty", 5, 5)], "doc_id long, text string, toxic int, severity int")
    sample = toxicity.labelled_sample(docs, labels.drop("text"))
    assert sorted(sample.columns) == ["doc_id", "quality", "severity", "text", "toxic"] and sample.count() == 41
    got = toxicity.severity(docs, toxicity.train(sample, quality="quality"))
    assert got.columns == ["doc_id", "text", "toxic", "severity", "p_toxic", "grade", "toxic_pred"] and got.count() == 41
    assert toxicity.train(sample.limit(0)) is None and toxicity.severity(docs.limit(0), None).count() == 0
    odd = spark.createDataFrame([(None,), ("",), (LONG,), (f"{LONG} nasty awful",)], "text string")
    model = toxicity.train(sample, quality="quality")
    by = {r["text"]: r["severity"] for r in toxicity.severity(odd, model).collect()}
    assert by[None] == by[""] == by[LONG] < by[f"{LONG} nasty awful"]


def test_repetition_rows(spark):
    df = spark.createDataFrame([(LONG, 7), (LONG, 7), (None, 7), ("", 7)], "text string, n_words int")
    got = repetition.repetition(df).collect()
    assert sorted(r["n_words"] for r in got) == [0, 0, 200_000, 200_000]
    long = next(r for r in got if r["n_words"])
    assert (long["longest_repeat"], long["n_repeat_words"]) == (130_000, 200_000)
    assert repetition.repetition(df.limit(0)).count() == 0


def test_order_minhash_rows(spark):
    """Null keys first, equal keys by their texts, columns that the operator names itself, a very long text."""
    rows = [(3, "c", 1, 2, 3), (None, "n", 1, 2, 3), (5, LONG, 1, 2, 3), (3, "b", 1, 2, 3), (7, "", 1, 2, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, own int, range int, place int")
    for buckets in (1, 4, 50):
        got = {r["text"]: r["next_text"] for r in order_minhash.with_next(df, "doc_id", ["text"], buckets=buckets).collect()}
        assert got == {"n": "b", "b": "c", "c": LONG, LONG: "", "": "n"}
    out = order_minhash.fingerprint(df.withColumn("fingerprint", F.lit(1)))
    assert out.columns == [*df.columns, "fingerprint"] and out.count() == 5
    assert order_minhash.fingerprint(df.limit(0)).count() == 0
    same = order_minhash.signatures([LONG, LONG, f"{LONG} x"])
    assert (same[0] == same[1]).all() and (same[0] == same[2]).mean() > 0.9


def test_jaccard_rows(spark):
    df = spark.createDataFrame([(1, LONG, 5), (2, f"{LONG} more", 5), (3, LONG, 5), (3, LONG, 5), (4, None, 5), (5, "", 5)], "doc_id long, text string, component_id int")
    got = sorted((r["doc_id"], r["component_id"]) for r in jaccard_join.jaccard_groups(df).collect())
    assert got == [(1, 1), (2, 1), (3, 1), (3, 1), (4, 4), (5, 5)]
    assert np.all([r["n_shingles"] == 70_000 for r in jaccard_join.jaccard_groups(df.where("doc_id = 1")).collect()])
