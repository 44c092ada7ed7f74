from pyspark.sql import functions as F

from voxtile.llm.passages import in_slices


def test_texts_with_common_passages_meet(spark):
    """Forty groups of eight texts with the same smallest anchor: a group lies in one slice, as its passages are sent to each slice that has it."""
    rows = [(100 * g + k, [1000 + g, 5000 + 10 * g + k], 100) for g in range(40) for k in range(8)]
    texts = spark.createDataFrame(rows, "text_hash long, anchors array<long>, size long")
    got = in_slices(texts, 2000).groupBy(F.floor(F.col("text_hash") / 100).alias("g")).agg(F.countDistinct("slice").alias("n"), F.count(F.lit(1)).alias("m")).collect()
    assert [(r["n"], r["m"]) for r in got] == [(1, 8)] * 40


def test_one_anchor_of_all_texts_is_dealt_out(spark):
    texts = spark.createDataFrame([(k, [7], 100) for k in range(2000)], "text_hash long, anchors array<long>, size long")
    got = in_slices(texts, 10_000).groupBy("slice").count().collect()
    assert sum(r["count"] for r in got) == 2000 and len(got) >= 8 and max(r["count"] for r in got) < 700
    assert in_slices(texts.limit(0)).count() == 0
