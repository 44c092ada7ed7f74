"""From raw documents to token ids: STAGES in order, each on all that the one before it kept.

Each stage takes (spark, docs, sf_dir), where ``docs`` has the columns of documents, and returns a DataFrame; all but the
last return the columns of documents again, and leave others out.  An empty table gives an empty table at every stage.  Null texts go with
language ID, as no model accepts them; null sources are a source of their own, null languages are only not learned from.
The stages' tables stay in the shared folder, as a run may be read again from any of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxtile.llm import bpe, jaccard_join, langid, mixing, passages
from voxtile.llm.common import checkpointed, small_batches, stored
from voxtile.llm.graph import KeyFilter, maybe_in

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts that no language model accepts (null, without letters, or far above every model's usual cross-entropy)."""
    small_batches(spark)
    model = langid.train(docs)
    return langid.score(docs.select(*COLUMNS), model).where("not rejected").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group that links of 0.75 or more connect.

    Of rows with the same id one stays; rows without an id stay unless their text repeats among them.  A filter
    by the ids that go, or come more than once, lets all other rows pass without a shuffle.
    """
    small_batches(spark)
    groups = checkpointed(jaccard_join.jaccard_groups(docs.where("doc_id is not null")))
    gone = groups.where("doc_id != component_id").select("doc_id")
    twice = groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    keys = KeyFilter(gone.union(twice), "doc_id")
    named = docs.where("doc_id is not null").select(*COLUMNS)
    one = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64(*COLUMNS)))
    near = maybe_in(named, "doc_id", keys).join(gone.distinct(), "doc_id", "left_anti").withColumn("_one", one).where("_one = 1").select(*COLUMNS)
    rest = docs.where("doc_id is null").select(*COLUMNS).dropDuplicates(["text"])
    return maybe_in(named, "doc_id", keys, inside=False).union(near).union(rest)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take every recurring passage of 35 words or more out of the texts; rows stay, with an empty text if nothing is left."""
    small_batches(spark)
    cut = passages.remove_passages(docs.select(*COLUMNS))
    length = F.when(F.col("n_removed") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", length).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (up to three times)."""
    return mixing.mixed(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids (packed) and whether decoding gives the text's bytes back."""
    small_batches(spark)
    rank_file, pattern = bpe.default_rank_file()
    both = bpe.decode_documents(bpe.encode_documents(docs.select("doc_id", "lang", "source", "text"), rank_file, pattern), rank_file, pattern)
    same = F.coalesce("text", F.lit("")).cast("binary") == F.col("decoded")
    return both.select("doc_id", "lang", "source", "n_tokens", "ids", same.alias("round_trip"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: SQL can't express these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
