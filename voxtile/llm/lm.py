"""Log-likelihood of whole documents: corpus counts for a unigram base, and the recurrent model of ``gru``.

The counts cover every training text; they hold the words by value and are joined by shuffle, but for the ``HEAD`` most
frequent ones, a bounded table, which all tasks get.  So no task sees all rows of a frequent word.
The network's first weights come from a bounded sample on the driver (``SEED_DOCS`` texts); then every training text goes, as
packed ids, to a shard of about ``SHARD_TOKENS`` tokens, each shard trains a copy, and a tree of sums averages the copies by tokens.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import gru
from .common import checkpointed, crc32_fold, documents, map_blocks, most_frequent, words_of

#: Words whose counts are broadcast; texts and rounds of the first weights; tokens of a shard; tokens and lanes of its training at once; copies that one task adds up.
HEAD, SEED_DOCS, SEED_ROUNDS, SHARD_TOKENS, TRAIN_TOKENS, TRAIN_LANES, SUMMED = 262_144, 300, 3, 1_000_000, 400_000, 400, 64
_COUNT_BYTES, _SCORE_BYTES = 6_000_000, 8_000_000


_FIELDS = (("n_tokens", T.LongType()), ("known", T.LongType()), ("base", T.DoubleType()), ("model", T.DoubleType()), ("tail", T.ArrayType(T.BinaryType())))


def tokens(text: bytes) -> list[bytes]:
    """Words with A-Z in lower case; the end is not among them."""
    return text.lower().split()


def corpus_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """word (binary), n over all texts of ``df``; one end for each text, null ones included.  Slices sum before the shuffle."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            seen = words_of(pc.ascii_lower(batch.column(text)))[0].value_counts()
            word, n = pa.concat_arrays([seen.field("values"), pa.array([gru.END], pa.binary())]), pa.concat_arrays([seen.field("counts"), pa.array([batch.num_rows], pa.int64())])
            return pa.RecordBatch.from_arrays([word, n], ["word", "n"])

        return step

    return map_blocks(df.select(text), text, make, "word binary, n long", _COUNT_BYTES, fill=True).groupBy("word").agg(F.sum("n").alias("n"))


def train(df: DataFrame, vocabulary: gru.Vocabulary, tokens_in_all: int, texts: int, text: str = "text", seed_docs: int = SEED_DOCS) -> dict[str, np.ndarray]:
    """Weights learned from every text of ``df``, of about ``texts`` rows with ``tokens_in_all`` tokens; null texts teach nothing.

    A hash of a row's columns deals it to a shard and gives its place there, so the weights don't depend on how rows are partitioned.
    Copies of a text are dealt apart by their other columns; fully repeated rows share a shard.
    """
    session = df.sparkSession
    known = df.where(F.col(text).isNotNull()).select(F.col(text).alias("text"), F.xxhash64(F.lit(5), *df.columns).alias("place"))
    part = int((1 << 30) * min(1.0, seed_docs / max(texts, 1)))
    first = known.where(F.pmod("place", F.lit(1 << 30)) < part).limit(4 * seed_docs).collect()
    weights = gru.initial(vocabulary)
    memory, cache = None, {}
    ids = [np.array(vocabulary.ids(tokens(r["text"].encode()), cache), np.int32) for r in sorted(first, key=lambda r: r["place"])]
    for k in range(SEED_ROUNDS):
        memory = gru.train(weights, vocabulary, ids, memory, rate=0.012 / (1 + k), width=48)
    sent = session.sparkContext.broadcast((vocabulary, weights))
    shards = max(1, -(-tokens_in_all // SHARD_TOKENS))

    def make():
        v = sent.value[0]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            words, length = words_of(pc.ascii_lower(batch.column("text")))
            packed = np.concatenate([[0], 2 * np.cumsum(length)]).astype(np.int32), v.numbers(words).astype("<u2")
            packed = pa.Array.from_buffers(pa.binary(), len(length), [None, *(pa.py_buffer(x) for x in packed)])
            return pa.RecordBatch.from_arrays([batch.column("place"), packed], ["place", "ids"])

        return step

    def local(batches):
        v, start = sent.value
        shard, p, memory, pending, size, seen = None, None, None, [], 0, 0

        def learned():
            nonlocal memory, pending, size, seen
            memory, seen, pending, size = gru.train(p, v, pending, memory, rate=0.003, width=TRAIN_LANES), seen + size, [], 0

        def result():
            if pending:
                learned()
            sums = np.concatenate([p[k].ravel() for k in gru.NAMES]).astype(np.float64) * seen
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([sums.tobytes()], pa.binary()), pa.array([seen], pa.int64())], ["shard", "sums", "tokens"])

        for batch in batches:
            for own, packed in zip(batch.column("shard").to_pylist(), batch.column("ids").to_pylist()):
                if own != shard:
                    if shard is not None:
                        yield result()
                    shard, p, memory, seen = own, {k: a.copy() for k, a in start.items()}, None, 0
                pending.append(np.frombuffer(packed, "<u2").astype(np.int32))
                size += len(pending[-1]) + 1
                if size >= TRAIN_TOKENS:
                    learned()
        if shard is not None:
            yield result()

    def added(batches):
        rows = sorted((r for batch in batches for r in batch.to_pylist()), key=lambda r: r["shard"])
        if rows:
            sums = sum(np.frombuffer(r["sums"], np.float64) for r in rows)
            yield pa.RecordBatch.from_pylist([{"shard": rows[0]["shard"], "sums": sums.tobytes(), "tokens": sum(r["tokens"] for r in rows)}], pa.schema([("shard", pa.int64()), ("sums", pa.binary()), ("tokens", pa.int64())]))

    schema = "shard long, sums binary, tokens long"
    dealt = map_blocks(known, "text", make, "place long, ids binary", _COUNT_BYTES, fill=True).withColumn("shard", F.pmod("place", F.lit(shards)))
    copies = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "place", "ids").select("shard", "ids").mapInArrow(local, schema)
    while shards > SUMMED:
        shards = -(-shards // SUMMED)
        copies = checkpointed(copies).repartition(shards, F.pmod("shard", F.lit(shards))).mapInArrow(added, schema)
    rows = sorted(copies.collect(), key=lambda r: r["shard"])
    if rows:
        flat = (sum(np.frombuffer(r["sums"], np.float64) for r in rows) / sum(r["tokens"] for r in rows)).astype(np.float32)
        at = 0
        for k in gru.NAMES:
            n = weights[k].size
            weights[k] = flat[at : at + n].reshape(weights[k].shape)
            at += n
    sent.destroy()
    return weights


def score(df: DataFrame, counts: DataFrame, weights: dict[str, np.ndarray] | None, vocabulary: gru.Vocabulary, head: list[tuple[bytes, int]], total: int, distinct: int, text: str = "text") -> DataFrame:
    """``df`` without ``text``, with n_tokens, n_known, base_score and score (log10) of each row's whole text.

    Null and empty texts are scored as one end.  Repeated rows are scored each by itself; ties of words by count are ordered by value.
    ``counts`` is word, n; ``head`` has the end and its most frequent words.  An empty table gives no rows.
    """
    others = [c for c in df.columns if c not in (text, "n_tokens", "n_known", "base_score", "score")]
    own = F.struct(*([F.col(f"`{c}`") for c in others] or [F.lit(0).alias("none")]))
    in_head = dict(head)
    of = F.pmod(F.crc32(F.substring("word", 1, 3)), F.lit(gru.OPEN_CLASSES))
    mass, kinds = np.zeros(gru.OPEN_CLASSES), np.zeros(gru.OPEN_CLASSES)
    for k, n, m in counts.groupBy(of.alias("k")).agg(F.sum("n"), F.count(F.lit(1))).collect():
        mass[k], kinds[k] = n, m
    for w in vocabulary.words:
        k = gru.open_class(w)
        mass[k] -= in_head.get(w, 0)
        kinds[k] -= w in in_head
    open_total = np.log10(mass + 0.5 * (kinds + 1))
    whole = np.log10(total + 0.5 * (distinct + 1))
    frequent = pa.array([w for w, _ in head], pa.binary())
    log_c = np.log10(np.array([n for _, n in head], float) + 0.5)
    sent = df.sparkSession.sparkContext.broadcast((vocabulary, weights, frequent, log_c, vocabulary.numbers(frequent), open_total))
    keyed = df.select(F.col(text).alias("text"), own.alias("own"), F.monotonically_increasing_id().alias("row"))

    def make():
        v, p, frequent, log_c, ids_of, totals = sent.value
        end = np.log10(in_head_end + 0.5)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            words, length = words_of(pc.ascii_lower(batch.column("text")))
            of, n = np.repeat(np.arange(len(length)), length), len(length)
            at = np.asarray(pc.index_in(words, value_set=frequent).fill_null(-1))
            found = at >= 0
            tail = words.filter(pa.array(~found))
            ids = np.empty(len(at), np.int32)
            ids[found], ids[~found] = ids_of[at[found]], v.numbers(tail)
            of_found, log_found = of[found], log_c[at[found]]
            known = np.bincount(of_found, minlength=n)
            base = np.bincount(of_found, weights=log_found, minlength=n) + end
            opened = ids >= v.size
            model = np.zeros(n) + np.bincount(of_found, weights=log_found * opened[found], minlength=n) - np.bincount(of[opened], weights=totals[ids[opened] - v.size], minlength=n)
            if p is not None:
                model += gru.log_likelihoods(p, v, np.split(ids, np.cumsum(length)[:-1])) / np.log(10)
            tails = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length - known)]), pa.int32()), tail)
            columns = [pa.array(length + 1, pa.int64()), pa.array(known + (in_head_end > 0), pa.int64()), pa.array(base, pa.float64()), pa.array(model, pa.float64()), tails]
            return pa.RecordBatch.from_arrays([batch.column("own"), batch.column("row"), *columns], ["own", "row", "n_tokens", "known", "base", "model", "tail"])

        return step

    in_head_end = in_head.get(gru.END, 0)
    schema = T.StructType([keyed.schema["own"], T.StructField("row", T.LongType()), *(T.StructField(k, t) for k, t in _FIELDS)])
    each = map_blocks(keyed, "text", make, schema, _SCORE_BYTES, fill=True)
    names = ["own", "n_tokens", "known", "base", "model"]
    opened = each.select(*names, "row", F.posexplode_outer("tail").alias("at", "word"))
    # a text's columns travel with its first word; a text without such words gets a key that no word has
    first = F.when(F.coalesce("at", F.lit(0)) == 0, F.struct(*names))
    key = F.coalesce("word", F.concat(F.lit("\n"), F.col("row").cast("string")).cast("binary"))
    rows = opened.select("row", first.alias("first"), key.alias("word"), F.col("word").isNotNull().alias("real"))
    joined = rows.join(counts, "word", "left")
    tail, found = F.sum(F.when(F.col("real"), F.log10(F.coalesce("n", F.lit(0)) + 0.5)).otherwise(0.0)), F.sum((F.col("n") > 0).cast("long"))
    # the one row with the columns: max_by orders by a number, as columns such as maps have no order
    summed = joined.groupBy("row").agg(F.max_by("first", F.col("first").isNotNull().cast("int")).alias("first"), tail.alias("tail"), found.alias("found"))
    base = F.col("first.base") + F.col("tail") - F.col("first.n_tokens") * float(whole)
    return summed.select(
        *[F.col("first.own")[c].alias(c) for c in others], F.col("first.n_tokens").alias("n_tokens"), (F.col("first.known") + F.coalesce("found", F.lit(0))).alias("n_known"), base.alias("base_score"),
        (F.col("first.model") + F.col("tail") if weights is not None else base).alias("score"),
    )


def op2_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; learned where crc32(doc_id) mod 5 is not 1."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    learned = docs.where(crc32_fold("doc_id", 5) != 1)
    counts = checkpointed(corpus_counts(learned))
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    end = F.col("word") == F.lit(gru.END)
    ends = counts.where(end).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    head = [(gru.END, ends), *sorted(((bytes(r[0]), r[1]) for r in most_frequent(counts.where(~end), HEAD).collect()), key=lambda x: (-x[1], x[0]))]
    words = head[1 : gru.VOCABULARY + 1]
    vocabulary = gru.Vocabulary([w for w, _ in words], [n for _, n in words])
    weights = train(learned, vocabulary, total, ends) if total else None
    out = score(docs, counts, weights, vocabulary, head, total, distinct)
    return out.select("doc_id", (crc32_fold("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
