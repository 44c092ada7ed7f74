"""Severity of toxic language by cumulative-link ordinal regression on sparse text features.

P(grade <= k) = sigmoid(threshold_k - w x): one weight vector for all thresholds, thresholds in ascending order.  Features are the
words of a text and the 4- and 5-character pieces of its words, of which those that set toxic texts apart are kept.
The grades come from the labels alone: 0 is not toxic, 1 toxic, and 2 toxic and marked as of bad quality besides.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, crc32_fold, documents, map_blocks

#: Bounds of the sample the model is learned from (texts of either label) and of the features kept.
TOXIC_DOCS, CLEAN_DOCS, MAX_FEATURES = 2_500, 5_000, 20_000
#: A feature is kept if its share of toxic texts is so many times the one of the others, and the log-likelihood ratio of the two counts against
#: equal shares is so large (chi-squared with one degree of freedom, p = 0.01); how rare it is otherwise doesn't matter.
LEAST_LIFT, LEAST_RATIO = 4.0, 6.63
GRADES = 3
_LETTERS = re.compile(r"[^\W\d_]+")


def pieces(word: str) -> list[str]:
    """Features of a lower-case word: itself in brackets, and its pieces with marked ends."""
    marked = f"^{word}$"
    return [f"[{word}]", *{marked[i : i + n] for n in (4, 5) for i in range(len(marked) - n + 1)}]


def _words(text: str | None) -> list[str]:
    return _LETTERS.findall((text or "").lower())


@dataclass
class Ordinal:
    index: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def word_row(self, word: str) -> list[int]:
        return [i for p in pieces(word) if (i := self.index.get(p)) is not None]

    def vectors(self, texts: list[str | None], cache: dict[str, list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text number, feature and value 1 + log(count) of all entries."""
        rows, cols, counts = [], [], []
        if len(cache) > 500_000:
            cache.clear()
        for k, text in enumerate(texts):
            found: Counter = Counter()
            for word in _words(text):
                row = cache.get(word)
                if row is None:
                    row = cache[word] = self.word_row(word)
                if row:
                    found.update(row)
            rows += [k] * len(found)
            cols += found.keys()
            counts += found.values()
        return np.array(rows, np.int64), np.array(cols, np.int64), 1 + np.log(np.maximum(np.array(counts, np.float64), 1))

    def above(self, margin: np.ndarray) -> np.ndarray:
        """P(grade > k) for each text and threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - margin[:, None], -40, 40)))


def ordinal_gradient(w: np.ndarray, raw: np.ndarray, rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grades: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean log-likelihood of the grades, and its gradients; ``raw`` has the first threshold and the logarithms of the steps to the next ones."""
    n, k = len(grades), len(raw)
    theta = np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))
    margin = np.bincount(rows, weights=w[cols] * values, minlength=n)
    edge = np.concatenate([[-np.inf], theta, [np.inf]])
    cdf = lambda t: 1 / (1 + np.exp(-np.clip(t - margin, -40, 40)))
    high, low = cdf(edge[grades + 1]), cdf(edge[grades])
    p = np.maximum(high - low, 1e-12)
    g_high, g_low = high * (1 - high) / p, low * (1 - low) / p
    g_theta = np.zeros(k)
    np.add.at(g_theta, np.minimum(grades, k - 1), np.where(grades < k, g_high, 0) / n)
    np.add.at(g_theta, np.maximum(grades - 1, 0), np.where(grades > 0, -g_low, 0) / n)
    g_raw = np.concatenate([[g_theta.sum()], np.exp(raw[1:]) * np.cumsum(g_theta[::-1])[::-1][1:]])
    g_w = np.bincount(cols, weights=(-(g_high - g_low) / n)[rows] * values, minlength=len(w))
    return float(np.log(p).mean()), g_w, g_raw


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grades: np.ndarray, size: int, rounds: int = 1000, rate: float = 0.1, decay: float = 5e-6) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds that maximise the likelihood of the grades, by full-batch Adam."""
    w, raw = np.zeros(size), np.concatenate([[1.0], np.zeros(GRADES - 2)])
    memory = [(np.zeros_like(v), np.zeros_like(v)) for v in (w, raw)]
    for step in range(1, rounds + 1):
        _, g_w, g_raw = ordinal_gradient(w, raw, rows, cols, values, grades)
        for v, g, (m, s) in zip((w, raw), (g_w - decay * w, g_raw), memory):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            v += rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return w, np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))


def train(df: DataFrame, text: str = "text", toxic: str = "toxic", quality: str | None = None, toxic_docs: int = TOXIC_DOCS, clean_docs: int = CLEAN_DOCS) -> Ordinal | None:
    """Learn from rows with a text and a label of 0 or 1; None unless both labels are there.

    A toxic text's grade is 2 if its label ``quality`` is 0, or else (also without that label) 1.  Only a sample, bounded by ``toxic_docs`` and
    ``clean_docs`` on average and drawn by a hash of the row, is used.  Repeated rows are drawn together and count as often as they occur; features that
    tie are kept by name.  An empty table gives None.
    """
    bad = F.lit(False) if quality is None else F.coalesce(F.col(quality) == 0, F.lit(False))
    label = F.col(toxic).cast("int")
    known = df.select(F.col(text).alias("text"), label.alias("toxic"), (label * F.when(bad, 2).otherwise(1)).alias("grade"), F.xxhash64(F.lit(3), *df.columns).alias("place")).where("text is not null and toxic in (0, 1)")
    counts = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return None
    share = F.when(F.col("toxic") == 1, toxic_docs / counts[1]).otherwise(clean_docs / counts[0])
    sample = known.where(F.pmod("place", F.lit(1 << 30)) < share * (1 << 30)).drop("place")

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            has, number = {0: Counter(), 1: Counter()}, Counter()
            for x, y in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                has[y].update({p for w in set(_words(x)) for p in pieces(w)})
                number[y] += 1
            keys = [*(has[0].keys() | has[1].keys()), ""]
            has[0][""], has[1][""] = number[0], number[1]
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array([has[0][x] for x in keys], pa.int64()), pa.array([has[1][x] for x in keys], pa.int64())], ["feature", "clean", "bad"])

        return step

    seen = map_blocks(sample, "text", make, "feature string, clean long, bad long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
    size = {y: min(n, m) for (y, n), m in zip(sorted(counts.items()), (clean_docs, toxic_docs))}
    share_bad, share_clean = F.col("bad") / max(size[1], 1), (F.col("clean") + 0.5) / max(size[0], 1)
    both, whole = F.col("bad") + F.col("clean"), size[0] + size[1]
    excess = lambda n, k: F.when(n > 0, n * F.log(n * whole / (both * max(size[k], 1)))).otherwise(0.0)
    ratio = 2 * (excess(F.col("bad"), 1) + excess(F.col("clean"), 0))
    best = seen.where((F.col("feature") != "") & (F.col("bad") > 0)).where((share_bad >= LEAST_LIFT * share_clean) & (ratio >= LEAST_RATIO)).orderBy(F.desc(ratio), "feature").limit(MAX_FEATURES)
    names = [r[0] for r in best.select("feature").collect()]
    model = Ordinal({x: i for i, x in enumerate(names)}, np.zeros(len(names)), np.zeros(GRADES - 1))
    sent = df.sparkSession.sparkContext.broadcast(model)

    def make_vectors():
        cache: dict[str, list[int]] = {}

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, cols, values = sent.value.vectors(batch.column("text").to_pylist(), cache)
            edge = pa.array(np.searchsorted(rows, np.arange(batch.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(edge, pa.array(x)) for x in (cols, values)]
            return pa.RecordBatch.from_arrays([batch.column("grade"), *lists], ["grade", "cols", "values"])

        return step

    table = map_blocks(sample, "text", make_vectors, "grade int, cols array<long>, values array<double>").toPandas()
    grades = table["grade"].to_numpy(np.int64)
    rows = np.repeat(np.arange(len(table)), table["cols"].str.len())
    cols = np.concatenate([*table["cols"], np.zeros(0)]).astype(np.int64)
    values = np.concatenate([*table["values"], np.zeros(0)]).astype(float)
    model.weights, model.thresholds = fit_ordinal(rows, cols, values, grades, len(names))
    return model


def severity(df: DataFrame, model: Ordinal | None, text: str = "text") -> DataFrame:
    """Add severity (expected grade, 0 to 2), p_toxic (P(grade > 0)), grade (the most likely one) and toxic_pred to every row.

    Null and empty texts get what a text without features gets; without a model all are 0 and false.
    Columns that already have these names are replaced.
    """
    df = df.drop("severity", "p_toxic", "grade", "toxic_pred")
    if model is None:
        return df.selectExpr("*", "0D as severity", "0D as p_toxic", "0 as grade", "false as toxic_pred")
    sent = df.sparkSession.sparkContext.broadcast(model)
    fields = [("severity", T.DoubleType()), ("p_toxic", T.DoubleType()), ("grade", T.IntegerType()), ("toxic_pred", T.BooleanType())]
    schema = T.StructType([*df.schema.fields, *(T.StructField(k, t) for k, t in fields)])

    def make():
        m, cache = sent.value, {}

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, cols, values = m.vectors(batch.column(text).to_pylist(), cache)
            above = m.above(np.bincount(rows, weights=m.weights[cols] * values, minlength=batch.num_rows))
            each = -np.diff(np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], axis=1))
            columns = [pa.array(above.sum(axis=1)), pa.array(above[:, 0]), pa.array(each.argmax(axis=1), pa.int32()), pa.array(above[:, 0] >= 0.5)]
            return pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *(k for k, _ in fields)])

        return step

    return map_blocks(df, text, make, schema)


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", toxic: str = "toxic", toxic_docs: int = TOXIC_DOCS, clean_docs: int = CLEAN_DOCS) -> DataFrame:
    """Labelled texts for ``train``: the labels are sampled first, to a bounded number, and sent to the documents, which stay where they are.

    Columns of ``docs`` with the name of a label give way to it.  Keys with several labels come with each; null keys and labels are left out.
    """
    known = labels.withColumn(toxic, F.col(toxic).cast("int")).where(f"{toxic} in (0, 1)")
    counts = {r[0]: r[1] for r in known.groupBy(toxic).count().collect()}
    share = F.when(F.col(toxic) == 1, toxic_docs / counts.get(1, 1)).otherwise(clean_docs / counts.get(0, 1))
    sample = known.where(F.pmod(F.xxhash64(F.lit(3), key), F.lit(1 << 30)) < share * (1 << 30)).limit(2 * (toxic_docs + clean_docs))
    return checkpointed(docs.drop(*[c for c in labels.columns if c != key]).join(F.broadcast(sample), key))


def op3_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, severity, p_toxic, grade, toxic_pred of every whole text; learned from labels where crc32(doc_id) mod 5 is not 1."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic", "quality").where(crc32_fold("doc_id", 5) != 1)
    model = train(labelled_sample(docs, labels), quality="quality")
    return severity(docs, model).select("doc_id", (crc32_fold("doc_id", 5) == 1).alias("held_out"), "severity", "p_toxic", "grade", "toxic_pred")
