"""Language identification with interpolated Kneser-Ney character models.

Characters are lower-cased; runs of anything but letters become one space.  A model holds, for
each order, the sorted 64-bit hashes of the n-grams seen in any language and one row of log
probabilities per n-gram, one column per language, with the interpolation already carried out.
Languages are learned in groups, a model each; the models share the alphabet, so their scores compare.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, crc32_fold, documents, map_blocks, mix

#: Bounds of the model: order, texts a language is learned from and calibrated on, n-grams of an order that a language keeps, languages of a group.
ORDER, FIT_DOCS, CALIBRATION_DOCS, MAX_NGRAMS, GROUP_LANGUAGES = 4, 1500, 500, 60_000, 32
#: A text is rejected if its cross-entropy is more than so many deviations above its language's mean, plus so many nats.
REJECT_DEVIATIONS, REJECT_SLACK = 6.0, 0.5
#: Characters that count at most towards the posterior behind ``score``.
EVIDENCE = 50

#: Bytes of text that are scored at once: a character takes about 100 bytes then.
_BLOCK = 500_000
_START, _SPACE = 2, 32
_FOLD: list[np.ndarray] = []


def fold_table() -> np.ndarray:
    """Lower case of each letter, a space for every other code point."""
    if not _FOLD:
        table = np.full(0x110000, _SPACE, np.uint32)
        for cp in range(0x110000):
            if 0xD800 <= cp < 0xE000:
                continue
            ch = chr(cp)
            if ch.isalpha():
                low = ch.lower()
                table[cp] = ord(low) if len(low) == 1 else cp
        _FOLD.append(table)
    return _FOLD[0]


def characters(texts: list[str | None], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded code points of all texts in a row, ``order - 1`` start marks before each.

    Also: the places of characters to predict, the text of each, and the letters of each text.
    """
    raw = [np.frombuffer((x or "").encode("utf-32-le", "surrogatepass"), "<u4") for x in texts]
    of = np.repeat(np.arange(len(texts)), [len(x) for x in raw])
    cp = fold_table()[np.concatenate(raw)] if len(of) else np.empty(0, np.uint32)
    letters = np.bincount(of[cp != _SPACE], minlength=len(texts))
    keep = np.ones(len(cp), bool)
    keep[1:] = (cp[1:] != _SPACE) | (cp[:-1] != _SPACE) | (of[1:] != of[:-1])
    cp, of = cp[keep], of[keep]
    place = np.arange(len(cp)) + (of + 1) * (order - 1)
    line = np.full(len(cp) + len(texts) * (order - 1), _START, np.uint64)
    line[place] = cp
    return line, place, of, letters


def gram_hashes(line: np.ndarray, place: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` characters that end at each place."""
    with np.errstate(over="ignore"):
        h = np.full(len(place), order, np.uint64)
        for back in range(order - 1, -1, -1):
            h = h * np.uint64(0x9E3779B97F4A7C15) + line[place - back]
        return mix(h)


@dataclass
class HashTable:
    """Sorted hashes with a directory of their leading bits; rows are found without a search tree."""

    hashes: np.ndarray
    rows: np.ndarray
    bits: int = 0
    first: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    depth: int = 0

    def __post_init__(self) -> None:
        by = np.argsort(self.hashes)
        self.hashes, self.rows = self.hashes[by], self.rows[by]
        self.bits = max(4, int(len(self.hashes)).bit_length() + 1)
        self.first = np.searchsorted(self.hashes >> np.uint64(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=np.uint64)).astype(np.int32)
        self.depth = int(np.diff(self.first).max(initial=0))

    def find(self, h: np.ndarray) -> np.ndarray:
        """Row of each hash, -1 if there is none."""
        out = np.full(len(h), -1, np.int64)
        if not len(self.hashes):
            return out
        at = self.first[(h >> np.uint64(64 - self.bits)).astype(np.int64)].astype(np.int64)
        for _ in range(self.depth):
            at_most = np.minimum(at, len(self.hashes) - 1)
            hit = self.hashes[at_most] == h
            out[hit] = at_most[hit]
            at += 1
        return out


@dataclass
class Model:
    languages: list[str]
    order: int
    grams: list[HashTable]  # by order, from 1
    backoff: list[HashTable]  # by order of the n-gram whose context it is, from 2
    unknown: np.ndarray

    def cross_entropy(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nats a character by text and language; characters; letters."""
        line, place, of, letters = characters(texts, self.order)
        score = np.zeros((len(place), len(self.languages)), np.float32)
        rest = np.arange(len(place))
        for n in range(self.order, 0, -1):
            table = self.grams[n - 1]
            row = table.find(gram_hashes(line, place[rest], n))
            hit = row >= 0
            score[rest[hit]] += table.rows[row[hit]]
            rest = rest[~hit]
            if n == 1:
                score[rest] += self.unknown
            elif len(rest):
                row = self.backoff[n - 2].find(gram_hashes(line, place[rest] - 1, n - 1))
                hit = row >= 0
                score[rest[hit]] += self.backoff[n - 2].rows[row[hit]]
        sums = np.zeros((len(texts), len(self.languages)))
        length = np.bincount(of, minlength=len(texts))
        if len(place):
            some = np.flatnonzero(length)
            sums[some] = np.add.reduceat(score, np.searchsorted(of, some), axis=0, dtype=np.float64)
        return -sums / np.maximum(length, 1)[:, None], length, letters


def _hash_strings(grams: pd.Series, order: int) -> np.ndarray:
    points = np.array([[ord(c) for c in g] for g in grams], np.uint64).reshape(-1, order)
    return gram_hashes(points.ravel(), np.arange(len(points)) * order + order - 1, order)


@dataclass
class Models:
    """Models of groups of languages, side by side."""

    groups: list[Model]
    limit: np.ndarray | None = None

    @property
    def languages(self) -> list[str]:
        return [x for m in self.groups for x in m.languages]

    def cross_entropy(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nats a character by text and language of all groups; characters; letters."""
        each = [m.cross_entropy(texts) for m in self.groups]
        return np.concatenate([x[0] for x in each], axis=1), each[0][1], each[0][2]


def fit(counts: pd.DataFrame, order: int = ORDER, max_ngrams: int | None = None) -> Model:
    """Model from the columns lang, gram (``order`` characters) and n; ``max_ngrams`` of each order and language are kept.

    Below the highest order an n-gram counts once for each character seen before it; every
    order takes one discount off each count, n1 / (n1 + 2 n2), and gives it to the next order.
    Counts, totals and discounts are those of all n-grams.
    """
    tables: list[pd.Series] = [counts.groupby(["lang", "gram"])["n"].sum()]
    for _ in range(order - 1):
        higher = tables[0].index.to_frame(index=False)
        tables.insert(0, higher.assign(gram=higher["gram"].str[1:]).groupby(["lang", "gram"]).size())
    kept, discounts = [], {}
    for n, table in enumerate(tables, 1):
        own = table.rename("n").reset_index().assign(size=n)
        own["total"] = own.groupby(["lang", own["gram"].str[:-1].rename("context")])["n"].transform("sum")
        discounts |= {(n, lang): discount(int((c == 1).sum()), int((c == 2).sum())) for lang, c in own.groupby("lang")["n"]}
        own = own.sort_values(["n", "gram"], ascending=[False, True])
        kept.append(own if max_ngrams is None else own.groupby("lang").head(max_ngrams))
    return build(pd.concat(kept), discounts, len({g for _, g in tables[0].index}) + 1, order)


def discount(ones: int, twos: int) -> float:
    return min(max(ones / (ones + 2 * twos) if ones else 0.5, 0.05), 0.95)


def build(kept: pd.DataFrame, discounts: dict[tuple[int, str], float], alphabet: int, order: int = ORDER) -> Model:
    """Model from the n-grams that are kept: size, lang, gram, n and total, the sum of n over all n-grams of the context.

    What the n-grams of a context that are not kept would have goes to the next order, so a distribution sums to one.
    """
    languages = sorted(kept["lang"].unique())
    tables = [kept[kept["size"] == n].set_index(["lang", "gram"]) for n in range(1, order + 1)]
    names: list[set[str]] = [set(t.index.get_level_values("gram")) for t in tables]
    for n in range(order - 1, 0, -1):  # the next order has a row for the end of each n-gram
        names[n - 1] |= {g[1:] for g in names[n]}
    lower: dict[str, pd.Series] = {}
    grams, backoff, unknown = [], [], np.zeros(len(languages), np.float32)
    for n in range(1, order + 1):
        everywhere = pd.Index(sorted(names[n - 1]), dtype=object)
        contexts = pd.Index(sorted(set(everywhere.str[:-1])), dtype=object)
        logs, weights = np.zeros((len(everywhere), len(languages)), np.float32), np.zeros((len(contexts), len(languages)), np.float32)
        current = {}
        for k, lang in enumerate(languages):
            own, less = tables[n - 1].loc[lang], discounts[n, lang]
            by = own.groupby(own.index.str[:-1])
            total = by["total"].first()
            share = 1 - (by["n"].sum() - less * by.size()) / total
            in_all = pd.Series(everywhere.str[:-1])
            back = in_all.map(share).fillna(1.0).to_numpy()
            base = np.full(len(everywhere), 1 / alphabet) if n == 1 else pd.Series(everywhere.str[1:]).map(lower[lang]).to_numpy()
            seen = (own["n"].reindex(everywhere).fillna(0).to_numpy() - less).clip(0) / in_all.map(total).fillna(1).to_numpy()
            p = seen + back * base
            current[lang] = pd.Series(p, index=everywhere)
            logs[:, k] = np.log(p)
            weights[:, k] = np.log(pd.Series(contexts).map(share).fillna(1.0).to_numpy())
            if n == 1:
                unknown[k] = np.log(share.iloc[0] / alphabet)
        lower = current
        grams.append(HashTable(_hash_strings(everywhere, n), logs))
        if n > 1:
            backoff.append(HashTable(_hash_strings(contexts, n - 1), weights))
    return Model(languages, order, grams, backoff, unknown)


def count_grams(df: DataFrame, text: str, lang: str, order: int) -> DataFrame:
    """lang, gram, n: the n-grams of the highest order, summed in each slice before the shuffle."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            langs = batch.column(lang).to_pylist()
            names = sorted(set(langs))
            code = np.array([names.index(x) for x in langs], np.uint64)
            line, place, of, _ = characters(batch.column(text).to_pylist(), order)
            with np.errstate(over="ignore"):
                key = mix(gram_hashes(line, place, order) + code[of] * np.uint64(0xD1342543DE82EF95))
            _, at, n = np.unique(key, return_index=True, return_counts=True)
            points = np.stack([line[place[at] - back] for back in range(order - 1, -1, -1)], axis=1).astype(np.uint32) if len(at) else np.zeros((0, order), np.uint32)
            strings = ["".join(map(chr, row)) for row in points.tolist()]
            return pa.RecordBatch.from_arrays([pa.array([names[int(code[of[i]])] for i in at], pa.string()), pa.array(strings, pa.string()), pa.array(n, pa.int64())], ["lang", "gram", "n"])

        return step

    return map_blocks(df.select(text, lang), text, make, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _upto(df: DataFrame, lang: str, counts: dict[str, int], bound: int, salt: int) -> DataFrame:
    """About ``bound`` rows of each language, by a hash of all columns, so that copies with ids of their own are drawn one by one."""
    limits = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, bound / max(n, 1)))])
    place = F.pmod(F.xxhash64(F.lit(salt), *df.columns), F.lit(1 << 30)) / F.lit(1 << 30)
    return df.where(place < limits[F.col(lang)])


def learn(grams: DataFrame, order: int, max_ngrams: int, group: int) -> Models | None:
    """Models from lang, gram, n of the highest order: counts, totals and discounts of all n-grams, then the most frequent of each order and language."""
    tables = [checkpointed(grams)]
    for n in range(order - 1, 0, -1):
        tables.append(tables[-1].groupBy("lang", F.substring("gram", 2, n).alias("gram")).agg(F.count(F.lit(1)).alias("n")))
    every = tables[0].select(F.lit(order).alias("size"), "lang", "gram", "n")
    for n, table in zip(range(order - 1, 0, -1), tables[1:]):
        every = every.union(table.select(F.lit(n).alias("size"), "lang", "gram", "n"))
    every = checkpointed(every)
    some = every.groupBy("size", "lang").agg(F.sum((F.col("n") == 1).cast("long")), F.sum((F.col("n") == 2).cast("long"))).collect()
    discounts = {(r[0], r[1]): discount(r[2], r[3]) for r in some}
    languages = sorted({r[1] for r in some})
    if not languages:
        return None
    alphabet = every.where("size = 1").select("gram").distinct().count() + 1
    total = F.sum("n").over(Window.partitionBy("size", "lang", F.expr("substring(gram, 1, size - 1)")))
    rank = F.row_number().over(Window.partitionBy("size", "lang").orderBy(F.desc("n"), "gram"))
    kept = every.withColumn("total", total).withColumn("rank", rank).where(F.col("rank") <= max_ngrams).drop("rank")
    parts = [languages[i : i + group] for i in range(0, len(languages), group)]
    if len(parts) > 1:
        kept = checkpointed(kept)
    return Models([build((kept.where(F.col("lang").isin(own)) if len(parts) > 1 else kept).toPandas(), discounts, alphabet, order) for own in parts])


def train(
    df: DataFrame, text: str = "text", lang: str = "lang", order: int = ORDER, fit_docs: int = FIT_DOCS, calibration_docs: int = CALIBRATION_DOCS,
    max_ngrams: int = MAX_NGRAMS, group: int = GROUP_LANGUAGES,
) -> Models | None:
    """Learn every language from the rows with a language and a text; None if there is none.

    The sample of a language is bounded (``fit_docs`` and ``calibration_docs`` texts on average, drawn
    by hash, the two apart; ``df`` should have an id, or else all copies of a text are drawn together), and so is its part of a model (``max_ngrams`` of each order, ties by the n-gram), which is broadcast.  Null texts and languages
    teach nothing; fully repeated rows are drawn together.
    """
    known = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in known.groupBy(lang).count().collect()}
    if not counts:
        return None
    fit_part = F.pmod(F.xxhash64(F.lit(7), text), F.lit(5)) > 0
    model = learn(count_grams(_upto(known.where(fit_part), lang, counts, fit_docs * 5 // 4, 1), text, lang, order), order, max_ngrams, group)
    if model is None:
        return None
    scored = score(_upto(known.where(~fit_part), lang, counts, calibration_docs * 5, 2).select(text, lang), model, text, rejecting=False)
    own = scored.where((F.col(lang) == F.col("lang_pred")) & (F.col("n_letters") >= 20)).groupBy(lang).agg(F.avg("cross_entropy"), F.coalesce(F.stddev_samp("cross_entropy"), F.lit(0.0)))
    spread = {r[0]: r[1] + REJECT_DEVIATIONS * r[2] + REJECT_SLACK for r in own.collect()}
    model.limit = np.array([spread.get(x, np.inf) for x in model.languages])
    return model


def score(df: DataFrame, model: Models | None, text: str = "text", rejecting: bool = True) -> DataFrame:
    """Add lang_pred, score, cross_entropy (nats a character), n_letters and rejected to every row.

    The language with the lowest cross-entropy over the whole text wins, ties by name.  ``score`` is its
    posterior if each text has at most ``EVIDENCE`` characters of evidence.  Null texts and texts
    without letters get ``und``, score 0 and rejection, as does every text without a model.  A text is also rejected
    when its cross-entropy is above its language's limit.
    Columns that already have these names are replaced.
    """
    df = df.drop("lang_pred", "score", "cross_entropy", "n_letters", "rejected")
    fields = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("cross_entropy", T.DoubleType()), ("n_letters", T.LongType()), ("rejected", T.BooleanType())]
    if model is None:
        return df.selectExpr("*", "'und' as lang_pred", "0D as score", "cast(null as double) as cross_entropy", "0L as n_letters", "true as rejected")
    sent = df.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*df.schema.fields, *(T.StructField(k, t) for k, t in fields)])

    def make():
        m = sent.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            entropy, length, letters = m.cross_entropy(batch.column(text).to_pylist())
            best = entropy.argmin(axis=1)
            least = entropy[np.arange(len(best)), best]
            odds = np.exp((least[:, None] - entropy) * np.minimum(length, EVIDENCE)[:, None])
            some = letters > 0
            names = np.array([*m.languages, "und"], object)[np.where(some, best, len(m.languages))]
            sure = np.where(some, 1 / odds.sum(axis=1), 0.0)
            out = ~some | (least > m.limit[best]) if rejecting and m.limit is not None else ~some
            columns = [pa.array(names.tolist(), pa.string()), pa.array(sure, pa.float64()), pa.array(least, pa.float64(), mask=~some), pa.array(letters, pa.int64()), pa.array(out, pa.bool_())]
            return pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *(k for k, _ in fields)])

        return step

    return map_blocks(df, text, make, schema, _BLOCK)


def op1_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every whole text; learned where crc32(doc_id) mod 3 is not 1."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = train(docs.where(crc32_fold("doc_id", 3) != 1))  # ids only draw the sample
    out = score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (crc32_fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")
