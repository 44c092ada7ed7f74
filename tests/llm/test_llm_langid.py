"""Interpolated Kneser-Ney against a plain version of its definition."""

from collections import Counter

import numpy as np
import pandas as pd

from voxtile.llm import langid

ORDER = 4


def plain(texts: list[str], alphabet: int):
    """Probability of a character after a history, by the recursive definition over dictionaries."""
    start = chr(langid._START)
    tables = [Counter() for _ in range(ORDER + 1)]
    for t in texts:
        line = start * (ORDER - 1) + t
        tables[ORDER].update(line[i - ORDER + 1 : i + 1] for i in range(ORDER - 1, len(line)))
    for n in range(ORDER - 1, 0, -1):
        tables[n] = Counter(g[1:] for g in tables[n + 1])  # distinct longer n-grams
    less = {}
    for n in range(1, ORDER + 1):
        ones, twos = (sum(c == k for c in tables[n].values()) for k in (1, 2))
        less[n] = min(max(ones / (ones + 2 * twos) if ones else 0.5, 0.05), 0.95)

    def p(history: str, c: str, n: int = ORDER) -> float:
        if n == 0:
            return 1 / alphabet
        context = history[len(history) - n + 1 :]
        own = [v for g, v in tables[n].items() if g[:-1] == context]
        if not own:
            return p(history, c, n - 1)
        return max(tables[n][context + c] - less[n], 0) / sum(own) + less[n] * len(own) / sum(own) * p(history, c, n - 1)

    return p


def test_model_against_the_definition():
    rng = np.random.default_rng(2)
    texts = {"aa": ["".join(rng.choice(list("abc "), 30)).strip().replace("  ", " ") for _ in range(12)], "bb": ["".join(rng.choice(list("bcde "), 25)) for _ in range(9)]}
    texts = {k: [" ".join(t.split()) for t in v] for k, v in texts.items()}
    start = chr(langid._START) * (ORDER - 1)
    rows = [(lang, (start + t)[i : i + ORDER], 1) for lang, own in texts.items() for t in own for i in range(len(t))]
    model = langid.fit(pd.DataFrame(rows, columns=["lang", "gram", "n"]), ORDER)
    alphabet = len({c for own in texts.values() for t in own for c in t}) + 1
    tests = ["abcab", "b", "ce de bc", "zz ab", "edcba abcde"]
    got, length, _ = model.cross_entropy(tests)
    for k, lang in enumerate(model.languages):
        p = plain(texts[lang], alphabet)
        for i, t in enumerate(tests):
            want = -sum(np.log(p(start + t[:j], t[j])) for j in range(len(t))) / len(t)
            assert length[i] == len(t) and abs(got[i, k] - want) < 1e-5


def test_hash_array_finds_what_it_holds():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2)
    table = langid.HashTable(keys, np.arange(5000))
    assert (np.diff(table.hashes.astype(object)) > 0).all()
    at = table.find(keys)
    assert (table.rows[at] == np.arange(5000)).all() and (table.find(keys + np.uint64(1)) == -1).all()


def test_copies_are_drawn_one_by_one(spark):
    """A text that most rows share neither fills the sample nor is left out of it."""
    df = spark.range(4000).selectExpr("id as doc_id", "'same text' as text", "'xx' as lang")
    n = langid._upto(df, "lang", {"xx": 4000}, 500, 1).count()
    assert 350 < n < 650


def test_odd_rows(spark):
    """Null texts and languages, texts without letters, repeated rows, columns of clashing names and an empty table."""
    rows = [(i % 5, ("el perro come pan " if i % 2 else "the dog eats the bread ") * 3, "es" if i % 2 else "en", 7) for i in range(80)]
    rows += [(1, None, "es", 7), (2, "12 34", "en", 7), (3, "the cat", None, 7), (3, "the cat", None, 7), (4, "", None, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = langid.score(df, langid.train(df)).collect()
    assert len(got) == len(rows) and {r["lang_pred"] for r in got if r["text"] in (None, "", "12 34")} == {"und"}
    assert {r["lang_pred"] for r in got if r["text"] == "the cat"} == {"en"} and all(0 <= r["score"] <= 1 for r in got)
    assert langid.train(df.limit(0)) is None and langid.score(df, None).where("lang_pred != 'und' or not rejected").count() == 0
