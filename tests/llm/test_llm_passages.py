"""Passages are located by the automata: against brute force, with shards, and as the query returns them."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from voxtile.llm import passages
from voxtile.llm.graph import KeyFilter, maybe_in

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def test_locate_against_brute_force():
    rng = random.Random(1)
    for _ in range(400):
        width, letters = rng.choice([2, 3, 5, 8]), "abcdef"[: rng.choice([1, 2, 3, 6])]
        base = [rng.choice(letters) for _ in range(60)]
        phrases = [p for p in (base[a : a + rng.randint(width, width + 12)] for a in rng.sample(range(50), rng.randint(0, 4))) if len(p) >= width]
        texts = []
        for _ in range(4):
            t = []
            while len(t) < rng.randint(0, 40):
                a = rng.randint(0, 50)
                t += base[a : a + rng.randint(1, 14)] if rng.random() < 0.5 else [rng.choice("abcdefg")]
            texts.append(t)
        known = {tuple(p[i : i + width]) for p in phrases for i in range(len(p) - width + 1)}
        for t, got in zip(texts, passages.locate([" ".join(t).encode() for t in texts], [" ".join(p) for p in phrases], width, rng.choice([1, 40, 2000]))):
            want = {j for i in range(len(t) - width + 1) if tuple(t[i : i + width]) in known for j in range(i, i + width)}
            assert len(got) == len(t) and set(np.flatnonzero(got).tolist()) == want


def test_locate_in_a_periodic_text():
    (got,) = passages.locate([b"x y " * 20_000], [" ".join(["x", "y"] * 15_000)], 35)
    assert got.all()


def test_query_against_brute_force(spark, tmp_path):
    """Copies, a text within another, a passage twice in one text, repeated rows, empty and null texts, white space of all kinds."""
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    some = lambda n: " ".join(word() for _ in range(n))
    pool = [some(n) for n in (34, 35, 36, 60, 200)]
    texts = [f"{some(rng.randint(0, 30))} {rng.choice(pool)}\n{some(rng.randint(0, 40))} {rng.choice(pool)}" for _ in range(60)]
    texts += [pool[4], pool[4], "\t".join(pool[3].split()), f"{pool[1]} {pool[1]}", some(500), some(34), "", None, "  \n", some(20_000)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0])]
    (tmp_path / "d").mkdir()
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/d/documents.parquet")
    got = {r["doc_id"]: r for r in passages.op4_repeated_passages(spark, f"{tmp_path}/d").collect()}
    docs = [WORDS.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + 35]) for w in docs for i in range(len(w) - 34))
    for (i, _), w in zip(rows, docs):
        gone = {j for k in range(len(w) - 34) if seen[tuple(w[k : k + 35])] > 1 for j in range(k, k + 35)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    assert sum(r["n_removed"] > 0 for r in got.values()) > 30


def test_automata_decide(spark, monkeypatch):
    """Nothing is located without the automata."""
    monkeypatch.setattr(passages, "locate", lambda texts, *_: [np.zeros(len(x.split()), bool) for x in texts])
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(passages)
    try:
        text = " ".join(f"w{i}" for i in range(50))
        assert passages.recurring_passages(spark.createDataFrame([(1, text), (2, text)], "i int, text string")).count() == 0
    finally:
        cloudpickle.unregister_pickle_by_value(passages)


def test_columns_of_any_name(spark):
    text = " ".join(f"w{i}" for i in range(40))
    names = ["row", "text_hash", "text_check", "kept", "slice", "spans"]
    df = spark.createDataFrame([(*range(6), text), (*range(6), text), (*range(6), None)], ", ".join(f"{c} long" for c in names) + ", text string")
    got = passages.remove_passages(df)
    assert got.columns == [*names, "text", "n_removed"]
    assert sorted((str(r["text"]), r["n_removed"], r["kept"]) for r in got.collect()) == [("", 40, 3), ("", 40, 3), ("None", 0, 3)]
    assert passages.remove_passages(df.limit(0)).count() == 0


def test_key_filter(spark):
    df = spark.range(2000).withColumn("x", F.lit(1))
    keys = KeyFilter(spark.range(0, 2000, 7), "id")
    inside, outside = maybe_in(df, "id", keys), maybe_in(df, "id", keys, inside=False)
    assert inside.columns == df.columns and inside.where("id % 7 = 0").count() == 286 and inside.count() < 500
    assert outside.where("id % 7 = 0").count() == 0 and outside.count() + inside.count() == 2000
    none = KeyFilter(spark.range(0), "id")
    assert maybe_in(df, "id", none).count() == 0 and maybe_in(df, "id", none, inside=False).count() == 2000


def test_column_names_with_dots(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, text, "x"), (2, f"a {text}", "y"), (3, "short", "z")], "`doc.id` int, `the.text` string, `a.b` string")
    got = passages.remove_passages(df, "the.text")
    assert got.columns == ["doc.id", "the.text", "a.b", "n_removed"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, "", "x", 40), (2, "a", "y", 40), (3, "short", "z", 0)]


def test_automata_hold_only_the_first_words_of_blocks(monkeypatch):
    """Patterns of six words find what blocks of eighteen do, with a part of the automaton's characters; blocks that begin alike are told apart."""
    import ahocorasick

    added = []

    class Counted:
        def __init__(self):
            self.made = made()

        def add_word(self, pattern, value):
            added.append(pattern)
            return self.made.add_word(pattern, value)

        def __len__(self):
            return len(self.made)

        def __getattr__(self, name):
            return getattr(self.made, name)

    made = ahocorasick.Automaton
    monkeypatch.setattr(ahocorasick, "Automaton", Counted)
    rng = random.Random(5)
    line = "one two three four five six".split()
    phrases = [line + [f"w{rng.randrange(10**6)}" for _ in range(66)] for _ in range(30)]
    texts = [["a"] * k + p[k : 40 + k] + ["z"] for k, p in enumerate(phrases)]
    got = passages.locate([" ".join(t).encode() for t in texts], [" ".join(p) for p in phrases], 35)
    for k, flags in enumerate(got):
        assert np.flatnonzero(flags).tolist() == list(range(k, k + 40))
    assert max(len(p.split()) for p in added) == passages.LEAD and sum(map(len, added)) < sum(len(" ".join(p)) for p in phrases) / 2


def test_agreeing_words():
    rng = random.Random(6)
    for _ in range(2000):
        a, b = ([rng.choice("ab") if rng.random() < 0.1 else "a" for _ in range(rng.randint(0, 40))] for _ in range(2))
        x, y = rng.randint(0, len(a)), rng.randint(0, len(b))
        ahead = next((k for k in range(min(len(a) - x, len(b) - y)) if a[x + k] != b[y + k]), min(len(a) - x, len(b) - y))
        back = next((k for k in range(min(x, y)) if a[x - k - 1] != b[y - k - 1]), min(x, y))
        assert (passages.agreeing(a, x, b, y), passages.agreeing(a, x, b, y, -1)) == (ahead, back)


def test_a_common_line_does_not_bring_every_passage_to_every_slice(spark, monkeypatch):
    """Copied texts with one line in common: a slice gets the passages that share a window with its texts, not all that have the line's anchors."""
    monkeypatch.setattr(passages, "STREAM_BYTES", 3000)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    line = " ".join(word() for _ in range(25))
    texts = []
    for _ in range(40):
        own = f"{' '.join(word() for _ in range(60))} {line} {' '.join(word() for _ in range(60))}"
        texts += [f"{own} {word()}", f"{word()} {own}"]
    met = []
    meet = passages.met_by
    monkeypatch.setattr(passages, "met_by", lambda *x: met.append(meet(*x)) or met[-1])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["text_hash"]: r["n_removed"] for r in passages.recurring_passages(df).collect()}
    assert len(got) == 80 and set(got.values()) == {145}
    slices = met[0].select("slice").distinct().count()
    assert slices > 10 and met[0].count() < 40 * 4 < 40 * slices
