"""Passage quality: features and attention against plain versions, gradients against differences, held-out labels."""

import math
import re
import zlib

import numpy as np
import pytest

from voxtile.llm import passage_quality as q
from voxtile.llm.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
LONG = " ".join(f"w{i % 977}" for i in range(120_000))


def plain_passages(text: bytes):
    """Byte counts of each passage, in loops."""
    starts = [m.start() for m in re.finditer(rb"[^\x20\x09-\x0d]+", text)]
    width = max(q.PASSAGE_WORDS, math.ceil(len(starts) / q.MOST_PASSAGES))
    edges = [0, *starts[width::width], len(text)]
    out = []
    for a, b in zip(edges, edges[1:]):
        kinds, pieces = np.zeros(q.KINDS**2), np.zeros(q.BUCKETS)
        for i in range(a, b):
            w = text[i : i + 3]
            if len(w) > 1 and w[1]:
                kinds[q._KIND[w[0]] * q.KINDS + q._KIND[w[1]]] += 1
            if len(w) == 3 and w[1] and w[2]:
                x, y, z = (int(c) for c in w.lower())
                pieces[((x * 0x9E3779B1 + y * 0x85EBCA77 + z * 0xC2B2AE3D) % 2**32) >> 24] += 1
        begun = [i for i in starts if a <= i < b]
        share = pieces / max(pieces.sum(), 1)
        stats = [math.log1p(len(begun)) / 5, 4 * len(begun) / max(kinds.sum(), 1), sum(65 <= text[i] <= 90 for i in begun) / max(len(begun), 1)]
        stats += [math.log(max((share**2).sum(), 1 / q.BUCKETS)) / 5 + 1, float(not begun)]
        out.append(np.concatenate([np.sqrt(kinds / max(kinds.sum(), 1)), np.sqrt(share), stats]))
    return out


def test_passages(monkeypatch):
    rng = np.random.default_rng(2)
    make = lambda n: " ".join("".join(rng.choice(list("abCé!9#"), rng.integers(1, 9))) for _ in range(n))
    texts = [x.encode() for x in ("", " ", "one", "a\nb", f" {make(64)} ", make(65), make(300), "\t\n", make(5000), make(128), "x")]
    for chunk in (250_000, 50, 7):
        monkeypatch.setattr(q, "_CHUNK", chunk)
        x, first = q.passages(texts)
        edge = np.append(first, len(x))
        for text, a, b in zip(texts, edge, edge[1:]):
            want = plain_passages(text)
            assert len(want) == b - a <= q.MOST_PASSAGES and np.allclose(x[a:b], want, atol=1e-5)


def model_of(features, seed=3):
    m = {k: v.astype(float) for k, v in q.initial(features, seed).items()}
    return {k: v + np.random.default_rng(seed).normal(0, 0.1, v.shape) for k, v in m.items()}


def test_gradient_and_attention():
    rng = np.random.default_rng(4)
    x, first, label, weight = rng.normal(size=(9, 5)), np.array([0, 1, 5]), np.array([1.0, 0.0, 1.0]), np.array([0.5, 2.0, 1.0])
    m = model_of(5)
    f = q.forward(m, x, first)
    for i, (a, b) in enumerate(zip(first, [*first[1:], 9])):  # by the definition, document by document
        h = np.tanh(x[a:b] @ m["W"] + m["b"])
        e = [float(m["w"] @ (np.tanh(r @ m["V"]) / (1 + np.exp(-(r @ m["U"]))))) for r in h]
        share = np.exp(e) / np.exp(e).sum()
        assert np.allclose(f["a"][a:b], share) and np.isclose(f["s"][i], m["c"] @ (share @ h) + m["d"][0])
    _, g = q.gradient(m, x, first, label, weight)
    for name, v in m.items():
        for at in np.ndindex(v.shape):
            if rng.random() > 40 / v.size:
                continue
            keep, step = v[at], 1e-5
            v[at] = keep + step
            up = q.gradient(m, x, first, label, weight)[0]
            v[at] = keep - step
            down = q.gradient(m, x, first, label, weight)[0]
            v[at] = keep
            assert math.isclose(g[name][at], (up - down) / (2 * step), rel_tol=1e-4, abs_tol=1e-8)


def test_one_bad_passage_counts(spark):
    """The label hangs on single passages; attention has to find them."""
    rng = np.random.default_rng(8)
    good = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n))
    bag = lambda bad: " ".join([good(64 * int(rng.integers(1, 6))), *(["##$$ " * 64] if bad else []), good(64 * int(rng.integers(1, 6)))])
    rows = [(i, bag(i % 2), 1 - i % 2) for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id int, text string, quality int")
    model = q.train(df.where("doc_id < 180"))
    got = q.score(df.where("doc_id >= 180"), model).collect()
    assert np.mean([(r["score"] >= 0.5) == bool(r["quality"]) for r in got]) > 0.95
    mean = lambda k: np.mean([r["top_attention"] * r["n_passages"] for r in got if r["quality"] == k])
    assert mean(0) > mean(1)


def test_odd_rows(spark):
    docs = [(i, "fine words here" if i % 3 else "### $$$ !!!", 5) for i in range(60)]
    labels = [(i, int(i % 3 > 0)) for i in range(60)] + [(1, 1), (2, None), (None, 1), (3, 7)]
    df = spark.createDataFrame(docs, "doc_id int, text string, score int")
    known = df.join(spark.createDataFrame(labels, "doc_id int, quality int"), "doc_id")
    model = q.train(known)
    odd = spark.createDataFrame([(None,), ("",), ("  ",), (LONG,), ("fine words here",), ("fine words here",), ("### $$$ !!!",)], "text string")
    out = q.score(odd.selectExpr("text", "1 as score", "2 as n_passages"), model)
    assert out.columns == ["text", "score", "n_passages", "top_attention"]
    got = [(r["text"], r["score"], r["n_passages"]) for r in out.collect()]
    by = {t: (s, n) for t, s, n in got}
    assert len(got) == 7 and by[None] == by[""] and by[LONG][1] == q.MOST_PASSAGES and all(0 <= s <= 1 for _, s, _ in got)
    assert by["fine words here"][0] > 0.7 > by["### $$$ !!!"][0]
    assert q.score(odd.limit(0), model).count() == 0
    none, one = q.train(known.limit(0)), q.train(known.where("quality = 1"))
    assert {r["score"] for r in q.score(odd, none).collect()} == {0.5} and {r["score"] > 0.9 for r in q.score(odd, one).collect()} == {True}


def test_same_rows_give_the_same_scores(spark):
    rows = [(i, f"text {i} of some words" * (i % 7 + 1), i % 2) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id int, text string, quality int")
    a, b = (sorted((r["doc_id"], r["score"]) for r in q.score(x, q.train(x)).collect()) for x in (df.repartition(1), df.repartition(5)))
    assert np.allclose(a, b, atol=1e-6)


def test_op11_columns(spark):
    larger = "/root/testdata/sf0.01"
    got = QUERIES["op11_attention_mil"](spark, larger).collect()
    ids = {r[0] for r in duckdb.sql(f"select doc_id from '{larger}/documents.parquet'").fetchall()}
    label = dict(duckdb.sql(f"select doc_id, quality from '{larger}/labels.parquet' where quality is not null").fetchall())
    assert {r["doc_id"] for r in got} == ids and len(got) == len(ids)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in label]
    good, bad = ([r["score"] for r in held if label[r["doc_id"]] == k] for k in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.97 and np.mean([r["predicted"] == label[r["doc_id"]] for r in held]) > 0.9
