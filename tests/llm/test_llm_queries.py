"""The numbered queries: against their SQL where there is one, or else each contract column against brute force."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxtile.llm import mixing, order_minhash
from voxtile.llm.queries import ORACLES, QUERIES

duckdb = pytest.importorskip("duckdb")


def texts_of(sf):
    return dict(duckdb.sql(f"select doc_id, coalesce(text, '') from '{sf}/documents.parquet' order by 1").fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf, name):
    df = QUERIES[name](spark, sf)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    r = con.execute(ORACLES[name])
    columns = [c[0] for c in r.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(r.fetchall())


@pytest.mark.parametrize("rows", [1000, 37, 1])
def test_op7_whatever_the_batches(spark, rows):
    """A larger table, where texts that end in a repeat stand before texts that start with one."""
    larger = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{larger}/documents.parquet'")
    r = con.execute(ORACLES["op7_suffix_repetition"])
    name, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(name, rows)
    try:
        df = QUERIES["op7_suffix_repetition"](spark, larger)
        assert sorted(map(tuple, df.select(*[c[0] for c in r.description]).collect())) == sorted(r.fetchall())
    finally:
        spark.conf.set(name, before)


@pytest.mark.parametrize("name", ["op4_repeated_passages", "op10_jaccard_join"])
def test_same_rows_as_sql_on_a_larger_table(spark, name):
    larger = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{larger}/documents.parquet'")
    r = con.execute(ORACLES[name])
    assert sorted(map(tuple, QUERIES[name](spark, larger).select(*[c[0] for c in r.description]).collect())) == sorted(r.fetchall())


def fold(i: int, n: int) -> int:
    return zlib.crc32(str(i).encode()) % n


def test_op1_columns(spark, sf):
    got = QUERIES["op1_kneser_ney"](spark, sf).collect()
    languages = {r[0] for r in duckdb.sql(f"select distinct lang from '{sf}/documents.parquet'").fetchall()}
    truth = dict(duckdb.sql(f"select doc_id, lang from '{sf}/documents.parquet' where lang is not null").fetchall())
    assert sorted(r["doc_id"] for r in got) == sorted(texts_of(sf))
    assert all(r["held_out"] == (fold(r["doc_id"], 3) == 1) and r["lang_pred"] in languages | {"und"} and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.9


def test_op2_columns(spark, sf):
    texts = {i: [w.lower() for w in t.encode().split()] for i, t in texts_of(sf).items()}
    counts: dict[bytes, int] = {}
    for i, words in texts.items():
        if fold(i, 5) != 1:
            for w in [*words, b"\n"]:
                counts[w] = counts.get(w, 0) + 1
    total, kinds = sum(counts.values()), len(counts)
    got = {r["doc_id"]: r for r in QUERIES["op2_gru_lm"](spark, sf).collect()}
    assert set(got) == set(texts)
    for i, words in texts.items():
        every = [counts.get(w, 0) for w in [*words, b"\n"]]
        base = sum(np.log10((c + 0.5) / (total + 0.5 * (kinds + 1))) for c in every)
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (fold(i, 5) == 1, len(every), sum(c > 0 for c in every), total)
        assert abs(r["base_score"] - base) < 1e-6 * max(1, -base) and r["score"] < 0
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_op3_columns(spark, sf):
    got = QUERIES["op3_ordinal_toxicity"](spark, sf).collect()
    toxic = dict(duckdb.sql(f"select doc_id, toxic from '{sf}/labels.parquet' where toxic is not null").fetchall())
    assert sorted(r["doc_id"] for r in got) == sorted(texts_of(sf))
    assert all(0 <= r["severity"] <= 2 and r["held_out"] == (fold(r["doc_id"], 5) == 1) for r in got)
    assert np.mean([r["toxic_pred"] == bool(toxic[r["doc_id"]]) for r in got if r["doc_id"] in toxic]) > 0.9


def test_op5_columns(spark, sf):
    got = QUERIES["op5_pivotal_mix"](spark, sf).collect()
    docs = duckdb.sql(f"select doc_id, source, coalesce(text, '') from '{sf}/documents.parquet'").fetchall()
    size = {i: len(t.encode().split()) for i, _, t in docs}
    source = {i: s for i, s, _ in docs}
    sizes: dict = {}
    for i, s in source.items():
        sizes[s] = sizes.get(s, 0) + size[i]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, left, open_ = {}, float(sum(sizes.values())), set(order)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = [s for s in open_ if share[s] >= 3 * sizes[s]]
        for s in full or open_:
            target[s] = 3.0 * sizes[s] if full else share[s]
        left -= sum(target[s] for s in full)
        open_ = open_ - set(full) if full else set()
    taken: dict = {}
    for r in got:
        s = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], sizes[s]) and abs(r["target"] - target[s]) < 1e-6 * max(1.0, target[s])
        assert 0 <= r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        taken[s] = taken.get(s, 0) + r["taken"]
    assert sorted(r["doc_id"] for r in got) == sorted(size)
    assert all(abs(taken[s] - target[s]) <= max(size[i] for i in size if source[i] == s) for s in sizes)
    assert sorted(map(tuple, got)) == sorted(map(tuple, QUERIES["op5_pivotal_mix"](spark, sf).collect()))


def test_mixed_rows(spark):
    """Columns of names that the operator uses, repeated rows, null sources and texts, and an empty table."""
    rows = [(i % 7, "r", 5, "x", "a b c d" if i % 3 else None, "s" if i % 2 else None) for i in range(60)] + [(1, "r", 5, "x", "same row", "s")] * 30
    df = spark.createDataFrame(rows, "doc_id long, row string, nth int, copies string, text string, source string")
    out = mixing.mixed(df)
    assert out.columns == df.columns and {r["row"] for r in out.collect()} == {"r"}
    number = {tuple(r)[:-1]: r["n"] for r in mixing.copies(df).groupBy("id", "size").agg(F.sum("copies").alias("n")).collect()}
    assert out.count() == sum(number.values())
    assert mixing.mixed(df.limit(0)).count() == 0


def test_op6_columns(spark, sf):
    tokenizers = pytest.importorskip("public_tokenizers")
    from voxtile.llm import bpe

    enc = bpe.encoding(tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN)
    got = {r["doc_id"]: r for r in QUERIES["op6_byte_bpe"](spark, sf).collect()}
    for i, t in texts_of(sf).items():
        ids = enc.encode_ordinary(t)
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == want


def merged(ranks: dict[bytes, int], piece: bytes) -> list[int]:
    """Byte pair merges of one piece by a heap of neighbours: lowest rank first, then leftmost."""
    import heapq

    parts = [piece[i : i + 1] for i in range(len(piece))]
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap = [(r, i, parts[i], parts[i + 1]) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i] if parts[i] is not None else len(parts)
        if parts[i] != a or j >= len(parts) or parts[j] != b:
            continue
        parts[i], parts[j], after[i] = a + b, None, after[j]
        if after[j] < len(parts):
            before[after[j]] = i
        for x, y in ((before[i], i), (i, after[i])):
            if x >= 0 and y < len(parts) and (r := ranks.get(parts[x] + parts[y])) is not None:
                heapq.heappush(heap, (r, x, parts[x], parts[y]))
    return [ranks[p] for p in parts if p is not None]


def test_op6_pieces_without_a_safe_place():
    """One match of the pattern over 400,000 characters long has the ids that its merges give."""
    tokenizers = pytest.importorskip("public_tokenizers")
    from voxtile.llm import bpe

    enc = bpe.encoding(tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN)
    ranks = enc._mergeable_ranks
    rng = np.random.default_rng(1)
    for text in ("hello", "x" * 401_000, "".join(rng.choice(list("etaoinshr"), 405_000))):
        assert bpe.encode_text(enc, text).tolist() == merged(ranks, text.encode())


def test_op8_columns(spark, sf):
    got = {r["doc_id"]: r for r in QUERIES["op8_order_minhash"](spark, sf).collect()}
    texts = texts_of(sf)
    ids = sorted(texts)
    signature = {i: order_minhash.signatures([texts[i]])[0] for i in ids}
    for i, j in zip(ids, [*ids[1:], ids[0]]):
        x, n = texts[i], len(texts[i]) // 4
        edited = x[: len(x) - n] + texts[j][:n]
        r, e = got[i], order_minhash.signatures([edited])[0]
        assert (r["n_chars"], r["edited_sha256"]) == (len(x), hashlib.sha256(edited.encode()).hexdigest())
        assert bytes.fromhex(r["fingerprint"]) == signature[i].tobytes() and bytes.fromhex(r["edited_fingerprint"]) == e.tobytes()
        for near, other in ((r["near_edited"], e), (r["near_next"], signature[j])):
            a = signature[i]
            same = 1.0 if (a == other).all() else float(((a == other) & (a > 0)).sum()) / max(1, int(((a > 0) | (other > 0)).sum()))
            assert abs(near - same) < 1e-12


def test_op9_columns(spark, sf):
    got = QUERIES["op9_html_crf"](spark, sf).collect()
    pages = dict(duckdb.sql(f"select page_id, url from '{sf}/pages.parquet'").fetchall())
    assert {r["page_id"]: r["url"] for r in got} == pages and all(r["n_chars"] == len(r["text"]) for r in got)
    assert all(line == " ".join(line.split()) and line for r in got if r["text"] for line in r["text"].split("\n"))
