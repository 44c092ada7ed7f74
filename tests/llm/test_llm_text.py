"""The text operators against brute-force versions, on small tables with nulls, empty and odd texts, ties and repeated rows."""

import base64
import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxtile.llm import bpe, gru, html_crf, jaccard_join, langid, lm, mixing, order_minhash, passages, repetition, toxicity

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, n int, kept boolean"


def make(spark, texts, ids=None):
    """Documents with further columns whose names clash with those that operators add or use."""
    rows = [(i, x, ["en", "de", None][k % 3], [None, "a", "b"][k % 3], len(x or ""), 0.5, k, True) for k, (i, x) in enumerate(zip(ids or range(len(texts)), texts))]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(7)
    vocab = ["".join(rng.choice(list("abcdeéö日"), rng.integers(1, 6))) for _ in range(300)]
    base = [" ".join(rng.choice(vocab, n)) for n in (3, 9, 60, 80, 120, 200)]
    words = base[4].split()
    near = words.copy()
    near[50] = "changed"
    passage = " ".join(rng.choice(vocab, 45))
    out = [*base, base[4], " ".join(near), f"{base[2]} {passage} tail", f"Head\x0bhere {passage}\n{base[3]}", f"{passage} x {passage}", None, "", " \t\n", "one", "one", "One", "  ", "line one two\n" * 30, "日本語" * 400]
    return out + [base[5].upper(), base[5]]


def test_bpe(spark, texts):
    rank_file, pattern = bpe.default_rank_file()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(rank_file, "rb"))}
    import regex

    def merged(piece):
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 40))
            if parts[best] + parts[best + 1] not in ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [ranks[p] for p in parts]

    df = make(spark, [*texts, "<|endoftext|> it's  12ab\t\n "])
    got = {r["doc_id"]: r for r in bpe.decode_documents(bpe.encode_documents(df, rank_file, pattern), rank_file, pattern).collect()}
    for r in df.collect():
        x = r["text"] or ""
        want = [i for m in regex.findall(pattern, x) for i in merged(m.encode())]
        assert np.frombuffer(got[r["doc_id"]]["ids"], "<u4").tolist() == want and bytes(got[r["doc_id"]]["decoded"]) == x.encode()
    enc = bpe.encoding(rank_file, pattern)
    long = "word and\n\n  more 12 " * 30_000
    assert len(bpe.safe_parts(long)) > 3 and bpe.encode_text(enc, long).tolist() == enc.encode_ordinary(long)
    for x in (" " * 500_000 + "a", "x" * 450_000):
        assert enc.decode_bytes(bpe.encode_text(enc, x).tolist()) == x.encode()


def test_repetition(spark, texts):
    for r in repetition.repetition(make(spark, texts)).collect():
        x = r["text"] or ""
        w = WORDS.findall(x)
        five = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {j for i in range(len(w) - 4) if five[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        longest = max((n for n in range(1, len(w)) if len({tuple(w[i : i + n]) for i in range(len(w) - n + 1)}) < len(w) - n + 1), default=0) if len(w) < 130 else r["longest_repeat"]
        lines = [y for y in x.split("\n") if WORDS.search(y)]
        assert (r["n_words"], r["n_repeat_words"], r["longest_repeat"]) == (len(w), len(covered), longest)
        assert r["n_dup_lines"] == len(lines) - len(set(lines)) and r["word_chars"] == sum(map(len, w)) and r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", x))
        assert sorted(covered) == [i for s in r["repeats"] for i in range(s["start"], s["end"])]


def test_passages(spark, texts):
    df = make(spark, texts)
    docs = [WORDS.findall(x or "") for x in texts]
    seen = Counter(tuple(w[i : i + 35]) for w in docs for i in range(len(w) - 34))
    out = {r["doc_id"]: r for r in passages.remove_passages(df).collect()}
    assert passages.remove_passages(df).columns == [*df.columns, "n_removed"]
    for i, w in enumerate(docs):
        gone = {j for k in range(len(w) - 34) if seen[tuple(w[k : k + 35])] > 1 for j in range(k, k + 35)}
        assert out[i]["n_removed"] == len(gone)
        assert out[i]["text"] == (" ".join(x for j, x in enumerate(w) if j not in gone) if gone else texts[i])
    assert passages.remove_passages(df.limit(0)).count() == 0


def test_passages_random(spark):
    rng = np.random.default_rng(2)
    pool = [" ".join(f"w{v}" for v in rng.integers(0, 9, n)) for n in (36, 50, 90)]
    docs = [" ".join(rng.choice([*pool, *(f"u{v}" for v in rng.integers(0, 10**6, 20))], 4)) for _ in range(60)]
    seen = Counter(tuple(w[i : i + 35]) for w in map(str.split, docs) for i in range(len(w) - 34))
    got = {r["doc_id"]: r["n_removed"] for r in passages.remove_passages(make(spark, docs)).collect()}
    for i, d in enumerate(docs):
        w = d.split()
        assert got[i] == len({j for k in range(len(w) - 34) if seen[tuple(w[k : k + 35])] > 1 for j in range(k, k + 35)})


@pytest.mark.parametrize("n", [0, 1, 7, 8, 15, 20, 27, 34, 35, 36])
def test_passages_of_a_small_slice(spark, n):
    """A slice may have fewer words than a window, or hardly more."""
    text = " ".join(f"w{i}" for i in range(n))
    got = passages.remove_passages(make(spark, [text, "a b c"]).coalesce(1)).collect()
    assert all(r["n_removed"] == 0 for r in got)
    anchor, whole, of, first = passages._window_hashes([text.encode().split()], {}, 35, 8)
    assert len(anchor) == len(whole) == len(of) == len(first) == max(0, n - 34)


def components_of(texts):
    sets = []
    for x in texts:
        w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            parent = [min(parent[a], parent[b]) if p in (parent[a], parent[b]) else p for p in parent]
    return sets, parent


def test_jaccard_join(spark, texts):
    rng = np.random.default_rng(11)
    base = [f"w{v}" for v in rng.integers(0, 400, 150)]
    family = []
    for k in range(40):  # near copies, some at the threshold, in a chain
        w = base.copy()
        for at in rng.integers(0, 150, k // 4):
            w[at] = f"x{rng.integers(0, 10**6)}"
        family.append(" ".join(w[: 150 - k]))
    every = [*texts, *family]
    sets, parent = components_of(every)
    got = {r["doc_id"]: r for r in jaccard_join.jaccard_groups(make(spark, every)).collect()}
    assert [got[i]["n_shingles"] for i in range(len(every))] == [len(s) for s in sets]
    assert [got[i]["component_id"] for i in range(len(every))] == parent


def test_jaccard_join_rows_without_id(spark):
    got = jaccard_join.jaccard_groups(make(spark, ["a b", "a b", "a b", "c"], [5, 5, None, None])).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == [("5", "5"), ("5", "5"), ("None", "5"), ("None", "None")]
    assert jaccard_join.jaccard_groups(make(spark, ["a"]).limit(0)).count() == 0


def test_order_minhash(spark, texts):
    df = make(spark, texts).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    got = {r["doc_id"]: r for r in order_minhash.with_next(df, "doc_id", ["text"], buckets=5).collect()}
    for i in range(len(texts)):
        assert got[i]["next_text"] == (texts[(i + 1) % len(texts)] or "")
    prints = {}
    for r in order_minhash.fingerprint(df).collect():
        assert prints.setdefault(r["text"], bytes(r["fingerprint"])) == bytes(r["fingerprint"])
    words = [f"word{v}" for v in np.random.default_rng(0).integers(0, 10**6, 300)]
    text, moved = " ".join(words), " ".join(words[150:] + words[:150])
    edits = [" ".join([*words[: 300 - n], *[f"new{i}" for i in range(n)]]) for n in (10, 100, 290)]
    sig = order_minhash.signatures([text, moved, *edits])
    alike = [(sig[0] == s).mean() for s in sig]
    assert alike[0] == 1 and alike[2] > alike[3] > alike[4] and 0.8 > alike[1] > 0.3  # the same k-mers in another order
    one = order_minhash.with_next(df.limit(1), "doc_id", ["text"]).collect()
    assert len(one) == 1 and one[0]["next_text"] == one[0]["text"]
    assert order_minhash.with_next(df.limit(0), "doc_id", ["text"]).count() == 0


def test_mixing(spark, texts):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 30))), s) for i, s in enumerate(rng.choice(["a", "b", "c", "d"], 900, p=[0.7, 0.1, 0.1, 0.1]).tolist() + [None] * 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    df = df.union(df.limit(30)).repartition(7)
    got = mixing.copies(df).collect()
    assert len(got) == 980
    size, taken, target = Counter(), Counter(), {}
    for r in got:
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
        assert 0 <= r["copies"] <= 3
    order = [*sorted(k for k in size if k is not None), None]
    weight, capped = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, set()
    while True:
        rest = sum(size.values()) - sum(3 * size[s] for s in capped)
        level = rest / sum(w for s, w in weight.items() if s not in capped)
        if not (more := {s for s in weight if s not in capped and level * weight[s] > 3 * size[s]}):
            break
        capped |= more
    for s in size:
        assert math.isclose(target[s], 3 * size[s] if s in capped else level * weight[s], rel_tol=1e-9)
        assert abs(taken[s] - target[s]) <= 30
    again = {(r["id"], r["row"], r["nth"]): r["copies"] for r in mixing.copies(df.repartition(3)).collect()}
    assert again == {(r["id"], r["row"], r["nth"]): r["copies"] for r in got}
    assert mixing.mixed(df).count() == sum(r["copies"] for r in got)
    assert mixing.copies(df.limit(0)).count() == 0 and mixing.copies(make(spark, [None, ""])).count() == 2


def test_mixing_keeps_each_probability(spark):
    """Copies of one text over many draws: the mean is the text's share."""
    rows = [(i, " ".join(["w"] * (5 + i % 7)), "a" if i < 600 else "b") for i in range(900)]
    got = mixing.copies(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    share = {r["source"]: r["target"] / r["source_size"] for r in got}
    by = defaultdict(list)
    for r in got:
        by[r["source"], r["size"]].append(r["copies"])
    assert all(abs(np.mean(v) - share[s]) < 0.25 for (s, _), v in by.items())


def test_language_id(spark):
    rng = np.random.default_rng(0)
    stems = {"aa": ["the", "and", "ing", "tion", "er"], "bb": ["schen", "ung", "ein", "keit", "über"], "cc": ["ción", "los", "que", "ado", "ñas"]}
    say = lambda k, n: " ".join("".join(rng.choice(stems[k], rng.integers(1, 3))) for _ in range(n))
    train = [(say(k, 60), k) for k in stems for _ in range(40)] + [(None, "aa"), ("text", None)]
    model = langid.train(spark.createDataFrame(train, "text string, lang string"))
    tests = [(say(k, 12).upper(), k) for k in stems for _ in range(10)] + [(None, "und"), ("", "und"), ("12 % !", "und"), ("\x07" * 5, "und")]
    got = langid.score(spark.createDataFrame([(i, x, k, 9.0) for i, (x, k) in enumerate(tests)], "doc_id int, text string, want string, score double"), model).collect()
    assert all(r["lang_pred"] == r["want"] and 0 <= r["score"] <= 1 for r in got)
    assert all(r["rejected"] == (r["want"] == "und") for r in got)
    strange = langid.score(spark.createDataFrame([("жкщю зфгв " * 30,)], "text string"), model).first()
    assert strange["rejected"] and strange["lang_pred"] in stems
    assert langid.train(spark.createDataFrame([], "text string, lang string")) is None
    assert langid.score(spark.createDataFrame([("a",)], "text string"), None).first()["lang_pred"] == "und"


def test_kneser_ney_sums_to_one():
    counts = langid.pd.DataFrame({"lang": "x", "gram": ["\2\2ab"[i : i + 3] for i in (0, 1)] + ["abc", "abd", "bca", "cab", "abc"][:4], "n": [1, 2, 3, 1, 2, 1]})
    counts = counts.groupby(["lang", "gram"], as_index=False)["n"].sum()
    m = langid.fit(counts, 3)
    letters = sorted({c for g in counts["gram"] for c in g} - {"\2"})
    for context in ("ab", "bc", "zz", "\2\2"):
        line = np.array([[ord(c) for c in context + x] for x in [*letters, "?"]], np.uint64)
        total = 0.0
        for row in line:
            place, log = np.array([2]), 0.0
            for n in (3, 2, 1):
                at = m.grams[n - 1].find(langid.gram_hashes(row, place, n))[0]
                if at >= 0:
                    log += m.grams[n - 1].rows[at, 0]
                    break
                if n == 1:
                    log += m.unknown[0]
                else:
                    back = m.backoff[n - 2].find(langid.gram_hashes(row, place - 1, n - 1))[0]
                    log += m.backoff[n - 2].rows[back, 0] if back >= 0 else 0.0
            total += math.exp(log)
        assert 0.9 < total < 1.02


def test_toxicity(spark):
    rng = np.random.default_rng(1)
    clean, bad = [f"plain{i}" for i in range(200)], ["scumbag", "nastyword", "vilething"]
    rows = []
    for i in range(400):
        words = list(rng.choice(clean, 30))
        toxic = i % 4 == 0
        if toxic:
            for at in rng.integers(0, 30, 2 + i % 5):
                words[at] = str(rng.choice(bad)).upper()
        rows.append((i, " ".join(words), int(toxic), 1.0))
    df = spark.createDataFrame([*rows, (400, None, 1, 1.0), (401, "", None, 1.0)], "doc_id long, text string, toxic int, severity double")
    model = toxicity.train(df)
    assert (np.diff(model.thresholds) > 0).all()
    got = {r["doc_id"]: r for r in toxicity.severity(df, model).collect()}
    assert sum(got[i]["toxic_pred"] == (i % 4 == 0) for i in range(400)) >= 398 and not got[400]["toxic_pred"] and not got[401]["toxic_pred"]
    assert all(0 <= r["severity"] <= 2 for r in got.values())
    assert toxicity.train(df.where("toxic = 1")) is None and toxicity.severity(df, None).count() == 402


def test_gradients():
    v = gru.Vocabulary([b"a", b"b", b"c", b"d"], [5, 4, 3, 2])
    p = {k: a.astype(np.float64) for k, a in gru.initial(v).items()}
    x = gru.lanes([np.array([1, 2, 3, 4, 5]), np.array([2, 2]), np.array([], int)], 2)[:3]
    zero = np.zeros((2, gru.STATE))
    loss = lambda: -gru.run_window(p, v, gru.input_table(p), *x, zero, False)[0].sum()
    grads = gru.run_window(p, v, gru.input_table(p), *x, zero, True)[2]
    for k in gru.NAMES:
        at = np.unravel_index(np.abs(grads[k]).argmax(), grads[k].shape)
        p[k][at] += 1e-3
        high = loss()
        p[k][at] -= 2e-3
        low = loss()
        p[k][at] += 1e-3
        assert math.isclose((high - low) / 2e-3, grads[k][at], rel_tol=0.02, abs_tol=2e-3), k


def test_state_runs_on():
    """Windows don't change a document's likelihood, nor do its neighbours."""
    v = gru.Vocabulary([b"a", b"b", b"c"], [3, 2, 1])
    p = gru.initial(v)
    docs = [np.array(x, np.int32) for x in ([1, 2, 3] * 30, [2], [], [3, 3, 1, 4, 5] * 9)]
    whole = gru.log_likelihoods(p, v, docs, width=3, steps=500)
    assert np.allclose(whole, gru.log_likelihoods(p, v, docs, width=2, steps=7), atol=1e-3)
    assert np.allclose(whole, [gru.log_likelihoods(p, v, [d])[0] for d in docs], atol=1e-3)


def test_lm_base_and_training(spark, texts, monkeypatch, tmp_path):
    rng = np.random.default_rng(3)
    more = [" ".join(f"{'ab'[i % 2]}{v}" for v in rng.zipf(1.6, 40) if v < 500) for i in range(400)]
    df = make(spark, [*texts, *more])
    (tmp_path / "documents.parquet").mkdir()
    df.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(lm, "HEAD", 50)
    got = lm.op2_gru_lm(spark, str(tmp_path)).collect()
    tokens = {r["doc_id"]: [w.encode() for w in WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))] + ["end"] for r in df.collect()}
    c = Counter(t for i, x in tokens.items() if zlib.crc32(str(i).encode()) % 5 != 1 for t in x)
    n, v = sum(c.values()), len(c)
    assert len(got) == len(tokens)
    for r in got:
        x = tokens[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(x), sum(t in c for t in x), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in x), rel_tol=1e-9)
    held = [r for r in got if r["held_out"] and r["doc_id"] >= len(texts)]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_html(spark):
    pages = html_crf.labelled_pages(60, 77)
    chain = html_crf.fit(html_crf.labelled_pages(300), rounds=80)
    right = [a == b for page, labels in pages for a, b in zip(chain.decode(html_crf.leaf_blocks(page)), labels)]
    assert np.mean(right) > 0.97
    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href=/a>Home</a></ul></nav><div class='ad'>Buy now</div>"
        "<article><h1>Head &amp; line</h1><p><b>First\n  part<br>goes on.<p>Second &eacute;&#233; &lt;b&gt; here, a &nbsp; b.<!-- no --><aside>Related</aside><p>Third</p>"
        "<div class=comments><p>Reader says so.</p></div></article><footer>&copy; us</footer>"
    )
    rows = [(1, page), (2, None), (3, ""), (4, "<p"), (5, "a < b"), (6, "<!-- open"), (7, "<script>x"), (8, page + "<div title='unclosed>x</div>")]
    got = {r["page_id"]: r["text"] for r in html_crf.extract(spark.createDataFrame([(i, h, "old") for i, h in rows], "page_id int, html string, text string")).collect()}
    assert got[1] == "Head & line\nFirst part goes on.\nSecond éé <b> here, a b.\nThird"
    assert got[2] == got[3] == got[4] == got[6] == got[7] == "" and got[8].startswith("Head & line")


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    chain = html_crf.Chain(rng.normal(size=(len(html_crf.FEATURES), 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    for page, labels in html_crf.labelled_pages(30, 3):
        blocks = html_crf.leaf_blocks(page)[:8]
        score = [chain.weights[html_crf.features(b)].sum(axis=0) for b in blocks]

        def value(path):
            return chain.starts[path[0]] + sum(s[y] for s, y in zip(score, path)) + sum(chain.transitions[a, b] for a, b in zip(path, path[1:]))

        best = max(itertools.product((0, 1), repeat=len(blocks)), key=value)
        assert math.isclose(value([int(x) for x in chain.decode(blocks)]), value(best))


def test_digest_of_kept_words(spark):
    df = make(spark, ["a  b c", None, "  "]).withColumn("j", passages.words_joined("text"))
    got = [(r["c"], r["s"]) for r in df.select(passages.count_words(F.col("j")).alias("c"), F.sha2(F.col("j").cast("binary"), 256).alias("s")).collect()]
    assert got == [(n, hashlib.sha256(x.encode()).hexdigest()) for n, x in ((2, "a b c"), (0, ""), (0, ""))]


@pytest.mark.parametrize(
    "between, want",
    [
        ("<svg class='i'/>", []), ("<SVG\n/>", []), ("<math/>", []), ("<object data='x'>", []), ("<noscript>", []), ("<template>", []), ("<svg/><p>mid</p><svg>no</svg>", ["mid"]),
        ("<noscript><p>mid</p><noscript>no</noscript>", ["mid"]), ("<svg><svg/><svg>no</svg>no</svg>", []), ("<svg a=b/>no</svg>", []),
        ("<math><mi>x</mi><mo>=</mo><mn>2</mn></math>", ["x=2"]), ("<object data='x'>fallback</object>", ["fallback"]), ("<script>var a;</script>", []),
    ],
)
def test_html_hidden_elements(between, want):
    """Self-closed and unclosed hidden elements take nothing else of the page with them."""
    blocks = html_crf.leaf_blocks(f"<body><article><p>First.</p>{between}<p>Last.</p></article></body>")
    assert [b.text for b in blocks] == ["First.", *want, "Last."]


def test_language_id_learns_every_language(spark):
    rng = np.random.default_rng(8)
    stems = {f"l{k:02d}": ["".join(rng.choice(list("abcdefghijklmnop"), 4)) for _ in range(6)] for k in range(40)}
    say = lambda k, n: " ".join("".join(rng.choice(stems[k], rng.integers(1, 3))) for _ in range(n))
    rows = [(say(k, 40), k) for i, k in enumerate(stems) for _ in range(8 + i // 4)]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == sorted(stems) and len(model.groups) == 2
    got = langid.score(spark.createDataFrame([(say(k, 20), k) for k in stems for _ in range(2)], "text string, want string"), model).collect()
    assert all(r["lang_pred"] == r["want"] and not r["rejected"] for r in got)


def test_kneser_ney_counts_before_pruning(spark):
    rng = np.random.default_rng(9)
    rows = [(" ".join("".join(rng.choice(list("abcdefgh"), 4, p=np.arange(1, 9) / 36)) for _ in range(30)), x) for x in ("x", "y") for _ in range(20)]
    grams = langid.count_grams(spark.createDataFrame(rows, "text string, lang string"), "text", "lang", 3)
    counts = grams.toPandas()
    whole, pruned = langid.fit(counts, 3), langid.fit(counts, 3, 40)
    assert len(pruned.grams[2].hashes) < len(whole.grams[2].hashes)
    at = whole.grams[0].find(pruned.grams[0].hashes)  # single characters are all kept: the same continuation counts and discounts
    assert np.allclose(pruned.grams[0].rows, whole.grams[0].rows[at], atol=1e-5) and np.allclose(pruned.unknown, whole.unknown, atol=1e-5)
    pair = langid.learn(grams, 3, 40, 1)
    assert pair.languages == ["x", "y"] and [len(m.languages) for m in pair.groups] == [1, 1]
    texts = [r[0] for r in rows[:3]] + ["zz top", "\u65e5", ""]
    assert np.allclose(pair.cross_entropy(texts)[0], pruned.cross_entropy(texts)[0], atol=1e-4)
    for m in (whole, pruned):  # every distribution sums to one over the alphabet and one unknown character
        for context in ("ab", "hg", "zz", " a"):
            p = sum(np.exp(_log_p(m, context + c)) for c in [*"abcdefgh ", "?"])
            assert np.allclose(p, 1, atol=1e-3)


def _log_p(m, gram):
    line, log = np.array([ord(c) for c in gram], np.uint64), 0.0
    for n in range(len(gram), 0, -1):
        at = m.grams[n - 1].find(langid.gram_hashes(line, np.array([len(gram) - 1]), n))[0]
        if at >= 0:
            return log + m.grams[n - 1].rows[at].astype(float)
        if n > 1 and (at := m.backoff[n - 2].find(langid.gram_hashes(line, np.array([len(gram) - 2]), n - 1))[0]) >= 0:
            log = log + m.backoff[n - 2].rows[at].astype(float)
    return log + m.unknown.astype(float)


def test_ordinal_gradient():
    """Against differences of the likelihood, which is that of the three grades' probabilities."""
    rng = np.random.default_rng(9)
    n, size = 40, 6
    x = rng.random((n, size)) * (rng.random((n, size)) < 0.5)
    rows, cols = np.nonzero(x)
    values, grades = x[rows, cols], rng.integers(0, 3, n)
    w, raw = rng.normal(size=size), np.array([0.3, -0.2])
    of = lambda w, raw: toxicity.ordinal_gradient(w, raw, rows, cols, values, grades)
    value, g_w, g_raw = of(w, raw)
    theta = [raw[0], raw[0] + np.exp(raw[1])]
    below = 1 / (1 + np.exp(x @ w - np.array(theta)[:, None]))
    each = np.stack([below[0], below[1] - below[0], 1 - below[1]])
    assert abs(value - np.log(each[grades, np.arange(n)]).mean()) < 1e-9
    for v, g in ((w, g_w), (raw, g_raw)):
        for i in range(len(v)):
            d = np.zeros(len(v))
            d[i] = 1e-6
            ends = [of(w + s * d, raw)[0] if v is w else of(w, raw + s * d)[0] for s in (1, -1)]
            assert abs((ends[0] - ends[1]) / 2e-6 - g[i]) < 1e-6


def test_grades_follow_the_labels(spark):
    """Severe texts are those of bad quality: they get the higher expected grade."""
    rng = np.random.default_rng(10)
    say = lambda kind: " ".join([*rng.choice(["good", "plain", "words", "here", "and", "there"], 12), *([] if kind == 0 else ["nasty"] if kind == 1 else ["vicious"])])
    rows = [(i, say(i % 3), int(i % 3 > 0), int(i % 3 != 2)) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int, quality int")
    model = toxicity.train(df, quality="quality")
    got = [r[0] for r in toxicity.severity(spark.createDataFrame([("good words",), ("good nasty",), ("good vicious",)], "text string"), model).select("severity").collect()]
    assert got[0] < 0.2 < got[1] < got[2] and got[1] < 1.5 < got[2]


def test_toxicity_of_many_rare_words(spark):
    """A lexicon whose words are each in fewer than 1.5 % of the toxic texts."""
    rng = np.random.default_rng(6)
    clean = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(150)]
    bad = ["".join(rng.choice(list("qrstuvwxyz"), 7)) for _ in range(80)]
    say = lambda i: " ".join([*rng.choice(clean, 20), *([bad[i // 3 % 80]] if i % 3 == 0 else [])])
    df = spark.createDataFrame([(i, say(i), int(i % 3 == 0)) for i in range(2400)], "doc_id long, text string, toxic int")
    got = toxicity.severity(spark.createDataFrame([(i, say(i)) for i in range(480)], "i long, text string"), toxicity.train(df)).collect()
    assert sum(r["toxic_pred"] == (r["i"] % 3 == 0) for r in got) >= 475


def test_lm_weights_dont_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_TOKENS", 300)
    monkeypatch.setattr(lm, "SUMMED", 2)
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, " ".join(rng.choice(["a", "b", "c", "dd"], 12))) for i in range(150)], "i long, text string")
    v = gru.Vocabulary([b"a", b"b", b"c"], [3, 2, 1])
    one, other = (lm.train(df.repartition(n, "text"), v, 1950, 150, seed_docs=20) for n in (2, 7))
    assert all(np.allclose(one[k], other[k], atol=1e-6) for k in gru.NAMES)


def test_lm_columns_of_any_name(spark):
    """Names that the operator uses itself, an empty table, repeated rows and null texts."""
    names = ["own", "row", "known", "base", "model", "tail", "at", "word", "real", "first", "found", "n"]
    rows = [(*range(12), "a b zz"), (*range(12), "a b zz"), (*range(12), None), (*range(12), "")]
    df = spark.createDataFrame(rows, ", ".join(f"{x} long" for x in names) + ", text string")
    counts = lm.corpus_counts(df)
    v = gru.Vocabulary([b"a"], [2])
    args = (counts, gru.initial(v), v, [(gru.END, 4), (b"a", 2)], 10, 4)
    got = lm.score(df, *args)
    assert got.columns == [*names, "n_tokens", "n_known", "base_score", "score"]
    got = got.orderBy("n_tokens").collect()
    assert [(r["n_tokens"], r["n_known"], r["tail"]) for r in got] == [(1, 1, 5), (1, 1, 5), (4, 4, 5), (4, 4, 5)]
    base = np.log10(np.array([2.5, 2.5, 2.5, 4.5]) / 12.5).sum()
    assert abs(got[-1]["base_score"] - base) < 1e-9
    assert lm.score(df.limit(0), *args).count() == 0


def test_lm_trains_on_every_text(spark, tmp_path, monkeypatch):
    """Each training text is among those that the tasks' copies learn from."""
    texts = [f"w{i} " * (1 + i % 3) for i in range(90)]
    log = tmp_path / "log"
    log.mkdir()
    whole = gru.train

    def noted(p, v, documents, *args, **kwargs):
        if kwargs.get("rate") == 0.003:
            import uuid

            (log / uuid.uuid4().hex).write_text("".join(f"{v.words[d[0]].decode()}\n" for d in documents))
        return whole(p, v, documents, *args, **kwargs)

    from pyspark import cloudpickle

    monkeypatch.setattr(lm, "gru", type("G", (), {**{k: getattr(gru, k) for k in ("NAMES", "initial", "END")}, "train": staticmethod(noted)}))
    monkeypatch.setattr(lm, "SEED_ROUNDS", 1)
    cloudpickle.register_pickle_by_value(lm)
    words = [f"w{i}".encode() for i in range(90)]
    try:
        lm.train(spark.createDataFrame([(x,) for x in texts], "text string").repartition(3), gru.Vocabulary(words, [1] * 90), 270, 90)
    finally:
        cloudpickle.unregister_pickle_by_value(lm)
    assert sorted("".join(f.read_text() for f in log.iterdir()).split()) == sorted(w.decode() for w in words)
