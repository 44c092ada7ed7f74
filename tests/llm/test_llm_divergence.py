"""Source divergence: the trie against dictionaries, the audit against a plain version with whole numbers of any size."""

import re
from collections import Counter

import numpy as np
import pytest

from voxtile.llm import divergence
from voxtile.llm.divergence import RadixTrie, contrast, pack, shares, source_divergence, terms_of, unpack


def words(rng, n):
    return ["".join(rng.choice(list("abcé😀"), rng.integers(1, 7))).encode() for _ in range(n)]


def content(trie):
    return {term: dict(leaf) for _, term, leaf in trie.walk()}


def test_trie_walks_in_order_and_merges():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 50, 2000):
        tries, want = [], {}
        for _ in range(3):
            trie = RadixTrie()
            for term in words(rng, n):
                source = int(rng.integers(0, 4))
                leaf = trie.leaf(term)
                leaf[-1] += 1
                leaf[source] = leaf.get(source, 0) + 2
                whole = want.setdefault(term, Counter())
                whole[-1] += 1
                whole[source + 10] += 2
            tries.append(trie)
        merged = RadixTrie()
        for trie in tries:
            terms = [term for _, term, _ in trie.walk()]
            assert terms == sorted(set(terms)) and len(terms) == trie.leaves
            for (s, term, _), before in zip(list(trie.walk())[1:], terms):
                assert term[:s] == before[:s] and term[s : s + 1] != before[s : s + 1]
            entries = list(trie.walk())
            cut = len(entries) // 3
            for part in (entries[:cut], entries[cut:]):
                merged.absorb(pack(part), [10, 11, 12, 13])
        assert content(merged) == {t: {k: v for k, v in c.items()} for t, c in want.items()} and merged.leaves == len(want)
    assert [len(x) for x in unpack(pack([]))] == [0] * 7


def test_shares_are_exact():
    rng = np.random.default_rng(6)
    whole = [1, 2, 7, 10**9, 3 * 10**12, 9 * 10**15]
    for w in whole:
        count = np.array([0, 1, w // 3, w // 2, w - 1, w, *rng.integers(0, w + 1, 20)], np.int64)
        assert shares(count, w).tolist() == [1 + 10**9 * int(c) // w for c in count]
    assert contrast(np.array([10**9 + 1]), np.array([1])).tolist() == [(10**9) ** 2 // (10**9 + 2)]


def plain(rows, least=10, top=10):
    docs = [(lang or "", source or "", re.findall(divergence.TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        with_term = Counter(t for _, _, terms in own for t in set(terms))
        kept = [t for t, n in with_term.items() if n >= least]
        count = {s: Counter() for _, s, _ in own}
        for _, s, terms in own:
            count[s].update(t for t in terms if with_term[t] >= least)
        every = sum(count.values(), Counter())
        p = lambda c, t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in count:
            pairs = [(sum(f(p(count[s], t), p(count[o], t)) for t in kept), o) for o in count if o != s]
            terms = [(f(p(count[s], t), p(every, t)), t) for t in kept if count[s][t] and p(count[s], t) > p(every, t)]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(ranked, 1) if part == "pair" or i <= top]
    return sorted(out)


def rows_of(seed=1, n=300):
    rng = np.random.default_rng(seed)
    texts = lambda: " ".join(rng.choice(["The", "the", "cat's", "naïve", "x9y", "日本", "😀", "Zebra", "é-é", "q", *(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))], rng.integers(0, 30)))
    rows = [(str(rng.choice(["en", "fr"])), str(rng.choice(["a", "b", "ß", "zz", "B"], p=[0.6, 0.1, 0.1, 0.1, 0.1])), texts()) for _ in range(n)]
    rows += [(None, None, "the cat"), ("", "s", None), ("de", "lonely", "few terms"), ("de", None, ""), ("it", "one", "x"), (None, "s", "123 \t\n")]
    return rows + [("en", "a", "repeat repeat repeat")] * 12 + [("en", "rare", "the " * 3000 + "Σίσυφος")] * 2


@pytest.mark.parametrize("leaves, block, ranges, cells", [(100_000, 512, 8, 400_000), (40, 2, 64, 30), (1, 1, 1, 1)])
def test_against_a_plain_version(spark, monkeypatch, leaves, block, ranges, cells):
    for name, value in (("MOST_LEAVES", leaves), ("BLOCK", block), ("CELLS", cells), ("COUNT_BYTES", 2000), ("PARTS", 3)):
        monkeypatch.setattr(divergence, name, value)
    rows = rows_of()
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "lang string, source string, text string, item string, rank int").repartition(3)
    got = source_divergence(df, ranges=ranges)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain(rows)


def test_odd_tables(spark):
    schema = "lang string, source string, text string"
    assert source_divergence(spark.createDataFrame([], schema)).count() == 0
    assert source_divergence(spark.createDataFrame([("en", "a", "x")], schema)).count() == 0
    two = source_divergence(spark.createDataFrame([("en", "a", None), ("en", None, "x")], schema))
    assert sorted(map(tuple, two.collect())) == [("en", "", "pair", "a", 0, 1), ("en", "a", "pair", "", 0, 1)]
    named = spark.createDataFrame([("en", 1, "x y")] * 10 + [("en", 2, "y")], "`the.lang` string, source int, body string")
    assert sorted(map(tuple, source_divergence(named, "the.lang", "source", "body").collect())) == plain([("en", "1", "x y")] * 10 + [("en", "2", "y")])
    assert terms_of("ÀB\x7fc`d{E\x80".encode()) == [x.encode() for x in ("Àb", "c", "d", "e\x80")]
