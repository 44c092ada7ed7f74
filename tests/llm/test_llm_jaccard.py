"""T-occurrence search against brute force: DivideSkip, differences from a home, blocks of sets, whole groups."""

import itertools
import random

import numpy as np
import pytest

from voxtile.llm import jaccard_join as jj

UP, LOW = jj.SIMILAR


def linked(x, y) -> bool:
    common = len(np.intersect1d(x, y))
    return LOW * common >= UP * (len(x) + len(y) - common)


def near_copies(rng, size: int, number: int, most: float) -> list[np.ndarray]:
    base = rng.choice(1 << 40, size, replace=False)
    out = [base]
    for _ in range(number):
        gone = rng.random(size) < rng.random() * most
        out.append(np.concatenate([base[~gone], rng.choice(1 << 40, int(gone.sum()))]))
    return [np.unique(x).astype(np.uint64) for x in out]


def test_divide_skip():
    rng = np.random.default_rng(1)
    for _ in range(200):
        lists = [np.flatnonzero(rng.random(30) < rng.random()).tolist() for _ in range(rng.integers(1, 9))]
        needed = {int(x): int(rng.integers(1, 6)) for x in np.flatnonzero(rng.random(30) < 0.7)}
        if needed:
            want = sorted(x for x, most in needed.items() if sum(x in own for own in lists) >= most)
            assert sorted(jj.divide_skip(lists, needed)) == want


def test_differences_hold_every_link_within_a_home():
    """Two sets of a home, not both linked with it, are linked only if their listed differences meet often enough."""
    rng = np.random.default_rng(2)
    met = 0
    for _ in range(12):
        c, *rest = near_copies(rng, int(rng.integers(20, 120)), 30, 0.5)
        rest += near_copies(rng, 40, 5, 0.2)[1:] + [np.union1d(x, rng.choice(1 << 40, 3).astype(np.uint64)) for x in rest[:8]]
        told = [(x, linked(x, c), *jj.differences(x, c, linked(x, c), jj.SIMILAR)) for x in rest]
        for (x, lx, dx, px), (y, ly, dy, py) in itertools.combinations(told, 2):
            if not (lx and ly) and linked(x, y):
                needed = -(-((UP + LOW) * (dx + dy) - (LOW - UP) * (len(x) + len(y))) // (2 * (UP + LOW))) - max(dx - len(px), dy - len(py))
                assert len(np.intersect1d(px, py)) >= max(needed, 1)
                met += 1
    assert met > 20


def test_hopeful_entries():
    """An entry stays if another one of its list passes the bound on the lists of both."""
    rng = np.random.default_rng(5)
    size = rng.integers(1, 9, 60)
    n, met = rng.integers(1, 60, size.sum()), rng.integers(1, 9, size.sum())
    got, at = jj.hopeful(n, met, size, jj.SIMILAR), 0
    least = lambda x: -(-UP * x // LOW)
    for k in size:
        for i in range(at, at + k):
            want = False
            for j in range(at, at + k):
                needed = -(-UP * (n[i] + n[j]) // (UP + LOW)) - max(least(n[i]), least(n[j])) + 1
                want |= i != j and UP * max(n[i], n[j]) <= LOW * min(n[i], n[j]) and needed <= min(met[i], met[j])
            assert got[i] == want
        at += k
    assert 0 < got.sum() < len(got)


@pytest.mark.parametrize("home", [4, 10_000])
def test_groups_against_brute_force(spark, monkeypatch, home):
    """Groups of near copies that chain, with homes and without: the components of all links."""
    monkeypatch.setattr(jj, "HOME", home)
    monkeypatch.setattr(jj, "BLOCK", 8)
    monkeypatch.setattr(jj, "PART", 16)
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    common = " ".join(word() for _ in range(30))
    texts = []
    for _ in range(6):
        words = [word() for _ in range(int(rng.integers(30, 90)))]
        for _ in range(14):
            own = [word() if rng.random() < 0.06 * rng.random() else w for w in words]
            texts.append(" ".join(own))
    texts += [f"{common} {' '.join(word() for _ in range(int(rng.integers(1, 14))))}" for _ in range(40)]
    texts += ["", None, "one", "one", "a b c d", "A B c D"]
    sets = [jj.shingle_sets([(t or "").encode()], {})[0] for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if len(sets[i]) and len(sets[j]) and linked(sets[i], sets[j]):
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    want = [root(i) for i in range(len(texts))]
    assert 10 < len(set(want)) < len(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in jj.jaccard_groups(df).collect()}
    assert [got[i]["component_id"] for i in range(len(texts))] == want
    assert [got[i]["n_shingles"] for i in range(len(texts))] == [len(x) for x in sets]


def test_a_star_round_is_planned_once(spark):
    """The plan of a round stands on the driver: no subtree twice for a union, and few shuffles."""
    from voxtile.operators.graph import checkpointed, star_components, star_round

    rng = random.Random(8)
    pairs = {(max(a, b), min(a, b)) for a, b in ((rng.randrange(300), rng.randrange(300)) for _ in range(260)) if a != b}
    edges = checkpointed(spark.createDataFrame(sorted(pairs), "u long, v long"))
    plan = star_round(edges)._jdf.queryExecution().sparkPlan().toString()
    assert "Union" not in plan and plan.count("Join") <= 3
    least = {x: x for p in pairs for x in p}
    for _ in range(300):
        for u, v in pairs:
            least[u] = least[v] = min(least[u], least[v])
    assert {(r["u"], r["v"]) for r in star_components(edges).collect()} == {(x, m) for x, m in least.items() if x != m}


def test_sets_of_a_long_list_share_blocks(spark, monkeypatch):
    """A list goes to each block that has a set in it: about one for ``BLOCK`` sets, not one for each set, however many blocks there are."""
    monkeypatch.setattr(jj, "BLOCK", 50)
    rows = [(7, k, 400, None) for k in range(400)] + [(1000 + k // 2, k, 2, None) for k in range(400)] + [(5, 900, 2, 77)]
    near = jj.near_lists(spark.createDataFrame(rows, "key long, node long, size long, block long"))
    got = [tuple(r) for r in near.select("key", "node", "block").collect()]
    assert sorted(x[:2] for x in got) == sorted(x[:2] for x in rows)
    assert 1 < len({b for key, _, b in got if key == 7}) <= 8 and (5, 900, 77) in got
    assert len({(node, b) for _, node, b in got}) == 401  # all entries of a set have one block


def test_frequent_shingles_are_counted_across_blocks(spark, monkeypatch):
    """A passage that few texts of any block have is counted where a slice of many blocks has it."""
    monkeypatch.setattr(jj, "COUNTED", 4000)
    monkeypatch.setattr(jj, "blocks", lambda batch, column: (batch.slice(i, 1) for i in range(batch.num_rows)))
    docs = [(k, f"{' '.join(f'w{k}x{i}' for i in range(30))} {'a b c d e f' if k % 3 == 0 else ''}", k) for k in range(90)]
    found = jj._summaries(spark.createDataFrame(docs, "row_id long, text string, text_hash long").coalesce(1))
    counts = {r["node"]: r["n"] for r in found.where("is_count").collect()}
    assert len(counts) == 2 and set(counts.values()) == {30}
    assert found.where("not is_count").count() == 90


def test_shuffles_and_released_tables_leave_no_files(spark):
    """What a checkpoint or a stored table was made from goes at once; a stored table goes when it is released."""
    import glob
    import time

    from pyspark.sql import functions as F

    from voxtile.operators.graph import checkpointed, released, shared_folder, stored

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, files = spark.conf.get(key), spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    had = {str(x) for x in files.getAllFiles().mkString(" ").split() if "shuffle" in x}
    one = checkpointed(spark.range(5000).groupBy((F.col("id") % 7).alias("k")).count())
    two = stored(spark.range(5000).groupBy((F.col("id") % 5).alias("k")).count(), "counted")
    for _ in range(50):
        if not (left := {str(x) for x in files.getAllFiles().mkString(" ").split() if "shuffle" in x} - had):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(key) == before
    assert one.count() == 7 and two.count() == 5
    folder = shared_folder(spark).removeprefix("file:")
    assert glob.glob(f"{folder}/counted-*/*.parquet")
    released(two)
    assert not glob.glob(f"{folder}/counted-*")
