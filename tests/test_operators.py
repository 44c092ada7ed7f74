"""Behaviour on small tables: predicates, contrasts, merges, graphs, distances, labels and metadata."""

import hashlib
import itertools
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxtile.functions import seg_method, sidecar
from voxtile.functions.formula import parse, t_two_sided, variables
from voxtile.functions.predicate import filter_rows
from voxtile.operators import aggregates, graph, levels, regions, spatial, stats, thinning, tiles, volume
from voxtile.sources import tables
from voxtile.streaming.regions import object_stream, region_totals

UNIT = [[1.0, 0, 0, 0], [0, 1.0, 0, 0], [0, 0, 1.0, 0], [0, 0, 0, 1]]


@pytest.fixture(scope="module")
def cohort(spark):
    return spark.createDataFrame([(f"sub-0{i + 1}", t, a) for i, (t, a) in enumerate(zip("pbs pbs lecanemab lecanemab control n/a".split(), (12, 13, 11, 14, 12, 15)))], "participant_id string, treatment string, age int")


def test_predicates(cohort):
    assert filter_rows(cohort, None) is cohort and filter_rows(cohort, " ") is cohort
    assert filter_rows(cohort, "treatment in ['pbs', 'lecanemab']").count() == 4
    assert [r[0] for r in filter_rows(cohort, "age < 14").select("participant_id").collect()] == ["sub-01", "sub-02", "sub-03", "sub-05"]
    assert filter_rows(cohort, "not (age >= 13) and `treatment` != 'control'").count() == 2
    for bad in ("treatment @@@ 'pbs'", "nothing == 1", "age in 3", "`age > 3", "len(age) > 1"):
        with pytest.raises(ValueError, match="expression is invalid"):
            filter_rows(cohort, bad)
    with pytest.raises(ValueError, match="excluded all rows"):
        filter_rows(cohort, "age > 100")


def test_contrasts(cohort):
    assert len(stats.contrasts(cohort, "treatment")) == 6
    one = stats.contrasts(filter_rows(cohort, "treatment in ['pbs', 'lecanemab']"), "treatment")
    assert [c.label for c in one] == ["treatment+lecanemabvspbs"]
    with pytest.raises(ValueError, match="fewer than 2 levels"):
        stats.contrasts(cohort.where("treatment = 'pbs'"), "treatment")
    with pytest.raises(ValueError, match="missing columns"):
        stats.contrasts(cohort, "sex")
    assert len(stats.contrasts(cohort.withColumn("sex", F.when(F.col("age") > 12, "F").otherwise("M")), "treatment", ("sex",))) == 12


@pytest.mark.parametrize("df, t", [(1, 12.7062047362), (10, 2.2281388520), (120, 1.9799304051)])
def test_t_distribution(df, t):
    assert math.isclose(t_two_sided(t, df), 0.05, rel_tol=1e-8)
    assert t_two_sided(0, df) == 1


def test_formula():
    assert parse("y ~ C(a)*C(b) + age - 1") == ("y", False, [("C(a)",), ("C(b)",), ("age",), ("C(a)", "C(b)")])
    with pytest.raises(ValueError):
        parse("y ~ a & b")


def test_fit_equals_closed_form(spark):
    rng = np.random.default_rng(1)
    rows = [("r", lev, float(v)) for lev, n in (("a", 5), ("b", 7), ("c", 2), ("d", 1)) for v in rng.normal(size=n)]
    d = spark.createDataFrame(rows, "region string, g string, value double")
    fit = {r["contrast"]: r for r in stats.fitted_contrasts(d, ["region"], "metric ~ C(g)", stats.contrasts(d, "g")).collect()}
    closed = stats.two_level_tests(d, ["region"], "g", stats.contrast_table(d, "g")).collect()
    assert len(closed) == 6
    for r in closed:
        f = fit[f"g+{r['level_a']}vs{r['level_b']}"]
        if "d" in (r["level_a"], r["level_b"]):
            assert r["tstat"] is None and f["tstat"] is None and f["n_b"] == 1
        else:
            assert math.isclose(r["tstat"], f["tstat"], rel_tol=1e-9) and math.isclose(r["cohensd"], f["cohensd"], rel_tol=1e-9)


def test_merge_with_null_keys_and_shared_columns(spark):
    a = spark.createDataFrame([(1, "x", 2.0, 5), (2, None, 3.0, 5)], "index int, name string, nvoxels double, extra int")
    b = spark.createDataFrame([(2, None, 7, 1), (3, "z", 8, 1)], "index int, name string, count int, extra int")
    m = regions.merge_outer([a, b])
    assert m.columns == ["index", "name", "nvoxels", "count"] and m.count() == 3
    c = regions.collapse(regions.fill_zero(m.withColumn("volume", F.lit(None).cast("double"))))
    assert {(r["index"], r["nvoxels"], r["count"], r["density"]) for r in c.collect()} == {(1, 2.0, 0.0, None), (3, 0.0, 8.0, None)}


def test_edges_nodes(spark, tmp_path):
    edges = spark.createDataFrame([(0, 1, 2, 3, 2, 2, 3, 1.0, 2.0, 3.0, 2.0, 2.0, 3.0, 0.5, 0.6, 1.0), (0, 2, 2, 3, 3, 2, 3, 2.0, 2.0, 3.0, 3.0, 2.0, 3.0, 0.6, 0.7, 1.0)], graph.EDGE_COLUMNS)
    nodes = graph.nodes_of(edges)
    named = graph.edges_with_nodes(edges, nodes)
    assert sorted(r["node_id"] for r in nodes.collect()) == [0, 1, 2]
    assert [(r["edge_id"], r["src_node_id"], r["dst_node_id"]) for r in named.orderBy("edge_id").collect()] == [(0, 0, 1), (1, 1, 2)]
    assert math.isclose(nodes.where("vox_x = 2").first()["radius"], 0.6)
    named.write.parquet(f"{tmp_path}/e")
    assert spark.read.parquet(f"{tmp_path}/e").count() == 2
    none = edges.limit(0)
    assert graph.nodes_of(none).count() == 0 and "edge_id" in graph.edges_with_nodes(none, graph.nodes_of(none)).columns
    with pytest.raises(ValueError, match="missing expected columns"):
        graph.nodes_of(edges.drop("src_x"))
    with pytest.raises(ValueError, match="not a node"):
        graph.edges_with_nodes(edges, nodes.where("vox_x < 3"))


def voxels(spark, where):
    return spark.createDataFrame([tuple(int(v) for v in x) for x in where], "vx long, vy long, vz long")


def test_skeleton_against_brute_force(spark):
    rng = np.random.default_rng(0)
    points = sorted({tuple(x) for x in rng.integers(0, 6, (60, 3))})
    s = voxels(spark, points).select(F.lit(0).alias("channel"), *[F.col(f"v{a}").alias(f"vox_{a}") for a in "xyz"], F.lit(-1.5).alias("radius"))
    got = {(tuple(r[1:4]), tuple(r[4:7])) for r in graph.skeleton_edges(s, [[2.0, 0, 0, 10], [0, 3.0, 0, 20], [0, 0, 4.0, 30], [0, 0, 0, 1]]).collect()}
    assert got == {(p, q) for p, q in itertools.combinations(points, 2) if max(abs(a - b) for a, b in zip(p, q)) <= 1}
    row = graph.skeleton_edges(s, [[2.0, 0, 0, 10], [0, 3.0, 0, 20], [0, 0, 4.0, 30], [0, 0, 0, 1]]).agg(F.min("src_x"), F.min("src_radius"), F.min("edge_length")).first()
    assert row[0] >= 10 and row[1] == 1.5 and row[2] >= 2
    alone = voxels(spark, [(2, 2, 2), (8, 8, 8), (14, 14, 14)]).select(F.lit(0).alias("channel"), *[F.col(f"v{a}").alias(f"vox_{a}") for a in "xyz"], F.lit(1.0).alias("radius"))
    assert graph.skeleton_edges(alone, UNIT).count() == 0


@pytest.mark.parametrize("tile", [2, (5, 3, 40), 32])
def test_skeleton_graph_whatever_the_tiles(spark, tile):
    """Nodes and edges from tiles equal those by way of the edge table; two channels, repeated voxels, no radius, no channel, no place."""
    rng = np.random.default_rng(7)
    points = sorted({(int(c), *map(int, x)) for c, x in zip(rng.integers(0, 2, 150), rng.integers(-5, 4, (150, 3)))})
    rows = [(f"c{c}", x, y, z, None if i % 7 == 0 else -float(i)) for i, (c, x, y, z) in enumerate(points)]
    s = spark.createDataFrame([*rows, rows[3], (None, 0, 0, 0, 1.0), ("c0", None, 0, 0, 1.0)], "channel string, vox_x int, vox_y int, vox_z long, radius double")
    matrix = [[2.0, 0, 0, 10], [0, 3.0, 0, 20], [0, 0, 4.0, 30], [0, 0, 0, 1]]
    edges = graph.checkpointed(graph.skeleton_edges(s, matrix, tile))
    radius = {r[:4]: None if r[4] is None else -r[4] for r in rows}
    want = {(p, q) for p, q in itertools.combinations(sorted(radius), 2) if p[0] == q[0] and max(abs(a - b) for a, b in zip(p[1:], q[1:])) <= 1}
    got = [((r[0], *r[1:4]), (r[0], *r[4:7])) for r in edges.collect()]
    assert len(got) == len(want) and set(got) == want
    assert all((r["src_radius"], r["dst_radius"]) == (radius[(r[0], *r[1:4])], radius[(r[0], *r[4:7])]) for r in edges.collect())
    assert edges.schema["src_vox_x"].dataType == s.schema["vox_x"].dataType
    nodes, plain = graph.skeleton_nodes(s, matrix, tile), graph.nodes_of(edges)
    assert sorted(map(repr, nodes.collect())) == sorted(map(repr, plain.collect()))
    assert sorted(graph.skeleton_graph_edges(nodes, matrix, tile).collect()) == sorted(graph.edges_with_nodes(edges, plain).collect())


def test_dense_ids_without_a_second_shuffle(spark):
    """Ranges are numbered as they are written: what is left is a scan and a small table."""
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    out = graph.dense_ids(df, ["x"], "n")
    assert sorted(out.collect()) == [(x, x) for x in range(1000)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1 and "row_number" not in plan  # the running sum of the ranges' sizes


def test_components_and_distances_against_brute_force(spark):
    rng = np.random.default_rng(3)
    points = sorted({tuple(x) for x in rng.integers(0, 7, (70, 3))})
    comp = graph.voxel_components(voxels(spark, points), 6).collect()
    parent = {p: p for p in points}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for p, q in itertools.combinations(points, 2):
        if sum(abs(a - b) for a, b in zip(p, q)) == 1:
            parent[max(root(p), root(q))] = min(root(p), root(q))
    groups = {}
    for r in comp:
        groups.setdefault(r["label"], set()).add(root(tuple(r[:3])))
    assert len(comp) == len(points) and all(len(g) == 1 for g in groups.values()) and len(groups) == len({root(p) for p in points})
    sdt = {tuple(r[:3]): r[3] for r in volume.signed_distance(voxels(spark, points), (7, 7, 7), (1.0, 2.0, 0.5)).collect()}
    box = list(itertools.product(range(7), repeat=3))
    far = [p for p in box if p not in set(points)]
    d = lambda p, q: math.sqrt((p[0] - q[0]) ** 2 + 4 * (p[1] - q[1]) ** 2 + 0.25 * (p[2] - q[2]) ** 2)
    assert all(math.isclose(sdt[p], min(d(p, q) for q in points) - min(d(p, q) for q in far), abs_tol=1e-9) for p in box)
    assert {r["sdt"] for r in volume.signed_distance(voxels(spark, points).limit(0), (2, 2, 1)).collect()} == {3.0}


def test_envelopes_against_all_pairs():
    rng = np.random.default_rng(9)
    for high in (0.0, 5.0, 400.0):
        p = np.sort(np.stack([rng.choice(60, 25, replace=False) for _ in range(40)]), axis=1) * 1.5
        h, n = rng.random((40, 25)).round(2) * high, rng.integers(0, 26, 40)
        x = np.tile(np.arange(-5.0, 95.0), (40, 1))
        got = volume.along(x, p, h, n)
        for i in range(40):
            want = (h[i, None, : n[i]] + (x[i, :, None] - p[i, None, : n[i]]) ** 2).min(axis=1) if n[i] else np.full(100, np.inf)
            assert np.allclose(got[i], want)


@pytest.mark.parametrize("segment, cells", [(4, 10), (5, 1_000), (7, 40)])
def test_distances_of_cut_lines(spark, monkeypatch, segment, cells):
    """Lines in several segments, with heights from the earlier passes, give the distances of whole lines."""
    monkeypatch.setattr(volume, "SEGMENT", segment)
    monkeypatch.setattr(volume, "CELLS", cells)
    rng = np.random.default_rng(segment)
    shape, spacing = (9, 6, 23), (1.0, 2.5, 0.75)
    points = [tuple(int(v) for v in p) for p in np.argwhere(rng.random(shape) < 0.01)]
    got = {tuple(r)[:3]: r["d"] for r in volume.distance_to(voxels(spark, [*points, points[0]]), shape, spacing).collect()}
    assert len(got) == np.prod(shape)
    for q, d in got.items():
        assert math.isclose(d, min(math.dist(*(tuple(a * s for a, s in zip(x, spacing)) for x in (p, q))) for p in points), abs_tol=1e-9)
    assert volume.distance_to(voxels(spark, points).limit(0), shape, spacing).count() == 0


def test_class_cuts_against_all_cuts():
    rng = np.random.default_rng(21)
    for _ in range(200):
        n = int(rng.integers(3, 13))
        k = int(rng.integers(2, min(n, 5) + 1))
        centers, counts = np.sort(rng.normal(size=n) * 10), rng.integers(0, 6, n).astype(float)
        if (counts > 0).sum() < k:
            continue

        def between(cuts):
            edges = [0, *cuts, n]
            return sum((counts[a:b] * centers[a:b]).sum() ** 2 / m for a, b in zip(edges, edges[1:]) if (m := counts[a:b].sum()) > 0)

        best = max(between(c) for c in itertools.combinations(range(1, n), k - 1))
        got = seg_method.otsu_thresholds(centers, counts, k)
        assert len(got) == k - 1 and math.isclose(between([int(np.searchsorted(centers, g)) + 1 for g in got]), best, rel_tol=1e-9)
    assert seg_method.otsu_thresholds(np.arange(4.0), np.array([0, 2.0, 0, 1]), 3) == [1.0, 1.0]


def test_class_cuts_of_many_bins():
    """As many bins as 16-bit images have, five classes: memory follows the bins."""
    import tracemalloc

    counts = 1000 * np.abs(np.sin(np.arange(65_536) / 9_000))
    tracemalloc.start()
    got = seg_method.otsu_thresholds(np.arange(65_536) + 0.5, counts, 5)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 50e6 and np.all(np.diff(got) > 5_000)


def test_levels(spark):
    fine = spark.createDataFrame([(x, y, 0, float(3 * x + 2 * y)) for x in range(-8, 8) for y in range(8)], "vx long, vy long, vz long, value double")
    coarse = levels.raised(fine, (4, 2, 1))
    assert {(r["vx"], r["vy"]): r["value"] for r in coarse.collect()}[-2, 1] == 3 * -6.5 + 2 * 2.5
    inner = levels.lowered(coarse, fine, (4, 2, 1), how="linear").where("vx between -6 and 5 and vy between 1 and 6").collect()
    assert len(inner) == 72 and all(math.isclose(r["coarse"], r["value"]) for r in inner)  # linear images stay as they are between block centres
    edge = {(r["vx"], r["vy"]): r["coarse"] for r in levels.lowered(coarse, fine, (4, 2, 1), how="linear").collect()}
    assert edge[-8, 0] == edge[-7, 0] == 3 * -6.5 + 2 * 0.5
    far = fine.limit(1).withColumn("vx", F.lit(99).cast("long"))
    assert [r["coarse"] for how in ("nearest", "linear") for r in levels.lowered(coarse, far, (4, 2, 1), how=how).collect()] == [None, None]
    votes = spark.createDataFrame([(0, 0, 0, "b"), (1, 0, 0, "a"), (2, 0, 0, None), (4, 0, 0, "c"), (5, 0, 0, "c"), (6, 0, 0, "a"), (9, 0, 0, None)], "vx long, vy long, vz long, value string")
    assert {(r["vx"], r["value"]) for r in levels.raised(votes, 4, how="vote").collect()} == {(0, "a"), (1, "c")}
    assert levels.isotropic_factors((1.8, 1.8, 4.0)) == (2, 2, 1) and levels.isotropic_factors((1.0, 1.0, 8.0)) == (8, 8, 1) and levels.isotropic_factors((3.0, 4.0, 4.0)) == (1, 1, 1)
    with pytest.raises(ValueError):
        levels.raised(fine, 0)


def test_region_statistics_in_any_way(spark):
    """Counted with the objects or from a table: the same; text by the first row of an order."""
    o = spark.createDataFrame([(1, "a", 2.0, None, "q", 3, 1.0), (1, "a", 4.0, 6.0, "p", 4, 2.0), (1, "a", 1.0, 3.0, None, 1, 9.0), (2, "b", None, 5.0, "z", 2, 1.0), (None, "c", 1.0, 1.0, "y", 5, 1.0)], "index int, name string, nvoxels double, price double, kind string, row int, pos_x double")
    f = spark.createDataFrame([(1, "a", 0.5, 2.0), (3, "d", 0.25, None)], "index int, name string, frac double, volume double")
    own = o.drop("row", "kind")
    one, two = (sorted(regions.region_statistics(own, c, f).select("index", "nvoxels", "price", "count", "frac", "volume", "density").collect(), key=str) for c in (None, regions.count_per_region(own)))
    assert [tuple(r) for r in one] == [(1, 7.0, 3.0, 3.0, 0.5, 2.0, 1.5), (2, 0.0, 5.0, 1.0, 0.0, None, None), (3, 0.0, 0.0, 0.0, 0.25, None, None)] == [tuple(r) for r in two]
    assert {r["index"]: r["kind"] for r in regions.collapse(o, order="row").collect()} == {1: "q", 2: "z"}
    assert {r["index"]: r["kind"] for r in regions.collapse(o).collect()} == {1: "p", 2: "z"}


def test_smoothing_by_tiles_and_by_joins(spark, monkeypatch):
    rng = np.random.default_rng(23)
    rows = [(*(int(v) - 5 for v in p), float(rng.normal())) for p in np.argwhere(rng.random((50, 12, 9)) < 0.3)]
    df = spark.createDataFrame(rows, "vx long, vy long, vz long, value double")
    by = lambda axes: {tuple(r)[:-1]: r["value"] for r in volume.gaussian_smoothed(df if len(axes) == 3 else df.where("vz = 0"), 1.3, axes=axes).collect()}
    tiled = [by(axes) for axes in (("vx", "vy", "vz"), ("vx", "vy"))]
    monkeypatch.setattr(volume, "BLOCK_BYTES", 10)
    for one, axes in zip(tiled, (("vx", "vy", "vz"), ("vx", "vy"))):
        two = by(axes)
        assert one.keys() == two.keys() and all(math.isclose(one[k], two[k], abs_tol=1e-12) for k in one)


def test_boxes_that_are_too_large(spark):
    v = spark.createDataFrame([(x, 0, 0, x // 70, float(x)) for x in range(300)], "vx long, vy long, vz long, index long, value double")
    boxes = volume.region_boxes(v.where("index < 4 or vx < 290"), margin=0, most=60)
    assert {r["index"]: (r["fits"], r["cx"]) for r in boxes.collect()} == {1: (False, 105), 2: (False, 175), 3: (False, 245), 4: (True, 285)}
    got = volume.box_crops(v.drop("index"), boxes).collect()
    assert sorted((r["index"], r["vx"], r["value"]) for r in got) == [(4, i, 280.0 + i) for i in range(10)]
    with pytest.raises(ValueError, match="too large"):
        volume.box_crops(v, boxes, strict=True)


def test_cohort_guards(spark, tmp_path):
    path = f"{tmp_path}/participants.tsv"
    with pytest.raises(FileNotFoundError):
        tables.read_cohort(spark, path)
    for text, error in (("name\tage\na\t1\n", "participant_id"), ("participant_id\tage\na\t1\n", "group"), ("participant_id\tgroup\na\tx\na\ty\n", "more than once: a")):
        with open(path, "w") as f:
            f.write(text)
        with pytest.raises(ValueError, match=error):
            tables.read_cohort(spark, path, ["group"])
    with open(path, "w") as f:
        f.write("participant_id\tgroup\nsub-a\tx\nb\ty\n")
    cohort = tables.read_cohort(spark, path, ["group"])
    other = spark.createDataFrame([("a",), ("sub-a",), (None,)], "participant_id string")
    assert [r["group"] for r in regions.of_subjects(cohort, other).collect()] == ["x"] and regions.of_subjects(other, cohort).count() == 2


def topology(points):
    """Objects, and the Euler number of the solid of voxels."""
    points, left, objects = set(points), set(points), 0
    while left:
        todo, objects = [left.pop()], objects + 1
        while todo:
            p = todo.pop()
            near = [q for d in itertools.product((-1, 0, 1), repeat=3) if (q := tuple(a + b for a, b in zip(p, d))) in left]
            left -= set(near)
            todo += near
    cells = {tuple(2 * a + b for a, b in zip(p, k)) for p in points for k in itertools.product((0, 1, 2), repeat=3)}
    return objects, sum((-1) ** sum(c % 2 for c in cell) for cell in cells)


def test_thinning_keeps_the_topology(spark):
    rng = np.random.default_rng(6)
    for share in (0.2, 0.5):
        mask = rng.random((9, 9, 9)) < share
        skeleton = thinning.thin(mask)
        assert not (skeleton & ~mask).any() and topology(map(tuple, np.argwhere(mask))) == topology(map(tuple, np.argwhere(skeleton)))
    solid = np.kron(rng.random((4, 4, 4)) < 0.5, np.ones((3, 3, 3))) > 0
    points = [tuple(p) for p in np.argwhere(solid)]
    got = [tuple(r) for r in thinning.thinned(voxels(spark, [*points, points[0]])).collect()]
    assert sorted(got) == [tuple(p) for p in np.argwhere(thinning.thin(solid))]
    assert thinning.thinned(voxels(spark, points).limit(0)).count() == 0


@pytest.mark.parametrize("points", [list(itertools.product(range(20), repeat=3)), list(itertools.product(range(-9, 31), range(12), range(3, 15)))], ids=["cube", "bar"])
def test_thinning_whatever_the_tiles(spark, points):
    """Objects much thicker than a tile: the same skeleton as of the whole array, in one piece."""
    low = np.min(points, axis=0)
    mask = np.zeros(np.max(points, axis=0) - low + 1, bool)
    mask[tuple((np.array(points) - low).T)] = True
    low = low - low % 2  # the turns go by the parity of places
    whole = np.pad(mask, [(int(a - b), 0) for a, b in zip(np.min(points, axis=0), low)])
    want = sorted(tuple(p) for p in np.argwhere(thinning.thin(whole)) + low)
    assert topology(want) == (1, 1) and len(want) < 40
    for tile, sides in ((8, 3), (13, 6), (64, 2)):
        assert sorted(tuple(r) for r in thinning.thinned(voxels(spark, points), tile=tile, sides=sides).collect()) == want


@pytest.mark.parametrize("cells", [80, 80 * 900])
def test_thinning_of_a_long_volume(spark, monkeypatch, cells):
    """Only the long axis is cut, whatever the places are; nothing is sent beyond the others."""
    monkeypatch.setattr(thinning, "CELLS", cells)
    mask = np.kron(np.random.default_rng(8).random((4, 3, 70)) < 0.6, np.ones((3, 3, 3))) > 0
    low = np.array([-6, 2, -40])
    got = sorted(tuple(r) for r in thinning.thinned(voxels(spark, np.argwhere(mask) + low)).collect())
    assert got == [tuple(p) for p in np.argwhere(thinning.thin(mask)) + low]
    tile, halo, sides = thinning._fitted([12, 9, 100_000])
    assert tile[:2] == [12, 9] and halo[:2] == [0, 0] and halo[2] == thinning.REACH * sides
    assert thinning._fitted([500, 400, 300]) == ([64] * 3, [18] * 3, 2)


@pytest.mark.parametrize("connectivity", [6, 18, 26])
def test_components_whatever_the_tiles(spark, connectivity):
    """A winding line through many tiles, random voxels, and places below 0; labels are the ranks of each group's first voxel."""
    rng = np.random.default_rng(connectivity)
    snake = [(x, y if x % 4 else (0 if x % 8 else 14), 0) for x in range(24) for y in (range(15) if x % 2 == 0 else [14 if x % 4 == 1 else 0])]
    points = sorted({(a - 11, b - 5, c + 3) for a, b, c in [*snake, *(tuple(int(v) for v in p) for p in np.argwhere(rng.random((24, 15, 9)) < 0.12))]})
    rank, reach = {p: i for i, p in enumerate(points)}, {6: 1, 18: 2, 26: 3}[connectivity]
    want: dict = {}
    for p in points:
        if p in want:
            continue
        todo = [p]
        want[p] = rank[p]
        while todo:
            q = todo.pop()
            for d in itertools.product((-1, 0, 1), repeat=3):
                r = tuple(a + b for a, b in zip(q, d))
                if 0 < sum(map(abs, d)) <= reach and r in rank and r not in want:
                    want[r] = rank[p]
                    todo.append(r)
    for tile in (2, (5, 3, 40), 32):
        got = {tuple(r)[:3]: r["label"] for r in graph.voxel_components(voxels(spark, [*points, points[0]]), connectivity, tile).collect()}
        assert got == want


def test_tiles_against_the_whole_array(spark):
    rng = np.random.default_rng(12)
    shape = (23, 9, 14)
    there, image = rng.random(shape) < 0.4, rng.normal(size=shape)
    at = np.argwhere(there)
    rows = [(*(int(x) - 7 for x in p), float(image[tuple(p)])) for p in at]  # places below 0 as well
    df = spark.createDataFrame(rows, "vx long, vy long, vz long, value double")
    want = {}
    for p in at:
        box = tuple(slice(max(0, x - 2), x + 3) for x in p)
        want[tuple(p - 7)] = (image[box][there[box]].mean(), there[box].sum())
    for tile in (3, (5, 40, 2), 32):
        got = {(r["vx"], r["vy"], r["vz"]): (r["mean"], r["n"]) for r in tiles.box_mean(df, 2, tile=tile).collect()}
        assert got.keys() == want.keys() and all(got[k][1] == want[k][1] and math.isclose(got[k][0], want[k][0], abs_tol=1e-9) for k in want)
    assert tiles.box_mean(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        tiles.box_mean(df, 1, tile=2000)


def test_pruned_blobs_against_a_greedy_pass(spark):
    rng = np.random.default_rng(17)
    found = {(*(int(v) for v in rng.integers(0, 14, 3)), float(rng.choice([1.0, 1.6, 2.5]))): float(rng.integers(1, 9)) for _ in range(250)}
    kept = []
    for (x, y, z, s), _ in sorted(found.items(), key=lambda i: (-i[1], i[0])):
        if all(math.dist((x, y, z), k[:3]) >= 0.4 * math.sqrt(3) * (s + k[3]) for k in kept):
            kept.append((x, y, z, s))
    df = spark.createDataFrame([(*k, r) for k, r in found.items()] * 2, "vx long, vy long, vz long, sigma double, response double")
    got = volume.pruned_blobs(df, 0.4)
    assert got.columns == df.columns and sorted(tuple(r)[:4] for r in got.collect()) == sorted(kept)
    assert volume.pruned_blobs(df.limit(0)).count() == 0


@pytest.mark.parametrize("depth", [0, 2, 8])
def test_radius_join_in_a_crowded_cell(spark, depth):
    """A third of all points in one cell, some of them at one place; radii of two octaves."""
    rng = np.random.default_rng(14)
    far, near = rng.uniform(-40, 40, (300, 3)), 3.0 + rng.uniform(0, 1.9, (150, 3)) ** 2 / 2
    same = np.tile([[4.0, 4.0, 4.0]], (40, 1))
    points = np.concatenate([far, near, same])
    radius = np.where(np.arange(len(points)) % 3, 0.4, 1.5)
    rows = [(i, float(r), *map(float, p)) for i, (p, r) in enumerate(zip(points, radius))]
    df = spark.createDataFrame(rows, "id int, radius double, pos_x double, pos_y double, pos_z double")
    pairs = spatial.radius_pairs(df, df, "radius", most=12, depth=depth)
    got = sorted((r["a"], r["b"]) for r in pairs.select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).collect())
    apart = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    assert got == sorted((int(i), int(j)) for i, j in np.argwhere(apart <= radius[:, None]))


@pytest.mark.parametrize("cell", [None, 0.5, 8.0])
def test_radius_join_of_dense_balls(spark, cell):
    """Balls that hold more points than a cell may have: no cell is cut below the radius, so rows go to a bounded number of cells."""
    rng = np.random.default_rng(15)
    points = np.repeat(rng.uniform(0, 1.5, (60, 3)), 5, axis=0)
    df = spark.createDataFrame([(i, 0.4, *map(float, p)) for i, p in enumerate(points)], "id int, radius double, pos_x double, pos_y double, pos_z double")
    pairs = spatial.radius_pairs(df, df, "radius", cell=cell, most=6)
    got = sorted((r["a"], r["b"]) for r in pairs.select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).collect())
    apart = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    assert got == sorted((int(i), int(j)) for i, j in np.argwhere(apart <= 0.4))

    def by_cell(left, right):
        size = cell or 0.5
        at = lambda: [F.floor(F.col(p) / size).alias(f"_c{i}") for i, p in enumerate(("pos_x", "pos_y", "pos_z"))]
        fixed = lambda df: df.select(F.struct(*df.columns).alias("x"), F.lit(0).cast("long").alias("_row"), F.lit(0).alias("_o"), *at(), F.lit(0).alias("_l"), F.lit(size).alias("_size"))
        return fixed(left).withColumnRenamed("x", "a"), fixed(right).withColumnRenamed("x", "b")

    a, _, _ = spatial._split(df, df, by_cell, "radius", ("pos_x", "pos_y", "pos_z"), 6, 8)
    least = a.agg(F.min(F.col("_size") / F.pow(F.lit(2.0), "_l"))).first()[0]
    assert least >= 0.4


def test_radius_join_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, *map(float, rng.random(3)), float(rng.choice([0.0, 0.01, 0.1, 0.4]))) for i in range(80)] + [(80, None, 0.0, 0.0, 1.0), (81, float("nan"), 0.0, 0.0, 1.0), (82, 0.5, 0.5, 0.5, float("nan")), (83, 0.5, 0.5, 0.5, None)]
    d = spark.createDataFrame(rows, "id int, pos_x double, pos_y double, pos_z double, radius double")
    got = {(r["a"]["id"], r["b"]["id"]) for r in spatial.radius_pairs(d, d, "radius").collect()}
    want = {(a[0], b[0]) for a in rows[:80] for b in [*rows[:80], *rows[82:]] if math.dist(a[1:4], b[1:4]) <= a[4]}
    assert got == want


def test_seeded_sample_of_long_groups(spark):
    """The first rows of each group, NULL ones among them, by digest; batches of rows hand on a few each, and only those are sorted."""
    rows = [(i, None if i % 3 == 0 else f"g{i % 3}", i % 2, float(i)) for i in range(5000)] + [(9000, "alone", 1, 0.0), (None, "g1", 1, 0.0), (None, "g1", 1, 0.0)]
    df = spark.createDataFrame(rows, "id long, g string, h int, v double").repartition(2)
    got = spatial.seeded_sample(df, "id", 4, groups=("g", "h"))
    want: dict = {}
    for r in rows:
        want.setdefault(r[1:3], []).append((hashlib.md5(b"42" if r[0] is None else f"42:{r[0]}".encode()).hexdigest(), r[0] or 0, r))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(x[2]) for v in want.values() for x in sorted(v, key=lambda x: x[:2])[:4])
    few = spatial._first_of_batches(df.withColumn("p", F.md5(F.col("id").cast("string"))), 4, ("g", "h"), "p", "id")
    assert few.count() < 100


def test_histogram_and_grids(spark):
    d = spark.createDataFrame([(float(x),) for x in (0, 0.5, 9.99, 10, -1, 11)], "v double")
    assert [r["count"] for r in aggregates.histogram(d, "v", 0, 10, 5).orderBy("bin").collect()] == [2, 0, 0, 0, 2]
    assert [r["count"] for r in aggregates.histogram(d.limit(0), "v", 0, 10, 2).orderBy("bin").collect()] == [0, 0]
    grid = spark.createDataFrame([(x, y, z, float(x * y + z)) for x in range(3) for y in range(3) for z in range(3)], "vx long, vy long, vz long, value double")
    p = spark.createDataFrame([(1, 0.5, 1.5, 1.0), (2, 5.0, 0.0, 0.0)], "k int, pos_x double, pos_y double, pos_z double")
    assert {r["k"]: r["value"] for r in spatial.sample_linear(p, "k", grid, ["value"], UNIT).collect()} == {1: 0.5 * 1.5 + 1.0, 2: None}
    with pytest.raises(ValueError):
        aggregates.block_mean(grid, 0, "value")
    smooth = volume.gaussian_smoothed(grid.withColumn("value", F.lit(3.0)), 1.0)
    assert smooth.count() == 27 and all(math.isclose(r["value"], 3.0) for r in smooth.collect())


def test_crops(spark):
    v = spark.createDataFrame([(x, y, 0, float(10 * x + y)) for x in range(10) for y in range(10)], "vx long, vy long, vz long, value double")
    c = spark.createDataFrame([(1, 4, 5, 0), (2, 0, 0, 0)], "patch_id int, cx long, cy long, cz long")
    got = volume.crops(v, c, (4, 4, 1)).groupBy("patch_id").agg(F.count(F.lit(1)), F.min("value"), F.max("value")).orderBy("patch_id").collect()
    assert [tuple(r) for r in got] == [(1, 16, 23.0, 56.0), (2, 4, 0.0, 11.0)]


def test_segmentation_methods():
    assert seg_method.parse_method("gmm+n3k1p5") == seg_method.Method("gmm", 1.5, 3)
    assert seg_method.parse_method("otsu+k3i2").index == 2 and seg_method.parse_method("th900").value == 900
    with pytest.raises(ValueError):
        seg_method.parse_method("otsu3")
    centers = np.arange(12.0)
    counts = np.array([9, 8, 1, 0, 7, 9, 2, 0, 0, 8, 9, 3.0])

    def between(cuts):
        edges = [0, *cuts, len(centers)]
        return sum((counts[a:b] * centers[a:b]).sum() ** 2 / counts[a:b].sum() for a, b in zip(edges, edges[1:]) if counts[a:b].sum())

    best = max(itertools.combinations(range(1, 12), 2), key=between)
    got = seg_method.otsu_thresholds(centers, counts, 3)
    assert math.isclose(between([int(t) + 1 for t in got]), between(best))
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(20, 3, 5000), rng.normal(80, 5, 5000)])
    counts, edges = np.histogram(x, 200, (0, 120))
    assert abs(seg_method.gmm_tail((edges[1:] + edges[:-1]) / 2, counts, 2, 1.0) - 85) < 0.6


def test_label_tables(spark, tmp_path):
    (tmp_path / "lut.txt").write_text('# comment\n  0 0 0 0 0 0 0 "Clear Label"\n  5 255 128 1 1 1 1 "Left  part (a)"\n\n')
    assert [tuple(r) for r in tables.read_labels_itksnap(spark, f"{tmp_path}/lut.txt").orderBy("index").collect()] == [(0, "Clear Label", "000000"), (5, "Left  part (a)", "ff8001")]
    (tmp_path / "lut.json").write_text(json.dumps([[1, "00ff00", "AB", "Area b"]]))
    assert tables.read_labels_json(spark, f"{tmp_path}/lut.json").first().asDict() == {"index": 1, "name": "Area b", "abbreviation": "AB", "color": "00ff00"}
    (tmp_path / "lut.csv").write_text("AB,Area b,1\n")
    assert tables.read_labels_csv(spark, f"{tmp_path}/lut.csv").first()["name"] == "Area b"
    labels = spark.createDataFrame([(1, "same", "s", "#00ff7f"), (2, "other", "o", None)], "index int, name string, abbreviation string, color string")
    lines = {r["index"]: r["value"] for r in tables.itksnap_lines(labels).collect()}
    assert lines[1] == '1\t0\t255\t127\t0\t0\t0\t"same"'  # the first row is the background
    assert {r["name"] for r in regions.lateralized(labels).collect()} == {"left same", "right same", "left other", "right other"}
    split = spark.createDataFrame([("m", 1, 1), ("n", 2, 3), ("k", None, 4)], "s string, l int, r int")
    assert {tuple(r) for r in regions.split_hemispheres(split, "s", "l", "r").collect()} == {(1, "m"), (2, "left n"), (3, "right n"), (None, "left k"), (4, "right k")}


def test_tables_and_identity(spark, tmp_path):
    for sub, text in (("sub-01", "index\tname\tvalue\tcode\n1\ta\t2.5\t007\n2\tn/a\tNA\tx1\n"), ("sub-02", "index\tname\n3\tc\n"), ("other", "index\tname\n4\td\n")):
        (tmp_path / sub).mkdir()
        (tmp_path / sub / "t.tsv").write_text(text)
    df = tables.read_many(spark, [f"{tmp_path}/{s}/t.tsv" for s in ("sub-01", "sub-02", "other")])
    assert dict(df.dtypes) == {"index": "bigint", "name": "string", "value": "double", "code": "string", "participant_id": "string"}
    assert sorted((r["index"], r["name"], r["value"], r["participant_id"]) for r in df.collect() if r["index"] != 2) == [(1, "a", 2.5, "sub-01"), (3, "c", None, "sub-02")]
    with pytest.raises(ValueError):
        tables.read_many(spark, [])
    tables.write_tsv(df.where("index = 1"), f"{tmp_path}/out", ["participant_id", "value"], single=True)
    assert tables.header(spark, f"{tmp_path}/out") == ["participant_id", "value"]
    assert tables.read_sidecar(spark, f"{tmp_path}/none.json") == {}
    stain = spark.createDataFrame([('["a", "b"]',), ('"a"',), (None,)], "s string").select(tables.as_list("s").alias("x"))
    assert [r["x"] for r in stain.collect()] == [["a", "b"], ["a"], None]


def test_sidecar_rules(spark, tmp_path):
    known = {"count": {"LongName": "Count", "Description": "Objects.", "Units": "n"}, "index": {"Description": "Label"}, "tstat": {"LongName": "t", "Description": "t statistic"}}
    of = lambda name: sidecar.describe_column(name, known, ("tstat",))
    assert of("index") == {"Description": "Label"}
    assert of("abeta+count") == {"LongName": "Count (abeta)", "Description": "Objects. Stain/channel: abeta.", "Units": "n"}
    assert of("abeta+zzz") == {"LongName": "zzz (abeta)", "Description": "Metric 'zzz' for stain/channel 'abeta'."}
    assert of("count_mean_pbs") == {"LongName": "Count – Mean (group: pbs)", "Description": "Mean of: Objects. Group: pbs.", "Units": "n"}
    assert of("zzz_std") == {"LongName": "zzz – Std", "Description": "Std of 'zzz'."}
    assert of("count_tstat") == {"LongName": "Count – t", "Description": "t statistic for metric 'count'."}
    assert of("count_tstat_a_b") == {"LongName": "Count – t (group: a_b)", "Description": "t statistic for metric 'count', group 'a_b'."}
    assert of("n_subjects")["Description"].startswith("Total") and "'pbs'" in of("n_pbs")["Description"] and of("zzz") == {}
    tables.write_sidecar(spark, sidecar.describe_columns(["count", "zzz"], known), f"{tmp_path}/s.json")
    assert tables.read_sidecar(spark, f"{tmp_path}/s.json") == {"count": known["count"], "zzz": {}}


def test_label_file(spark, tmp_path):
    labels = spark.createDataFrame([(2, "b c", None), (0, "out", None), (7, "d", "0102ff")], "index int, name string, color string")
    tables.write_itksnap(labels, f"{tmp_path}/lut")
    back = [tuple(r) for r in tables.read_labels_itksnap(spark, f"{tmp_path}/lut").orderBy("index").collect()]
    assert back == [(0, "out", tables.PALETTE[0]), (2, "b c", tables.PALETTE[10]), (7, "d", "0102ff")]
    lines = [r["value"] for r in spark.read.text(f"{tmp_path}/lut").collect()]
    assert lines[1].startswith("# ITK") and lines[-3].split("\t")[4:7] == ["0"] * 3 and lines[-1].split("\t")[4:7] == ["1"] * 3


def test_files_by_entities(spark, tmp_path):
    names = ["d/sub-a1/micr/sub-a1_stain-Iba1_SPIM.ome.zarr", "d/sub-b2/sub-b2_SPIM.ome.zarr", "d/participants.tsv"]
    files = tables.entities(spark.createDataFrame([(x,) for x in names], "path string"))
    assert [(r["sub"], r["stain"], r["suffix"], r["extension"]) for r in files.orderBy(F.col("sub").asc_nulls_last()).collect()] == [("a1", "Iba1", "SPIM", ".ome.zarr"), ("b2", None, "SPIM", ".ome.zarr"), (None, None, "participants", ".tsv")]
    assert [r["sub"] for r in tables.discovered(files, {"suffix": "SPIM"}, exclude=["sub-a1"]).collect()] == ["b2"]
    assert tables.discovered(files, include=["a1", "b2"], exclude=["b2"]).count() == 1
    for label in ("one", "two", "one"):
        tables.write_run(files.limit(2), f"{tmp_path}/group", label)
    assert {tuple(r) for r in spark.read.parquet(f"{tmp_path}/group").groupBy("run_label").count().collect()} == {("one", 2), ("two", 2)}


def test_blocks_that_are_missing_or_empty(spark):
    none = graph.edges_of_blocks(spark, [None, None])
    assert none.columns == graph.EDGE_COLUMNS and none.count() == 0
    one = spark.createDataFrame([(0, 1, 2, 3, 2, 2, 3)], ["channel", *(f"{e}_{v}" for e in ("src", "dst") for v in graph.VOXEL)])
    assert graph.edges_of_blocks(spark, [one, None, one.withColumn("more", F.lit(1)), one.limit(0)]).count() == 1


def test_predicates_with_missing_values(spark):
    d = spark.createDataFrame([("a", 1), ("b", 5), (None, 2), ("c", None)], "g string, age int")
    keep = lambda text: sorted(str(r["g"]) for r in filter_rows(d, text, check_empty=False).collect())
    assert keep("age < 3 & g == 'a'") == ["a"] and keep("age < 3 | g == 'b'") == ["None", "a", "b"]
    assert keep("g != 'a'") == ["None", "b", "c"] and keep("g not in ['a', 'b']") == ["None", "c"]
    assert keep("g == ['a', 'b']") == ["a", "b"] and keep("g != ['a', 'b']") == ["None", "c"]
    assert keep("not (age < 3)") == ["b", "c"] and keep("~(age < 3) & age > 0") == ["b"]
    with pytest.raises(ValueError):
        filter_rows(d, "age < (3 & g")


def test_formulas_with_quoted_names(spark):
    assert parse("m ~ C(Q('my group'))*Q(\"a + b\") + x:C(g) - 1") == ("m", False, [("C(Q('my group'))",), ('Q("a + b")',), ("C(Q('my group'))", 'Q("a + b")'), ("x", "C(g)")])
    assert variables(parse("m ~ C(Q('my group')) + Q(\"a + b\") + C(g)")[2]) == {"my group": True, "a + b": False, "g": True}
    with pytest.raises(ValueError):
        parse("m ~ a ^ b")
    rng = np.random.default_rng(2)
    rows = [("r", f"g{i % 2}", float(rng.normal()), float(rng.normal())) for i in range(40)]
    plain = spark.createDataFrame(rows, "region string, g string, x double, value double")
    odd = plain.withColumnsRenamed({"g": "my group", "x": "a + b"})
    one = stats.fitted_contrasts(plain, ["region"], "metric ~ C(g) + x + C(g):x", [stats.Contrast("g", "g0", "g1")]).first()
    two = stats.fitted_contrasts(odd, ["region"], "metric ~ C(Q('my group')) + Q('a + b') + C(Q('my group')):Q('a + b')", [stats.Contrast("my group", "g0", "g1")]).first()
    assert one["tstat"] == pytest.approx(two["tstat"]) and one["r2"] == pytest.approx(two["r2"])


def test_level_without_rows_in_the_fit(spark):
    rows = [("r", g, float(v), None if g == "c" else float(v % 3)) for g in "abc" for v in range(6)]
    d = spark.createDataFrame(rows, "region string, g string, value double, x double")
    got = {r["contrast"]: r for r in stats.fitted_contrasts(d, ["region"], "metric ~ C(g) + x", stats.contrasts(d, "g")).collect()}
    assert got["g+avsc"]["tstat"] is None and got["g+avsc"]["n_b"] == 6 and got["g+avsb"]["tstat"] is not None


def test_percentiles_against_numpy(spark, monkeypatch):
    monkeypatch.setattr(aggregates, "PARTS", 4)
    monkeypatch.setattr(aggregates, "FEW", 3)
    monkeypatch.setattr(aggregates, "ROUNDS", 60)
    rng = np.random.default_rng(8)
    groups = {"a": rng.normal(0, 1e6, 500), "b": rng.integers(0, 4, 300).astype(float), "c": np.array([2.5]), None: np.concatenate([rng.random(40), [1e300, -1e300]])}
    rows = [(g, float(v)) for g, x in groups.items() for v in x] + [("a", None), ("a", float("nan")), ("e", None)]
    d = spark.createDataFrame(rows, "g string, v double")
    at = (0, 1, 33, 50, 99.5, 100)
    got = aggregates.order_statistics(d, "v", at, ("g",))
    assert set(got) == {(g,) for g in groups}
    for g, x in groups.items():
        assert np.allclose(got[g,], np.percentile(x, at), rtol=1e-12)
    assert aggregates.percentiles(d.limit(0), "v", (50,)).first()["p50"] is None


def test_percentiles_end_on_any_values(spark, monkeypatch):
    """Infinite values, one value, all equal ones, values at all scales and the smallest doubles; several columns in one go."""
    monkeypatch.setattr(aggregates, "FEW", 2)
    inf, tiny, rng = math.inf, 5e-324, np.random.default_rng(3)
    scales = np.concatenate([2.0 ** rng.integers(-1070, 1020, 400), -(2.0 ** rng.integers(-1070, 1020, 400)), np.zeros(3)])
    cases = {"one": [7.0], "equal": [3.0] * 50, "high": [*rng.normal(0, 1, 60).tolist(), inf], "low": [-inf, *rng.normal(0, 1, 60).tolist()], "ends": [-inf, inf], "only": [inf, inf],
             "scales": scales.tolist(), "tiny": [tiny * k for k in range(20)] * 3, "top": [1.7e308, -1.7e308, 1.0, 2.0, 5.0]}
    rows = [(g, float(v), float(-v)) for g, x in cases.items() for v in x]
    d = spark.createDataFrame(rows, "g string, v double, w double").repartition(3)
    at = (0.0, 10.0, 50.0, 98.9, 100.0)
    got = aggregates.order_statistics_of(d, {"v": at, "w": (50.0,)}, ("g",))
    for g, x in cases.items():
        x = sorted(x)
        for sign, want, have in ((1, at, got[g,][0]), (-1, (50.0,), got[g,][1])):
            values = sorted(sign * v for v in x)
            for p, h in zip(want, have):
                place = (len(x) - 1) * p / 100
                a, b = values[math.floor(place)], values[min(math.floor(place) + 1, len(x) - 1)]
                share = place - math.floor(place)
                if a == b or not share:
                    assert h == a
                elif math.isinf(a) or math.isinf(b):
                    assert h == (None if math.isinf(a) and math.isinf(b) else a if math.isinf(a) else b)
                else:
                    assert math.isclose(h, a + (b - a) * share, rel_tol=1e-12) or b - a == inf
    assert aggregates.percentiles(d.where("g = 'high'"), "v", (50, 100)).first()["p100"] == inf


def test_resized_and_blobs(spark):
    grid = spark.createDataFrame([(x, y, float(x * x + y)) for x in range(5) for y in range(3)], "vx long, vy long, value double")
    got = {(r["vx"], r["vy"]): r["value"] for r in spatial.resized(grid, (5, 3), (9, 2), axes=("vx", "vy")).collect()}
    line = np.interp(np.linspace(0, 4, 9), range(5), np.arange(5) ** 2)
    assert len(got) == 18 and all(math.isclose(got[i, j], line[i] + 2 * j) for i in range(9) for j in range(2))
    assert {r["value"] for r in spatial.resized(grid, (5, 3), (1, 3), axes=("vx", "vy")).collect()} == {0.0, 1.0, 2.0}
    spot = lambda x, y: 9 * math.exp(-((x - 4) ** 2 + (y - 5) ** 2) / 2)
    image = spark.createDataFrame([(x, y, spot(x, y)) for x in range(11) for y in range(11)], "vx long, vy long, value double")
    assert [(r["vx"], r["vy"]) for r in volume.blobs(image, (1.0, 1.6, 2.56), 0.5, axes=("vx", "vy")).collect()] == [(4, 5)]


def test_registry_without_extra_packages(tmp_path):
    """A package that only the optional parts need may be missing."""
    import os
    import subprocess
    import sys

    import __spark_entry__

    root = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    code = "import sys; sys.modules['zstandard'] = sys.modules['xxhash'] = None; import __spark_entry__ as e; assert len(e.queries()) > 60 and 'op8_order_minhash' not in e.queries() and len(e.oracle_sql()) > 60"
    subprocess.run([sys.executable, "-c", code], cwd=root, env=os.environ | {"PYTHONPATH": ""}, check=True)


def test_stream_of_objects(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", 2), (1, "a", 3), (2, None, 9), (3, "c", 4)], "index int, name string, nvoxels long")
    rows.write.parquet(f"{tmp_path}/in")
    q = region_totals(object_stream(spark, f"{tmp_path}/in", rows.schema)).writeStream.outputMode("complete").format("memory").queryName("totals").start()
    q.processAllAvailable()
    q.stop()
    assert {tuple(r) for r in spark.table("totals").collect()} == {(1, "a", 2, 5), (3, "c", 1, 4)}


def test_fit_from_sums_equals_a_fit_of_rows(spark, monkeypatch):
    """Covariates and interactions; only a row for each combination of levels reaches the fit of a region."""
    import pandas as pd

    from voxtile.functions.formula import Design, least_squares

    rng = np.random.default_rng(4)
    rows = [("r", f"g{rng.integers(3)}", f"s{rng.integers(2)}", float(rng.normal(50, 9)), float(rng.normal(7, 2)) if i % 11 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "region string, g string, s string, b double, value double")
    formula, wanted = "metric ~ C(g)*C(s) + b + C(g):b", [stats.Contrast("g", "g0", "g2", {"s": "s1"})]
    out = stats.fitted_contrasts(df, ["region"], formula, wanted)
    frame = df.toPandas()
    good = frame.dropna()
    _, intercept, terms = parse(formula)
    design = Design(good, intercept, terms)
    beta, spread, variance, dof = least_squares(design.matrix(good), good["value"].to_numpy())
    ends = pd.DataFrame([{"g": x, "s": "s1", "b": frame["b"].mean()} for x in ("g0", "g2")])
    step = np.subtract(*design.matrix(ends))
    got = out.first()
    assert got["tstat"] == pytest.approx(step @ beta / np.sqrt(variance * (step @ spread @ step)), rel=1e-8) and got["nobs"] == len(good)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("FlatMapGroupsInPandas") < plan.index("partial_")  # rows are summed before they are grouped
