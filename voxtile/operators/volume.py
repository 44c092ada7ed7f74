"""Volumes as voxel tables: masks, maps, cleaning, distance transforms and threshold selection."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.seg_method import Method, gmm_tail, otsu_thresholds
from .aggregates import histogram_between
from .graph import checkpointed, dense_ids
from .spatial import bounding_boxes, radius_pairs
from .tiles import AXES, BLOCK_BYTES, Block, tiled


def masked(voxels: DataFrame, mask: DataFrame, value: str = "value") -> DataFrame:
    """Product of an image and a mask of 0 and 1; voxels that the mask lacks become 0."""
    m = mask.select(*AXES, F.col("mask"))
    return voxels.join(m, list(AXES), "left").withColumn(value, F.col(value) * F.coalesce("mask", F.lit(0))).drop("mask")


def painted(labels: DataFrame, features: DataFrame, column: str, missing: float = 0.0) -> DataFrame:
    """Each voxel with the table value of its label."""
    table = features.select("index", F.col(column).cast("double").alias("value"))
    return labels.join(table, "index", "left").withColumn("value", F.coalesce("value", F.lit(missing)))


def half_zeroed(voxels: DataFrame, size: int, side: str = "right", value: str = "value") -> DataFrame:
    """One half of the first axis set to 0; ``side`` is the half that stays."""
    upper = F.col("vx") >= size // 2
    return voxels.withColumn(value, F.when(~upper if side == "right" else upper, 0).otherwise(F.col(value)))


def crops(voxels: DataFrame, centers: DataFrame, size: tuple[int, int, int]) -> DataFrame:
    """patch_id, local voxel and value within boxes of a fixed size around centres (patch_id, cx, cy, cz).

    Voxels meet the patches of their own and the neighbouring block, so the join has an equality.
    """
    block = max(size)
    axes = list(zip(AXES, ("cx", "cy", "cz"), size))
    around = F.array(*[F.struct(*[F.lit(v).alias(f"d{i}") for i, v in enumerate((x, y, z))]) for x in (-1, 0, 1) for y in (-1, 0, 1) for z in (-1, 0, 1)])
    c = centers.withColumn("_d", F.explode(around)).withColumns({f"_b{i}": F.floor(F.col(k) / block) + F.col(f"_d.d{i}") for i, (_, k, _) in enumerate(axes)}).drop("_d")
    v = voxels.withColumns({f"_b{i}": F.floor(F.col(a) / block) for i, (a, _, _) in enumerate(axes)})
    both = c.join(v, ["_b0", "_b1", "_b2"])
    for a, k, n in axes:
        both = both.where((F.col(a) >= F.col(k) - n // 2) & (F.col(a) < F.col(k) - n // 2 + n))
    return both.select("patch_id", *[(F.col(a) - F.col(k) + n // 2).alias(a) for a, k, n in axes], *[x for x in voxels.columns if x not in AXES])


#: Voxels along an axis that a crop by a box may have, and a block of the join of boxes and voxels.
MOST_EXTENT, BOX_BLOCK = 5_000, 64


def region_boxes(labels: DataFrame, label: str = "index", margin: int = 0, most: int = MOST_EXTENT) -> DataFrame:
    """Box (min_ and max_ of x, y, z, ``margin`` added) of each label's voxels but the background's, its centre (cx, cy, cz), and whether it ``fits``: no side has more than ``most`` voxels."""
    boxes = bounding_boxes(labels.where(F.col(label) > 0).withColumnRenamed(label, "label"))
    ends = {f"{n}_{a}": F.col(f"{n}_{a}") + (margin if n == "max" else -margin) for n in ("min", "max") for a in "xyz"}
    out = boxes.select(F.col("label").alias(label), *[c.alias(k) for k, c in ends.items()])
    fits = F.lit(True)
    for a in "xyz":
        fits = fits & (F.col(f"max_{a}") - F.col(f"min_{a}") + 1 <= most)
    return out.withColumns({f"c{a}": F.floor((F.col(f"min_{a}") + F.col(f"max_{a}") + 1) / 2) for a in "xyz"}).withColumn("fits", fits)


def box_crops(voxels: DataFrame, boxes: DataFrame, label: str = "index", strict: bool = False) -> DataFrame:
    """label, local voxel and values of the voxels within each box of ``region_boxes`` that fits; boxes may overlap.  ValueError if ``strict`` and a box is too large.

    Voxels and boxes meet by blocks, so the join has an equality, and a large box is shared by many tasks.
    """
    if strict and not (large := boxes.where("not fits").select(label).limit(5)).isEmpty():
        raise ValueError(f"boxes that are too large: {', '.join(str(r[0]) for r in large.collect())}")
    covered = boxes.where("fits")
    for a in "xyz":
        covered = covered.withColumn(f"_b{a}", F.explode(F.sequence(F.floor(F.col(f"min_{a}") / BOX_BLOCK), F.floor(F.col(f"max_{a}") / BOX_BLOCK))))
    keyed = voxels.withColumns({f"_b{a}": F.floor(F.col(f"v{a}") / BOX_BLOCK) for a in "xyz"})
    both = keyed.join(covered.select(F.col(label).alias("_label"), *[f"{n}_{a}" for n in ("min", "max") for a in "xyz"], *[f"_b{a}" for a in "xyz"]), [f"_b{a}" for a in "xyz"])
    for a in "xyz":
        both = both.where(F.col(f"v{a}").between(F.col(f"min_{a}"), F.col(f"max_{a}")))
    return both.select(F.col("_label").alias(label), *[(F.col(f"v{a}") - F.col(f"min_{a}")).alias(f"v{a}") for a in "xyz"], *[F.col(f"`{c}`") for c in voxels.columns if c not in (*AXES, label)])


def overview(voxels: DataFrame, shape: tuple[int, int, int], number: int = 5, low: float = 0.2, high: float = 0.8, value: str = "value") -> DataFrame:
    """axis, slice, u, v, value: ``number`` slices at even places of the middle part of each axis, and the maximum along it as slice -1; u and v are the other two axes in order."""
    parts = []
    for axis, n in zip(AXES, shape):
        u, v = (a for a in AXES if a != axis)
        places = np.linspace(int(n * low), max(int(n * high) - 1, 0), number, dtype=int).tolist()
        at = F.explode(F.filter(F.array(*[F.when(F.col(axis) == p, F.lit(i)) for i, p in enumerate(places)], F.lit(-1)), lambda x: x.isNotNull()))
        parts.append(voxels.select(F.lit(axis).alias("axis"), at.alias("_nth"), F.array(*[F.lit(p) for p in [*places, -1]]).alias("_p"), F.col(u).alias("u"), F.col(v).alias("v"), F.col(value).alias("value")))
    every = parts[0].union(parts[1]).union(parts[2]).withColumn("slice", F.when(F.col("_nth") < 0, F.lit(-1)).otherwise(F.element_at("_p", F.col("_nth") + 1)))
    return every.groupBy("axis", "slice", "u", "v").agg(F.max("value").alias("value"))


def cleaned(components: DataFrame, least_extent: float = 0.15) -> DataFrame:
    """Voxels of the components that fill at least such a share of their box."""
    good = bounding_boxes(components).where(F.col("extent") >= least_extent).select("label")
    return components.join(good, "label", "left_semi")


def choose_threshold(
    df: DataFrame, value: str, method: Method, between: tuple[float, float] = (0.0, 100.0), width: float = 1.0, source: DataFrame | None = None, rounds: int = 200, most_bins: int = 1 << 20
) -> float:
    """Threshold of a segmentation method, from a histogram between two percentiles that Spark makes; only its bins reach the driver.

    With more than ``most_bins`` bins of ``width`` the bins are wider, so that what the driver gets is bounded.  ``rounds`` are those of a mixture's fit at most.
    """
    if method.kind == "threshold":
        return method.value
    table = histogram_between(df, value, *between, width, source, most_bins).orderBy("bin").toPandas()
    centers, counts = ((table["lo"] + table["hi"]) / 2).to_numpy(), table["count"].to_numpy(float)
    if method.kind == "otsu":
        return otsu_thresholds(centers, counts, method.classes)[method.index]
    return gmm_tail(centers, counts, method.classes, method.value, rounds)


def gaussian_smoothed(voxels: DataFrame, sigma: float, value: str = "value", axes: tuple[str, ...] = AXES) -> DataFrame:
    """Separable Gaussian mean over the voxels that are there, cut at three deviations; a missing value counts as 0.

    Tiles with a halo of that reach, so rows are shuffled once; only where such a tile would have too many bytes, a join on shifted places for each axis.
    """
    reach = max(1, int(round(3 * sigma)))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    tile, halo = (tuple(x if a in axes else y for a in AXES) for x, y in ((max(32, 2 * reach), 1), (reach, 0)))
    if 8 * np.prod([n + 2.0 * h for n, h in zip(tile, halo)]) > BLOCK_BYTES:
        return _smoothed_by_joins(voxels, weights, value, axes)

    def spread(x: np.ndarray, axis: int) -> np.ndarray:
        out = np.zeros_like(x)
        n = x.shape[axis]
        for d, w in zip(range(-reach, reach + 1), weights):
            to = tuple(slice(max(0, -d), n - max(0, d)) if i == axis else slice(None) for i in range(3))
            of = tuple(slice(max(0, d), n - max(0, -d)) if i == axis else slice(None) for i in range(3))
            out[to] += w * x[of]
        return out

    def step(block: Block) -> dict[str, np.ndarray]:
        image, there = block.values["v"], block.there.astype(float)
        for axis, name in enumerate(AXES):
            if name in axes:
                image = np.where(block.there, spread(image, axis) / np.maximum(spread(there, axis), 1e-300), 0.0)
        return block.rows(block.there, v=image)

    own = voxels.select(*[F.col(a) if a in axes else F.lit(0).cast("long").alias(a) for a in AXES], F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("v"))
    out = tiled(own, step, "vx long, vy long, vz long, v double", halo, tile)
    return out.select(*axes, F.col("v").alias(value))


def _smoothed_by_joins(voxels: DataFrame, weights: np.ndarray, value: str, axes: tuple[str, ...]) -> DataFrame:
    reach = len(weights) // 2
    taps = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(float(w)).alias("w")) for d, w in zip(range(-reach, reach + 1), weights)])
    out = voxels.select(*axes, value)
    for a in axes:
        others = [x for x in axes if x != a]
        each = out.withColumn("_t", F.explode(taps)).select(*others, (F.col(a) + F.col("_t.d")).alias(a), (F.col(value) * F.col("_t.w")).alias("_s"), F.col("_t.w").alias("_w"))
        sums = each.groupBy(*axes).agg((F.sum("_s") / F.sum("_w")).alias(value))
        out = sums.join(voxels.select(*axes), list(axes), "left_semi")
    return out


def blobs(voxels: DataFrame, sigmas: tuple[float, ...], least: float, value: str = "value", axes: tuple[str, ...] = AXES) -> DataFrame:
    """Bright spots by differences of Gaussians: voxels whose response, at one of the scales, is above ``least`` and not below any neighbour's.

    Returns the voxel, sigma and response.  Neighbours are those that touch the voxel at its own and the next scales; equal ones all stay.
    """
    levels = [gaussian_smoothed(voxels, s, value, axes).withColumnRenamed(value, f"g{i}") for i, s in enumerate(sigmas)]
    stack = levels[0]
    for level in levels[1:]:
        stack = stack.join(level, list(axes))
    scales = F.array(*[F.struct(F.lit(i).alias("scale"), F.lit(float(s)).alias("sigma"), ((F.col(f"g{i}") - F.col(f"g{i + 1}")) * s).alias("response")) for i, s in enumerate(sigmas[:-1])])
    cube = checkpointed(stack.select(*axes, F.inline(scales)))
    steps = F.array(*[F.struct(*[F.lit(x).alias(k) for k, x in zip((*axes, "scale"), d)]) for d in itertools.product((-1, 0, 1), repeat=len(axes) + 1) if any(d)])
    around = cube.withColumn("_d", F.explode(steps)).select(*[(F.col(k) + F.col(f"_d.{k}")).alias(k) for k in (*axes, "scale")], "response")
    top = around.groupBy(*axes, "scale").agg(F.max("response").alias("_top"))
    best = cube.where(F.col("response") > least).join(top, [*axes, "scale"], "left").where(F.col("_top").isNull() | (F.col("response") >= F.col("_top")))
    return best.select(*axes, "sigma", "response")


def pruned_blobs(found: DataFrame, reach: float = 0.5, axes: tuple[str, ...] = AXES, most_rounds: int = 200) -> DataFrame:
    """Blobs without those that a stronger one overlaps: the result of going through them by falling response (ties by place, then sigma) and keeping each that overlaps none kept before.

    A blob's radius is sigma times the root of the number of axes; two overlap nearer than ``reach`` times the sum of their radii.  Found in rounds: what no
    open stronger neighbour can beat stays, what it overlaps goes, and the rest is open again.  Chains of neighbours set the number of rounds.  Repeated rows count once.
    """
    size = math.sqrt(len(axes))
    order = ["_weak", *axes, "sigma"]
    ranked = dense_ids(found.dropDuplicates([*axes, "sigma"]).withColumn("_weak", -F.col("response")), order, "_nth").drop("_weak")
    radius = F.col("sigma") * size
    widest = ranked.agg(F.max(radius)).first()[0] or 0.0
    place = [F.col(a).cast("double").alias(f"pos_{n}") for a, n in zip(axes, "xyz")] + [F.lit(0.0).alias(f"pos_{n}") for n in "xyz"[len(axes) :]]
    spots = checkpointed(ranked.select("_nth", radius.alias("r"), (reach * (radius + widest)).alias("_reach"), *place))
    pairs = radius_pairs(spots, spots, "_reach").where("a._nth < b._nth").where(F.col("distance") < reach * (F.col("a.r") + F.col("b.r")))
    edges, open_ = checkpointed(pairs.select(F.col("a._nth").alias("u"), F.col("b._nth").alias("v"))), spots.select("_nth")
    kept = spots.select("_nth").limit(0)
    for _ in range(most_rounds):
        stays = checkpointed(open_.join(edges.select(F.col("v").alias("_nth")).distinct(), "_nth", "left_anti"))
        kept = kept.union(stays)
        if edges.isEmpty():
            return ranked.join(kept, "_nth", "left_semi").drop("_nth")
        goes = checkpointed(edges.join(stays.withColumnRenamed("_nth", "u"), "u", "left_semi").select(F.col("v").alias("_nth")).distinct())
        open_ = checkpointed(open_.join(stays, "_nth", "left_anti").join(goes, "_nth", "left_anti"))
        u, v = open_.withColumnRenamed("_nth", "u"), open_.withColumnRenamed("_nth", "v")
        edges = checkpointed(edges.join(u, "u", "left_semi").join(v, "v", "left_semi"))
    raise RuntimeError(f"blobs did not settle in {most_rounds} rounds")


def bias_corrected(voxels: DataFrame, field: DataFrame, factor: int, value: str = "value", log_field: bool = False) -> DataFrame:
    """Values divided by a coarse field (or its exponential) of blocks of ``factor`` voxels."""
    f = field.select(*[F.col(a).alias(f"_{a}") for a in AXES], F.col(value).alias("_f"))
    keyed = voxels.withColumns({f"_{a}": F.floor(F.col(a) / factor).cast("long") for a in AXES})
    by = F.exp("_f") if log_field else F.col("_f")
    return keyed.join(f, [f"_{a}" for a in AXES], "left").withColumn(value, F.try_divide(F.col(value), by)).select(*voxels.columns)


#: Cells of the lines that a task holds in one array, and positions of a line that one task solves; a longer line is cut.
CELLS, SEGMENT = 500_000, 1024


def envelope(p: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower envelope of the parabolas h + (x - p)^2 of each row: (which, from, count).

    A row has ``n`` parabolas, by ascending p.  ``which`` has the column of each one that is lowest somewhere, from left to right, and ``from`` where
    its part begins (column ``count`` is infinite).  All rows take a step together; a step pushes one parabola and pops those that it hides (Felzenszwalb & Huttenlocher, 2012).
    """
    rows, most = p.shape
    which, start, top = np.zeros((rows, most), np.int32), np.full((rows, most + 1), np.inf), np.full(rows, -1)
    for j in range(most):
        active = np.flatnonzero(j < n)
        left = np.full(rows, -np.inf)
        todo = active[top[active] >= 0]
        while len(todo):
            v = which[todo, top[todo]]
            cut = (p[todo, j] + p[todo, v]) / 2 + (h[todo, j] - h[todo, v]) / (2 * (p[todo, j] - p[todo, v]))
            hidden = cut <= start[todo, top[todo]]
            left[todo] = np.where(hidden, -np.inf, cut)
            top[todo[hidden]] -= 1
            todo = todo[hidden]
            todo = todo[top[todo] >= 0]
        top[active] += 1
        which[active, top[active]] = j
        start[active, top[active]] = left[active]
    start[np.arange(rows), top + 1] = np.inf
    return which, start, top + 1


def along(x: np.ndarray, p: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Values of each row's lower envelope at the ascending places ``x`` (a row each); infinite without parabolas."""
    which, start, count = envelope(p, h, n)
    out, at, every = np.full(x.shape, np.inf), np.zeros(len(x), np.int64), np.flatnonzero(count > 0)
    for j in range(x.shape[1]):
        go = every
        while len(go):
            go = go[(at[go] + 1 < count[go]) & (start[go, at[go] + 1] < x[go, j])]
            at[go] += 1
        v = which[every, at[every]]
        out[every, j] = h[every, v] + (x[every, j] - p[every, v]) ** 2
    return out


def _groups_of(batches, keys: tuple[str, ...], names: tuple[str, ...]):
    """Groups of rows with equal keys, which follow each other, as padded arrays of bounded size: (keys of each group, counts, a matrix of each other column)."""
    held: dict[str, np.ndarray] = {}

    def padded(v: dict[str, np.ndarray]):
        heads = np.flatnonzero(np.concatenate([[True], np.any([np.diff(v[k]) != 0 for k in keys], axis=0)]))
        size = np.diff(np.append(heads, len(v[keys[0]])))
        first = 0
        while first < len(heads):
            wide = np.maximum.accumulate(size[first:]) * np.arange(1, len(size) - first + 1)
            last = first + max(1, int(np.searchsorted(wide, CELLS, "right")))
            n = size[first:last]
            row, column = np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            part = slice(int(heads[first]), int(heads[first]) + int(n.sum()))
            matrices = {}
            for name in names:
                matrices[name] = np.zeros((len(n), int(n.max())))
                matrices[name][row, column] = v[name][part]
            yield {k: v[k][heads[first:last]] for k in keys}, n, matrices
            first = last

    for batch in batches:
        v = {k: batch.column(k).to_numpy() for k in (*keys, *names)}
        if not batch.num_rows:
            continue
        if held:
            v = {k: np.concatenate([held[k], v[k]]) for k in v}
        change = np.flatnonzero(np.any([np.diff(v[k]) != 0 for k in keys], axis=0)) + 1
        cut = int(change[-1]) if len(change) else 0  # the last group may go on in the next batch
        if cut:
            yield from padded({k: x[:cut] for k, x in v.items()})
        held = {k: x[cut:] for k, x in v.items()}
    if held:
        yield from padded(held)


def _along_axis(sites: DataFrame, axis: str, length: int, step: float) -> DataFrame:
    """min over the sites (vx, vy, vz, d) of each line along an axis of d + (step * distance)^2, at every place from 0 to ``length`` - 1.

    A line longer than ``SEGMENT`` is cut: each segment finds the envelope of its own sites and sends every segment those that are lowest somewhere in it, so
    a line is shared by several tasks and none holds it whole.
    """
    others = [a for a in AXES if a != axis]
    segments = -(-length // SEGMENT)

    def emitted(columns: dict[str, np.ndarray], names: list[str]) -> list[pa.RecordBatch]:
        n = len(columns[names[0]])
        return [pa.RecordBatch.from_arrays([pa.array(columns[k][i : i + 100_000]) for k in names], names) for i in range(0, n, 100_000)]

    def sent(batches):
        for key, n, m in _groups_of(batches, (*others, "segment"), (axis, "d")):
            p = m[axis] * step
            which, start, count = envelope(p, m["d"], n)
            real = np.arange(which.shape[1]) < count[:, None]
            for t in range(segments):
                low, high = t * SEGMENT * step, (min(length, (t + 1) * SEGMENT) - 1) * step
                row, column = np.nonzero(real & (start[:, :-1] <= high) & (start[:, 1:] >= low))
                v = which[row, column]
                columns = {others[0]: key[others[0]][row], others[1]: key[others[1]][row], "segment": np.full(len(row), t, np.int64), axis: m[axis][row, v].astype(np.int64), "d": m["d"][row, v]}
                yield from emitted(columns, [*AXES, "d", "segment"])

    def solved(batches):
        for key, n, m in _groups_of(batches, (*others, "segment"), (axis, "d")):
            width = max(1, CELLS // min(SEGMENT, length))
            for a in range(0, len(n), width):
                part = slice(a, a + width)
                place = key["segment"][part, None] * SEGMENT + np.arange(min(SEGMENT, length))
                d = along(place * step, m[axis][part] * step, m["d"][part], n[part])
                row, column = np.nonzero(place < length)
                columns = {others[0]: key[others[0]][part][row], others[1]: key[others[1]][part][row], axis: place[row, column], "d": d[row, column]}
                yield from emitted(columns, [*AXES, "d"])

    keys = [*others, "segment"]
    own = sites.withColumn("segment", F.expr(f"{axis} div {SEGMENT}") if segments > 1 else F.lit(0).cast("long"))
    if segments > 1:
        own = own.repartition(*keys).sortWithinPartitions(*keys, axis).mapInArrow(sent, "vx long, vy long, vz long, d double, segment long")
    return own.repartition(*keys).sortWithinPartitions(*keys, axis).mapInArrow(solved, "vx long, vy long, vz long, d double")


def distance_to(sites: DataFrame, shape: tuple[int, int, int], spacing: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> DataFrame:
    """Exact Euclidean distance of every voxel of a box to the nearest site (vx, vy, vz); three passes of lower envelopes along the lines of one axis.

    Time follows the number of places, whatever the distances.  Without any site there are no rows; repeated sites count once.
    """
    out = sites.select(*[F.col(a).cast("long").alias(a) for a in AXES]).distinct().withColumn("d", F.lit(0.0))
    for axis, length, step in zip(AXES, shape, spacing):
        out = _along_axis(out, axis, length, step)
    return out.withColumn("d", F.sqrt("d"))


def signed_distance(mask: DataFrame, shape: tuple[int, int, int], spacing: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> DataFrame:
    """sdt of every voxel of a box: distance to the mask outside it, minus the distance to the outside within it.

    ``mask`` holds the foreground voxels.  An empty mask gives the box's diagonal, a full one minus that.
    """
    spark = mask.sparkSession
    box = spark.range(int(np.prod(shape))).select((F.col("id") % shape[0]).alias("vx"), (F.floor(F.col("id") / shape[0]) % shape[1]).alias("vy"), F.floor(F.col("id") / (shape[0] * shape[1])).alias("vz"))
    inside = mask.select(*[F.col(a).cast("long").alias(a) for a in AXES]).distinct()
    outside = box.join(inside, list(AXES), "left_anti")
    far = float(np.sqrt(sum((n * s) ** 2 for n, s in zip(shape, spacing))))
    out = box.join(distance_to(inside, shape, spacing).withColumnRenamed("d", "d_out"), list(AXES), "left").join(distance_to(outside, shape, spacing).withColumnRenamed("d", "d_in"), list(AXES), "left")
    return out.select(*AXES, (F.coalesce("d_out", F.lit(far)) - F.coalesce("d_in", F.lit(far))).alias("sdt"))
