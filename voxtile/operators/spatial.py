"""Points, grids and regions: radius joins on grid cells, voxel lookups, counts and linear interpolation."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import affine, inverse_affine, norm, overlap_ratio, sphere_radius

AXES = "xyz"


def with_object_ids(objects: DataFrame, voxel_edge: float = 0.002) -> DataFrame:
    """Add radius and object_id, ``{stain}_{n}``: n is the place among all objects by stain, position and size.

    The numbers come from sorted ranges and their offsets, so no task sorts a whole stain.
    """
    from .graph import dense_ids

    order = ["stain", "pos_z", "pos_y", "pos_x", "nvoxels"]
    numbered = dense_ids(objects, order, "_n")
    return numbered.withColumn("object_id", F.concat_ws("_", "stain", F.col("_n").cast("string"))).drop("_n").withColumn("radius", sphere_radius(F.col("nvoxels"), voxel_edge))


#: Rows of either side that a cell may have before it is split, and how often cells are halved; what is crowded still (points at one place, dense balls) is dealt by row.
MOST_IN_CELL, DEPTH = 2_000, 8


def _reached(level: Column, cell: list[Column], size: Column, radius: Column, at: list[Column]) -> Column:
    """Whether a ball meets a cell of a level, whose sides are ``size`` / 2^level; a little wider, as places are rounded."""
    side = size / F.pow(F.lit(2.0), level.cast("double"))
    gaps = [F.greatest(c * side - p, p - (c + 1) * side, F.lit(0.0)) for c, p in zip(cell, at)]
    return sum((g * g for g in gaps[1:]), gaps[0] * gaps[0]) <= radius * radius * (1 + 1e-9) + 1e-300


def _split(left: DataFrame, right: DataFrame, place: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]], radius: str, position: tuple[str, str, str], most: int, depth: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides in cells (``place``), crowded ones split: an octree whose leaves have at most ``most`` rows of ``b``, or of ``a``, and then parts of leaves that can't be split.

    A cell is split only as long as its halves are no smaller than the largest radius there: below that a ball meets nearly all
    small cells that it covers, so rows of ``a`` would multiply while the rows of a cell hardly get fewer.
    Rows are held once, before they go to cells, so that what deals them stays the same whenever they are read.
    """
    from .graph import checkpointed

    keys = ["_o", "_l", "_c0", "_c1", "_c2"]
    side = lambda level: F.col("_size") / (2.0**level)
    (a, b), held, dealt, level = place(left, right), False, [], 0
    while True:
        here = F.col("_l") == level
        of_a = a.where(here).select(*keys, "_size", F.lit(1).alias("_a"), F.lit(0).alias("_b"), F.col(f"a.{radius}").cast("double").alias("_r"))
        of_b = b.where(here).select(*keys, "_size", F.lit(0).alias("_a"), F.lit(1).alias("_b"), F.lit(0.0).alias("_r"))
        sizes = of_a.union(of_b).groupBy(*keys, "_size").agg(F.sum("_a").alias("_na"), F.sum("_b").alias("_nb"), F.max("_r").alias("_r"))
        worth = (side(level + 1) >= F.col("_r")) if level < depth else F.lit(False)
        crowded = checkpointed(sizes.where(f"_na > 0 and _nb > 0 and (_na > {most} or _nb > {most})").withColumn("_worth", worth))
        if not held and not crowded.isEmpty():
            a, b = place(*[checkpointed(x.withColumn("_row", F.monotonically_increasing_id())) for x in (left, right)])
            held = True
        dealt.append(crowded.where("not _worth"))
        crowded = crowded.where("_worth")
        if crowded.isEmpty():
            break
        crowded = crowded.select(*keys, F.lit(True).alias("_split"))
        a, b = a.join(crowded, keys, "left"), b.join(crowded, keys, "left")
        half = [F.floor(F.col(f"b.{p}") / side(level + 1)).cast("long") for p in position]
        split = F.coalesce("_split", F.lit(False))
        b = b.select("b", "_row", "_o", (F.col("_l") + split.cast("int")).alias("_l"), *[F.when(split, h).otherwise(F.col(k)).alias(k) for k, h in zip(keys[2:], half)], "_size")
        children = F.array(*[F.struct(*[F.lit(v).alias(f"d{i}") for i, v in enumerate(d)]) for d in itertools.product((0, 1), repeat=3)])
        down = a.where(split).withColumn("_d", F.explode(children)).select("a", "_row", "_o", (F.col("_l") + 1).alias("_l"), *[(2 * F.col(k) + F.col(f"_d.d{i}")).alias(k) for i, k in enumerate(keys[2:])], "_size")
        down = down.where(_reached(F.col("_l"), [F.col(k) for k in keys[2:]], F.col("_size"), F.col(f"a.{radius}"), [F.col(f"a.{p}") for p in position]))
        a, b = checkpointed(a.where(~split).drop("_split").unionByName(down)), checkpointed(b)
        level += 1
    parts = dealt[0]
    for more in dealt[1:]:
        parts = parts.union(more)
    if parts.isEmpty():
        return a, b, keys
    # leaves that are crowded still: each row of a side meets all parts of the other side
    parts = parts.select(*keys, F.ceil(F.col("_na") / most).cast("long").alias("_pa"), F.ceil(F.col("_nb") / most).cast("long").alias("_pb"))
    both = []
    for rows, own, other in ((a, "_pa", "_pb"), (b, "_pb", "_pa")):
        rows = rows.join(parts, keys, "left").withColumns({"_pa": F.coalesce("_pa", F.lit(1)), "_pb": F.coalesce("_pb", F.lit(1))})
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))
        mine, all_ = ("_ka", "_kb") if own == "_pa" else ("_kb", "_ka")
        both.append(rows.withColumn(mine, F.col("_row") % F.col(own)).withColumn(all_, every).drop("_pa", "_pb"))
    return *both, [*keys, "_ka", "_kb"]


def radius_pairs(
    left: DataFrame, right: DataFrame, radius: str, position: tuple[str, str, str] = ("pos_x", "pos_y", "pos_z"), cell: float | None = None, most: int = MOST_IN_CELL, depth: int = DEPTH
) -> DataFrame:
    """Pairs a, b (structs) with distance <= a's radius, and distance; rows without a position or a finite radius are left out.

    Cells are as large as the largest radius, so a's ball meets 27 cells at most: an equi-join on cells, then the exact test.
    If radii differ by much, left rows go to grids by octave of their radius, and right rows to each octave that is there.
    Cells with more than ``most`` rows of a side are halved again and again, where they are crowded, and balls go to the cells they meet.
    """
    ok = lambda df: df.where(" and ".join(f"{p} is not null and not isnan({p})" for p in position))
    left = ok(left).withColumn("_row", F.lit(0).cast("long")).where((F.col(radius) >= 0) & (F.col(radius) < float("inf")))  # NaN is above infinity here
    right = ok(right).withColumn("_row", F.lit(0).cast("long"))
    a_columns, b_columns = [[c for c in df.columns if c != "_row"] for df in (left, right)]
    if cell is None:
        octave = F.when(F.col(radius) > 0, F.ceil(F.log2(radius))).otherwise(-1000).cast("int")
        levels = left.select(octave.alias("o")).distinct()
        left = left.withColumn("_o", octave)
        size = F.when(F.col("_o") == -1000, F.lit(1.0)).otherwise(F.pow(F.lit(2.0), F.col("_o").cast("double")))
        right = right.crossJoin(F.broadcast(levels.withColumnRenamed("o", "_o")))  # octaves of a double: 2,100 at most
    else:
        left, right, size = left.withColumn("_o", F.lit(0)), right.withColumn("_o", F.lit(0)), F.lit(float(cell))
    at = [F.floor(F.col(p) / size) for p in position]
    around = F.array(*[F.struct(*[F.lit(v).alias(f"d{i}") for i, v in enumerate(d)]) for d in itertools.product((-1, 0, 1), repeat=3)])
    root = [F.lit(0).alias("_l"), size.cast("double").alias("_size")]

    def place(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
        a = left.withColumn("_d", F.explode(around)).select(F.struct(*a_columns).alias("a"), "_row", "_o", *[(c + F.col(f"_d.d{i}")).alias(f"_c{i}") for i, c in enumerate(at)], *root)
        a = a.where(_reached(F.col("_l"), [F.col(f"_c{i}") for i in range(3)], F.col("_size"), F.col(f"a.{radius}"), [F.col(f"a.{p}") for p in position]))
        return a, right.select(F.struct(*b_columns).alias("b"), "_row", "_o", *[c.alias(f"_c{i}") for i, c in enumerate(at)], *root)

    a, b, keys = _split(left, right, place, radius, position, most, depth)
    both = a.drop("_size", "_row").join(b.drop("_size", "_row"), keys)
    distance = norm(*[F.col(f"b.{p}") - F.col(f"a.{p}") for p in position])
    return both.withColumn("distance", distance).where(F.col("distance") <= F.col(f"a.{radius}")).select("a", "b", "distance")


def colocalized(objects: DataFrame, stains: list[str], multiplier: float = 1.0, least_overlap: float = 0.0, cell: float | None = None) -> DataFrame:
    """Object pairs of each two stains (in the order of ``stains``) that overlap by more than ``least_overlap``.

    ``objects`` has object_id, stain, radius, nvoxels, pos_* and template_*.  A pair needs a distance of at most
    ``multiplier`` times the first object's radius.  Returns the sixteen pair columns, also for no pairs.
    """
    rank = F.array_position(F.array(*[F.lit(s) for s in stains]), F.col("stain"))
    ranked = objects.withColumn("_rank", rank).where("_rank > 0").withColumn("_reach", F.col("radius") * multiplier)
    pairs = radius_pairs(ranked, ranked, "_reach", cell=cell).where("a._rank < b._rank")
    ratio = overlap_ratio(F.col("distance"), F.col("a.radius"), F.col("b.radius"))
    middle = lambda p: ((F.col(f"a.{p}") + F.col(f"b.{p}")) / 2)
    out = pairs.withColumn("overlapratio", ratio).where(F.col("overlapratio") > least_overlap)
    names = [f"{k}_{s}" for k in ("object_id", "stain", "radius", "nvoxels") for s in "ab"]
    return out.select(
        *[F.col(f"{n[-1]}.{n[:-2]}").alias(n) for n in names], "distance", "overlapratio",
        *[middle(f"pos_{a}").alias(f"pos_coloc_{a}") for a in AXES], *[middle(f"template_{a}").alias(f"template_coloc_{a}") for a in AXES],
    )


def to_voxels(points: DataFrame, matrix: list[list[float]], position: tuple[str, str, str] = ("pos_x", "pos_y", "pos_z")) -> DataFrame:
    """Add vx, vy, vz: the nearest voxel of a physical position (halves to the even voxel)."""
    at = affine(inverse_affine(matrix), *[F.col(p) for p in position])
    return points.withColumns({f"v{a}": F.rint(c).cast("long") for a, c in zip(AXES, at)})


def label_points(points: DataFrame, grid: DataFrame, matrix: list[list[float]], labels: DataFrame | None = None, position: tuple[str, str, str] = ("pos_x", "pos_y", "pos_z")) -> DataFrame:
    """Add index, the label of the voxel that holds a point (0 outside), and name if a label table is given."""
    out = to_voxels(points, matrix, position).join(grid.select("vx", "vy", "vz", "index"), ["vx", "vy", "vz"], "left")
    out = out.withColumn("index", F.coalesce("index", F.lit(0))).drop("vx", "vy", "vz")
    return out.join(labels.select("index", "name"), "index", "left") if labels is not None else out


def points_to_grid(points: DataFrame, matrix: list[list[float]], shape: tuple[int, int, int], position: tuple[str, str, str] = ("pos_x", "pos_y", "pos_z")) -> DataFrame:
    """Points of each voxel of a grid; voxels without any, and points outside, are left out."""
    inside = " and ".join(f"v{a} between 0 and {n - 1}" for a, n in zip(AXES, shape))
    return to_voxels(points, matrix, position).where(inside).groupBy("vx", "vy", "vz").agg(F.count(F.lit(1)).alias("count"))


def sample_linear(points: DataFrame, key: str, grid: DataFrame, values: list[str], matrix: list[list[float]], position: tuple[str, str, str] = ("pos_x", "pos_y", "pos_z")) -> DataFrame:
    """key and the trilinear interpolation of grid values at each point: eight corners, one equi-join, one weighted sum.

    NULL where a corner with a weight is outside the grid.
    """
    at = affine(inverse_affine(matrix), *[F.col(p) for p in position])
    placed = points.select(key, *[c.alias(f"_f{a}") for a, c in zip(AXES, at)])
    corners = F.array(*[F.struct(*[F.lit(v).alias(a) for a, v in zip(AXES, (i, j, k))]) for i in (0, 1) for j in (0, 1) for k in (0, 1)])
    weight = F.lit(1.0)
    for a in AXES:
        part = F.col(f"_f{a}") - F.floor(f"_f{a}")
        weight = weight * F.when(F.col(f"_d.{a}") == 1, part).otherwise(1 - part)
    each = placed.withColumn("_d", F.explode(corners)).select(key, weight.alias("_w"), *[(F.floor(f"_f{a}") + F.col(f"_d.{a}")).cast("long").alias(f"v{a}") for a in AXES])
    joined = each.where("_w > 0").join(grid.select("vx", "vy", "vz", *values), ["vx", "vy", "vz"], "left")
    total = [F.when(F.count_if(F.col(v).isNull()) == 0, F.sum(F.col("_w") * F.col(v))).alias(v) for v in values]
    return joined.groupBy(key).agg(*total)


def transform_points(points: DataFrame, key: str, field: DataFrame, matrix: list[list[float]]) -> DataFrame:
    """template_x, template_y, template_z: positions plus the displacement (dx, dy, dz) interpolated there."""
    moved = sample_linear(points, key, field, ["dx", "dy", "dz"], matrix)
    return points.join(moved, key, "left").select(*points.columns, *[(F.col(f"pos_{a}") + F.col(f"d{a}")).alias(f"template_{a}") for a in AXES])


def bounding_boxes(voxels: DataFrame, label: str = "label") -> DataFrame:
    """Extent, size and filled share of each label's box."""
    ends = [f.alias(f"{n}_{a}") for a in AXES for n, f in (("min", F.min(f"v{a}")), ("max", F.max(f"v{a}")))]
    boxes = voxels.groupBy(label).agg(F.count(F.lit(1)).alias("nvoxels"), *ends)
    volume = math.prod([F.col(f"max_{a}") - F.col(f"min_{a}") + 1 for a in AXES], start=F.lit(1).cast("long"))
    return boxes.withColumn("extent", F.col("nvoxels") / volume)


def magnitude_summary(field: DataFrame) -> DataFrame:
    """Mean, population deviation and maximum of the length of displacement vectors."""
    size = norm(F.col("dx"), F.col("dy"), F.col("dz"))
    return field.select(size.alias("m")).agg(F.avg("m").alias("mean"), F.stddev_pop("m").alias("std"), F.max("m").alias("max"))


def _first_of_batches(df: DataFrame, n: int, groups: tuple[str, ...], place: str, key: str) -> DataFrame:
    """Rows that are among the first ``n`` of their group (by place, then key) in their own batch: all others can't be among the first of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows <= n:
                yield batch
                continue
            codes = [batch.column(g).dictionary_encode().indices.fill_null(-1).to_numpy() for g in groups]
            at = pa.table({"place": batch.column(place), "key": batch.column(key)})
            order = pc.sort_indices(at, sort_keys=[("place", "ascending"), ("key", "ascending")], null_placement="at_start").to_numpy()
            by = order[np.lexsort([c[order] for c in codes])]  # a stable sort
            same = np.all([c[by][1:] == c[by][:-1] for c in codes], axis=0)
            start = np.maximum.accumulate(np.where(np.append(True, ~same), np.arange(len(by)), 0))
            yield batch.take(pa.array(np.sort(by[np.arange(len(by)) - start < n])))

    return df.mapInArrow(run, df.schema)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42, groups: tuple[str, ...] = ()) -> DataFrame:
    """``n`` rows (of each group) by a seeded digest of the key, the same in every run.

    Of groups (columns of plain types) each batch of rows hands on its first ``n`` only, so what is sorted is a small share of rows in long groups.
    """
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    if not groups:
        return df.orderBy(place, key).limit(n)
    few = _first_of_batches(df.withColumn("_place", place), n, groups, "_place", key)
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy("_place", key))
    return few.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank", "_place")



def seeded_order(df: DataFrame, key: str, seed: int = 42, name: str = "place") -> DataFrame:
    """Rows numbered from 0 in a seeded permutation, the same in every run; by digests, so that other engines can repeat it."""
    from .graph import dense_ids

    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return dense_ids(df.withColumn("_digest", digest), ["_digest", key], name).drop("_digest")


def ordered_by_radius(objects: DataFrame, name: str = "place") -> DataFrame:
    """Objects numbered from 0 by the radius of a ball of their size, or by the mean of both radii of a pair; ties by all columns."""
    from .graph import dense_ids

    columns = objects.columns
    radius = (F.col("radius_a") + F.col("radius_b")) / 2 if {"radius_a", "radius_b"} <= set(columns) else sphere_radius(F.col("nvoxels") if "nvoxels" in columns else F.lit(1))
    return dense_ids(objects.withColumn("radius_sort", radius), ["radius_sort", *columns], name)


def present_labels(labels: DataFrame, voxels: DataFrame, coarse: bool = False, index: str = "index") -> DataFrame:
    """The first labels by number that a volume has, without the background: 25 of a coarse segmentation, or else 100."""
    there = voxels.select(index).distinct()
    return labels.where(F.col(index) > 0).join(there, index, "left_semi").orderBy(index).limit(25 if coarse else 100)


def resized(grid: DataFrame, shape: tuple[int, ...], target: tuple[int, ...], value: str = "value", axes: tuple[str, ...] = ("vx", "vy", "vz")) -> DataFrame:
    """A grid on another shape by linear interpolation, axis by axis, with the corners of both grids at the same places.

    Voxels that the grid lacks are 0.  Each voxel goes to the at most few targets between it and its neighbours, so a pass is one aggregation.
    """
    out = grid.select(*axes, F.col(value).cast("double").alias(value))
    for axis, n, m in zip(axes, shape, target):
        step = (n - 1) / (m - 1) if m > 1 else 0.0  # source places for each target place
        at = F.col(axis)
        if n == 1 or step == 0:
            first, last = F.lit(0), F.when(at == 0, F.lit(m - 1)).otherwise(F.lit(-1))
        else:
            first, last = F.greatest(F.ceil((at - 1) / step), F.lit(0)), F.least(F.floor((at + 1) / step), F.lit(m - 1))
        place = F.explode(F.when(last >= first, F.sequence(first.cast("long"), last.cast("long"))).otherwise(F.array().cast("array<long>")))
        each = out.withColumn("_t", place)
        weight = F.greatest(F.lit(1.0) - F.abs(F.col("_t") * step - at), F.lit(0.0))
        others = [a for a in axes if a != axis]
        out = each.where(weight > 0).groupBy(*others, F.col("_t").alias(axis)).agg(F.sum(F.col(value) * weight).alias(value)).select(*axes, value)
    return out
