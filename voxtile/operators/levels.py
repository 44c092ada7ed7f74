"""Levels of a volume: coarser images of blocks, and values of coarse levels at finer voxels.

Level 0 is the volume itself; level k has a voxel for each block of ``factor``**k voxels a side that has any.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import voxel_components
from .spatial import bounding_boxes
from .tiles import AXES
from .volume import gaussian_smoothed


def _block(axis: str, factor: int) -> Column:
    return F.floor(F.col(axis) / factor).cast("long")


def _factors(factor: int | tuple[int, int, int]) -> tuple[int, int, int]:
    each = (factor,) * 3 if isinstance(factor, int) else tuple(factor)
    if min(each) < 1:
        raise ValueError("a level's factors must be 1 or more")
    return each


def raised(voxels: DataFrame, factor: int | tuple[int, int, int], value: str = "value", how: str = "mean") -> DataFrame:
    """The next level: vx, vy, vz, ``value`` of each block with a voxel, its mean, its largest value, or the value that most of its voxels have (``vote``; of equal ones the smallest).

    Voxels with a NULL value don't count; a block of such voxels has no row.
    """
    blocks = voxels.where(F.col(value).isNotNull()).select(*[_block(a, f).alias(a) for a, f in zip(AXES, _factors(factor))], value)
    if how in ("mean", "max"):
        return blocks.groupBy(*AXES).agg((F.avg if how == "mean" else F.max)(value).alias(value))
    if how != "vote":
        raise ValueError("a level is made by mean, max or vote")
    votes = blocks.groupBy(*AXES, value).agg(F.count(F.lit(1)).alias("_n"))
    return votes.groupBy(*AXES).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(value))


def pyramid(voxels: DataFrame, levels: int, factor: int = 2, value: str = "value") -> DataFrame:
    """level, vx, vy, vz, value, n of levels 0 to ``levels``: means of all voxels below (not of means) and their number, in one aggregation.

    A voxel goes to a block of each level; blocks are summed before the shuffle, so upper levels cost little.
    """
    each = voxels.where(F.col(value).isNotNull()).withColumn("level", F.explode(F.array(*[F.lit(k) for k in range(levels + 1)])))
    width = F.pow(F.lit(float(factor)), F.col("level"))
    return each.groupBy("level", *[F.floor(F.col(a) / width).cast("long").alias(a) for a in AXES]).agg(F.avg(value).alias(value), F.count(F.lit(1)).alias("n"))


def lowered(coarse: DataFrame, fine: DataFrame, factor: int | tuple[int, int, int], value: str = "value", how: str = "nearest", name: str = "coarse") -> DataFrame:
    """``fine`` (vx, vy, vz and others) with the value of a coarser level as ``name``: that of a voxel's block, or by trilinear interpolation between block centres.

    Blocks that are missing leave their weight to the others (at the rim the nearest counts); without any the value is NULL.  For the
    interpolation each cell between centres gets its eight corners first, on the coarse level, so each fine voxel meets one row.
    """
    if how not in ("nearest", "linear"):
        raise ValueError("a coarse level is read by nearest or linear")
    factors = _factors(factor)
    keys = [f"_c{a}" for a in AXES]
    columns = [F.col(f"`{c}`") for c in fine.columns if c != name]
    if how == "nearest":
        table = coarse.select(*[F.col(a).alias(k) for a, k in zip(AXES, keys)], F.col(value).alias(name))
        return fine.withColumns({k: _block(a, f) for a, k, f in zip(AXES, keys, factors)}).join(table, keys, "left").select(*columns, name)
    corners = list(itertools.product((0, 1), repeat=3))
    shifts = F.array(*[F.struct(*[F.lit(v).alias(a) for a, v in zip(AXES, c)], F.lit(i).alias("i")) for i, c in enumerate(corners)])
    spread = coarse.where(F.col(value).isNotNull()).withColumn("_d", F.explode(shifts)).select(*[(F.col(a) - F.col(f"_d.{a}")).alias(k) for a, k in zip(AXES, keys)], F.col("_d.i").alias("i"), F.col(value).alias("v"))
    cells = spread.groupBy(*keys).agg(*[F.max(F.when(F.col("i") == i, F.col("v"))).alias(f"_v{i}") for i in range(8)])
    place = {a: (F.col(a) + 0.5) / f - 0.5 for a, f in zip(AXES, factors)}
    placed = fine.withColumns({f"_p{a}": x for a, x in place.items()}).withColumns({k: F.floor(f"_p{a}").cast("long") for a, k in zip(AXES, keys)})
    both = placed.join(cells, keys, "left")
    total, weights = F.lit(0.0), F.lit(0.0)
    for i, c in enumerate(corners):
        weight = F.lit(1.0)
        for a, k, side in zip(AXES, keys, c):
            part = F.col(f"_p{a}") - F.col(k)
            weight = weight * (part if side else 1 - part)
        known = F.col(f"_v{i}").isNotNull()
        total = total + F.when(known, weight * F.col(f"_v{i}")).otherwise(0.0)
        weights = weights + F.when(known, weight).otherwise(0.0)
    return both.select(*columns, F.when(weights > 0, total / weights).alias(name))


def cleaned_at_level(mask: DataFrame, factor: int | tuple[int, int, int], least_extent: float = 0.15, connectivity: int = 26) -> DataFrame:
    """Voxels of a mask (vx, vy, vz) whose object on a coarser level fills at least such a share of its box.

    Objects are found on the coarse level, where a block with a voxel counts, and decide about the fine voxels in their blocks.
    """
    blocks = mask.select(*[_block(a, f).alias(a) for a, f in zip(AXES, _factors(factor))]).distinct()
    objects = voxel_components(blocks, connectivity)
    good = bounding_boxes(objects).where(F.col("extent") >= least_extent).select("label")
    kept = objects.join(good, "label", "left_semi").select(*AXES, F.lit(1).alias("keep"))
    return lowered(kept, mask, factor, "keep", "nearest", "_keep").where("_keep = 1").drop("_keep")


def bias_field_corrected(voxels: DataFrame, factor: int | tuple[int, int, int], sigma: float, value: str = "value") -> DataFrame:
    """Add field and corrected: a smooth field of block means, interpolated at each voxel, and the value divided by it (NULL for a field of 0)."""
    coarse = gaussian_smoothed(raised(voxels, factor, value), sigma, value)
    out = lowered(coarse, voxels, factor, value, "linear", "field")
    return out.withColumn("corrected", F.try_divide(F.col(value), F.col("field")))


def isotropic_factors(spacing: tuple[float, float, float]) -> tuple[int, int, int]:
    """Powers of two for each axis that bring its spacing next to the largest one, without passing it by more than a half."""
    widest = max(spacing)
    out = []
    for s in spacing:
        f = 1
        while s * f * 2 <= widest * 1.5 and abs(s * f * 2 - widest) < abs(s * f - widest):
            f *= 2
        out.append(f)
    return tuple(out)
