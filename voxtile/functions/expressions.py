"""Column expressions for geometry, intensities and text labels."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tokens that text tables use for a missing value (those that pandas reads as missing by default).
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def col(name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def sphere_radius(nvoxels: Column, edge: float = 1.0) -> Column:
    """Radius of the sphere that has the volume of so many voxels."""
    return F.cbrt(3.0 * nvoxels * edge**3 / (4.0 * math.pi))


def norm(*parts: Column) -> Column:
    total = parts[0] * parts[0]
    for p in parts[1:]:
        total = total + p * p
    return F.sqrt(total)


def overlap_ratio(distance: Column, radius_a: Column, radius_b: Column) -> Column:
    """1 for spheres with one centre, 0 from touching on; NULL if the radii sum to 0."""
    return F.greatest(F.lit(0.0), 1.0 - F.try_divide(distance, radius_a + radius_b))


def affine(matrix: list[list[float]], x: Column, y: Column, z: Column) -> list[Column]:
    """Rows of a 4 by 4 affine matrix applied to a point."""
    return [x * float(r[0]) + y * float(r[1]) + z * float(r[2]) + float(r[3]) for r in matrix[:3]]


def inverse_affine(matrix: list[list[float]]) -> list[list[float]]:
    import numpy as np

    return np.linalg.inv(np.array(matrix, float)).tolist()


def clamp_unit(c: Column, lo: float | Column, hi: float | Column) -> Column:
    """(c - lo) / (hi - lo) within 0 and 1; 0 for an empty range."""
    lo, hi = (x if isinstance(x, Column) else F.lit(float(x)) for x in (lo, hi))
    return F.when(hi <= lo, 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.try_divide(c - lo, hi - lo))))


def threshold_mask(c: Column, threshold: float | Column) -> Column:
    """100 above the threshold, else 0, so that block means are per cent."""
    return F.when(c > threshold, 100).otherwise(0)


def minus_log10(p: Column) -> Column:
    """-log10(p); 0 for a missing or non-positive p."""
    return F.when(p > 0, -F.log10(p)).otherwise(0.0)


def rgb_hex(r: Column, g: Column, b: Column) -> Column:
    return F.format_string("%02x%02x%02x", r.cast("int"), g.cast("int"), b.cast("int"))


def hex_channel(c: Column, channel: int) -> Column:
    """Channel 0, 1 or 2 of a six-digit colour, with or without '#'; NULL for anything else."""
    digits = F.regexp_replace(c, "^#", "")
    return F.when(digits.rlike("^[0-9a-fA-F]{6}$"), F.conv(F.substring(digits, 1 + 2 * channel, 2), 16, 10).cast("int"))


def slug(c: Column, fallback: Column, joiner: str = "_") -> Column:
    """Letters and digits of a label, other runs as ``joiner``, ends stripped; ``fallback`` if nothing is left."""
    out = F.regexp_replace(c, "[^a-zA-Z0-9]+", joiner)
    if joiner:
        out = F.regexp_replace(out, f"^{joiner}+|{joiner}+$", "")
    return F.when(F.length(out) > 0, out).otherwise(fallback)


def path_entity(path: Column, prefix: str) -> Column:
    """First part of a path that starts with ``prefix``; NULL if there is none."""
    found = F.regexp_extract(path, rf"(?:^|/)({prefix}[^/]*)", 1)
    return F.when(found != "", found)
