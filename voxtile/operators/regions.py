"""Region tables: merges on null-safe keys, collapse to one row a region, wide tables over stains, cohorts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import col

KEYS = ("index", "name")


def _numeric(f: T.StructField) -> bool:
    return isinstance(f.dataType, T.NumericType)


def merge_outer(parts: list[DataFrame], keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Full outer join on keys of which nulls match each other.

    A column, other than a key, that two tables share is in neither of the results.
    """

    def join(a: DataFrame, b: DataFrame) -> DataFrame:
        shared = (set(a.columns) & set(b.columns)) - set(keys)
        a, b = a.drop(*shared), b.drop(*shared)
        right = b.select(*[col(c).alias(f"_r_{c}") if c in keys else col(c) for c in b.columns])
        on = reduce(lambda x, y: x & y, [col(k).eqNullSafe(col(f"_r_{k}")) for k in keys])
        out = a.join(right, on, "full_outer")
        return out.select(*[F.coalesce(col(k), col(f"_r_{k}")).alias(k) for k in keys], *[col(c) for c in [*a.columns, *b.columns] if c not in keys])

    return reduce(join, parts)


def drop_suffixed(df: DataFrame, suffixes: tuple[str, ...] = ("_x", "_y", "_z")) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.endswith(suffixes)])


def fill_zero(df: DataFrame, keep: tuple[str, ...] = ("volume",)) -> DataFrame:
    """0 for missing numbers, but in the columns of ``keep``; text stays missing."""
    return df.fillna(0, subset=[f.name for f in df.schema.fields if _numeric(f) and f.name not in (*keep, *KEYS)])


def collapse(df: DataFrame, keys: tuple[str, ...] = KEYS, summed: tuple[str, ...] = ("nvoxels",), order: str | None = None, counted: str | None = None) -> DataFrame:
    """One row a region: ``summed`` columns are added up, other numbers averaged, of text the smallest value stays, or that of the first row by ``order`` (missing ones don't count).

    Regions with a missing key are left out.  With ``counted`` a column of that name has the number of rows.  If count and volume are there, density is count / volume (NULL for no volume).
    """
    aggregates = []
    for f in df.schema.fields:
        if f.name not in (*keys, order):
            if f.name in summed or _numeric(f):
                of = F.sum(col(f.name)) if f.name in summed else F.avg(col(f.name))
            else:
                of = F.min(col(f.name)) if order is None else F.min_by(col(f.name), F.when(col(f.name).isNotNull(), col(order)))
            aggregates.append(of.alias(f.name))
    if counted:
        aggregates.append(F.count(F.lit(1)).cast("double").alias(counted))
    out = df.where(reduce(lambda a, b: a & b, [col(k).isNotNull() for k in keys])).groupBy(*keys).agg(*aggregates)
    return _with_density(out)


def _with_density(df: DataFrame) -> DataFrame:
    return df.withColumn("density", F.try_divide("count", "volume")) if {"count", "volume"} <= set(df.columns) else df


def region_statistics(objects: DataFrame, counts: DataFrame | None, fractions: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """Objects, counts and field fractions of one stain as one row a region; without ``counts`` the objects are counted in the same scan.

    Each table is collapsed before they are merged, so all objects of a region never meet in a join.  A missing number of an object counts as 0, and so does what a
    region lacks, but for its volume.  Columns that two tables share are in neither.
    """
    every = [objects, *([] if counts is None else [counts]), fractions]
    names = [c for p in every for c in p.columns if c not in KEYS]
    own, *others = [fill_zero(drop_suffixed(p.drop(*{c for c in names if names.count(c) > 1}))) for p in every]
    parts = [collapse(own, counted="count" if counts is None else None), *(collapse(p) for p in others)]
    return _with_density(fill_zero(merge_outer(parts))).drop(*drop)


def prefixed(df: DataFrame, prefix: str, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """``{prefix}+{column}`` for every column but the keys."""
    return df.select(*[col(c) if c in keys else col(c).alias(f"{prefix}+{c}") for c in df.columns])


def wide_by_stain(long: DataFrame, stains: list[str], metrics: dict[str, F.Column], stain: str = "stain", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Columns ``{stain}+{metric}`` in one aggregation over all stains; ``metrics`` are aggregates."""
    pivoted = long.groupBy(*keys).pivot(stain, stains).agg(*[m.alias(k) for k, m in metrics.items()])
    if len(metrics) == 1:
        k = next(iter(metrics))
        return pivoted.select(*keys, *[col(s).alias(f"{s}+{k}") for s in stains])
    return pivoted.select(*keys, *[col(f"{s}_{k}").alias(f"{s}+{k}") for s in stains for k in metrics])


def wide_from_tables(tables: dict[str, DataFrame], coloc: DataFrame | None = None) -> DataFrame:
    """Region tables of several stains side by side, and of object pairs if there are any."""
    parts = [prefixed(t, s) for s, t in tables.items()]
    return merge_outer([*parts, prefixed(coloc, "coloc")] if coloc is not None else parts)


def with_cohort(df: DataFrame, cohort: DataFrame, key: str = "participant_id") -> DataFrame:
    """Left join to a table with one row a subject; Spark broadcasts it while it is small."""
    return df.join(cohort, key, "left")


def unmatched(df: DataFrame, cohort: DataFrame, key: str = "participant_id") -> DataFrame:
    """Subjects without a row in the cohort."""
    return df.join(cohort, key, "left_anti").select(key).distinct()


def with_labels(df: DataFrame, labels: DataFrame, key: str = "index") -> DataFrame:
    """Left join to a label table; its columns that clash get the suffix _label."""
    clash = {c: f"{c}_label" for c in labels.columns if c != key and c in df.columns}
    return df.join(labels.withColumnsRenamed(clash), key, "left")


def count_per_region(objects: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Objects of each region; with a label table also its regions without objects."""
    if labels is None:
        return objects.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("count"))
    counts = objects.groupBy("index").agg(F.count(F.lit(1)).alias("count"))
    return labels.select(*KEYS).join(counts, "index", "left").select(*KEYS, F.coalesce("count", F.lit(0)).alias("count"))


def zonal_mean(voxels: DataFrame, value: str, voxel_volume: float, out: str = "fieldfrac") -> DataFrame:
    """Mean of a voxel value and volume of each label; ``voxels`` has index and the value."""
    return voxels.groupBy("index").agg(F.avg(value).alias(out), (F.count(F.lit(1)) * voxel_volume).alias("volume"))


def class_vote(labels: DataFrame, inside: str, label: str = "label") -> DataFrame:
    """Labels that have more voxels inside a prior mask than outside."""
    votes = labels.groupBy(label).agg(F.count_if(F.col(inside)).alias("n_in"), F.count_if(~F.col(inside)).alias("n_out"))
    return votes.where("n_in > n_out")


def same_channels(df: DataFrame, subject: str, channel: str) -> DataFrame:
    """Distinct channel sets with the number of subjects that have each; consistent data give one row."""
    return df.groupBy(subject).agg(F.array_join(F.array_sort(F.collect_set(channel)), "|").alias("channels")).groupBy("channels").agg(F.count(F.lit(1)).alias("n_subjects"))


def lateralized(labels: DataFrame, offset: int = 10_000) -> DataFrame:
    """Two copies of each label: left, and right with ``offset`` added to the index."""
    sides = F.array(*[F.struct(F.lit(f"{s} ").alias("p"), F.lit(f"-{s[0].upper()}").alias("s"), F.lit(o).alias("o")) for s, o in (("left", 0), ("right", offset))])
    out = labels.withColumn("_side", F.explode(sides)).withColumn("index", F.col("index") + F.col("_side.o")).withColumn("name", F.concat(F.col("_side.p"), F.col("name")))
    if "abbreviation" in labels.columns:
        out = out.withColumn("abbreviation", F.concat(F.col("abbreviation"), F.col("_side.s")))
    return out.select(*labels.columns)


def split_hemispheres(df: DataFrame, structure: str, left: str, right: str) -> DataFrame:
    """index, name: left and right rows of structures whose labels differ, one row of those with the same label on both sides."""
    same = F.coalesce(F.col(left) == F.col(right), F.lit(False))
    side = lambda c, p: F.struct(F.col(c).alias("index"), F.concat(F.lit(p), F.col(structure)).alias("name"))
    rows = F.when(same, F.array(side(left, ""))).otherwise(F.array(side(left, "left "), side(right, "right ")))
    return df.select(F.inline(rows))


def label_inventory(voxels: DataFrame, index: str = "index") -> DataFrame:
    """The labels that a volume has, without the background."""
    return voxels.where(col(index) > 0).select(col(index).alias("index")).distinct()


def resolve_labels(labels: DataFrame, requests: DataFrame | None) -> DataFrame:
    """Indices of requested labels: by number, name or abbreviation; unknown ones are left out.  Without requests, all but the background.

    ``requests`` has one text column ``label``.  One equi-join on what a label may be called, in place of a join on alternatives.
    """
    if requests is None:
        return label_inventory(labels)
    keys = [F.col("index").cast("string"), F.col("name")] + ([F.col("abbreviation")] if "abbreviation" in labels.columns else [])
    named = labels.select("index", F.explode(F.array_distinct(F.array(*keys))).alias("label")).where("label is not null")
    return named.join(requests.select("label").distinct(), "label", "left_semi").select("index").distinct()


def top_n(df: DataFrame, metric: str, n: int = 20, groups: tuple[str, ...] = (), descending: bool = True, tie: str = "index") -> DataFrame:
    """Rows with the largest (or smallest) metric that is neither missing nor 0, in each group; ties by ``tie``."""
    from pyspark.sql import Window

    good = df.where(col(metric).isNotNull() & (col(metric) != 0))
    order = [col(metric).desc() if descending else col(metric).asc(), col(tie)]
    if not groups:
        return good.orderBy(*order).limit(n)
    return good.withColumn("rank", F.row_number().over(Window.partitionBy(*groups).orderBy(*order))).where(F.col("rank") <= n)


def of_subjects(df: DataFrame, others: DataFrame, key: str = "participant_id") -> DataFrame:
    """Rows of the subjects that another table has, each once; subjects compare without a ``sub-`` prefix, and a NULL one is never among them."""
    bare = lambda: F.regexp_replace(F.col(f"`{key}`").cast("string"), "^sub-", "")
    known = others.select(bare().alias("_subject")).where("_subject is not null").distinct()
    return df.withColumn("_subject", bare()).join(known, "_subject", "left_semi").drop("_subject")
