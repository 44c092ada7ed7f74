"""Histograms, percentiles, moments, profiles and summaries."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def histogram(df: DataFrame, value: str, lo: float, hi: float, bins: int) -> DataFrame:
    """bin, lo, hi, count for every bin of [lo, hi]; the last bin is closed, values outside are left out."""
    width = (hi - lo) / bins
    v = F.col(value)
    counts = df.where((v >= lo) & (v <= hi)).groupBy(F.least(F.floor((v - lo) / width), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return all_bins.join(counts, "bin", "left").select("bin", (lo + F.col("bin") * width).alias("lo"), (lo + (F.col("bin") + 1) * width).alias("hi"), F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def bins_by_width(lo: float, hi: float, width: float) -> int:
    return max(2, math.ceil((hi - lo) / width))


def with_ecdf(hist: DataFrame) -> DataFrame:
    """Add cum_count and ecdf to a histogram; its size is its number of bins, so one sorted window is enough."""
    running = F.sum("count").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    return hist.withColumn("cum_count", running).withColumn("ecdf", F.try_divide(F.col("cum_count"), F.sum("count").over(Window.partitionBy())))


def histogram_summary(hist: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.9, 0.99)) -> DataFrame:
    """Mean of bin centres, share of the last bin in per cent, and the first centre whose cumulative share reaches each quantile."""
    c = with_ecdf(hist).withColumn("center", (F.col("lo") + F.col("hi")) / 2)
    of = [F.min(F.when(F.col("ecdf") >= q, F.col("center"))).alias(f"q{round(q * 100)}") for q in quantiles]
    return c.agg(F.try_divide(F.sum(F.col("center") * F.col("count")), F.sum("count")).alias("mean"), (100 * F.try_divide(F.max_by("count", "bin"), F.sum("count"))).alias("saturation_pct"), *of)


#: Parts that an interval of values is cut in at each scan, values of one rank that are sorted by the driver, and scans with even parts of the
#: interval before parts even in the logarithm are taken; with those few scans are left for any doubles, so ``ROUNDS`` is never reached.
PARTS, FEW, EVEN_ROUNDS, ROUNDS = 2048, 2048, 2, 16


def _table_of(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few rows as literals of the plan, so that no Python worker has to make them."""
    row = lambda r: F.struct(*[F.lit(x).cast(f.dataType).alias(f.name) for x, f in zip(r, schema.fields)])
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    return spark.range(1).select(F.inline(F.array(*[row(r) for r in rows])))


def _part(v: Column, lo: Column, hi: Column, even: bool) -> Column:
    """Number of the part of [lo, hi] that holds a value, ascending with it; lo and hi are in different parts.

    Parts have one width, or else one ratio of their ends: apart by sign first, then by the logarithm of the size while the ends are a power of two apart.
    """
    share = lambda x, a, b: F.when(b > a, F.least(F.floor(F.try_divide(x - a, b - a) * PARTS), F.lit(PARTS - 1)))
    half = share(v / 2, lo / 2, hi / 2)
    if even:
        return F.coalesce(half, (v > lo).cast("long"))
    one_sign = (lo > 0) | (hi < 0)
    power = F.when(lo > 0, share(F.log2(v), F.log2(lo), F.log2(hi))).otherwise(share(-F.log2(-v), -F.log2(-lo), -F.log2(-hi)))
    wide = F.greatest(F.abs(lo), F.abs(hi)) / 2 > F.least(F.abs(lo), F.abs(hi))
    # the halves of the smallest doubles may be equal; those are few enough to be told from the lowest one by one
    return F.coalesce(F.when(~one_sign, F.signum(v).cast("long")).when(wide, power).otherwise(half), (v > lo).cast("long"))


def order_statistics_of(df: DataFrame, at: dict[str, tuple[float, ...]], groups: tuple[str, ...] = ()) -> dict[tuple, list[list[float | None]]]:
    """Exact percentiles (0 to 100) with linear interpolation of several columns, by group: for each group a list a column of ``at``.

    Missing values and NaN don't count.  Infinite values count at their ends: between a finite and an infinite value a percentile is the
    infinite one, and between both infinities NULL.  The values around each wanted rank are closed in by histograms: a scan counts the parts of
    the intervals that hold a rank, of all columns together, until few values or one are left.  So no task sees a whole column, the driver gets counts
    only, at most ``FEW`` values a rank, and the number of scans is bounded whatever the values.  The groups must be few, as their intervals are planned on the driver.
    """
    keys = [F.col(g).alias(f"g{i}") for i, g in enumerate(groups)]
    names = [*(f"g{i}" for i in range(len(groups))), "c"]
    columns = [F.struct(F.lit(i).alias("c"), F.col(x).cast("double").alias("v")) for i, x in enumerate(at)]
    flat = df.select(*keys, F.inline(F.array(*columns))).where("v is not null and not isnan(v)")
    infinite = F.abs("v") == float("inf")
    found: dict[tuple, list[tuple[int, int, float]]] = {}
    known: dict[tuple, dict[int, float]] = {}
    # open intervals: group and column, lowest and highest value, ranks before it, its values
    open_: dict[tuple, list[tuple[float, float, int, int, list[int]]]] = {}
    ends = [F.min(F.when(~infinite, F.col("v"))).alias("lo"), F.max(F.when(~infinite, F.col("v"))).alias("hi"), F.count(F.lit(1)).alias("n"), F.count_if(infinite & (F.col("v") < 0)).alias("low"), F.count_if(infinite & (F.col("v") > 0)).alias("high")]
    wanted = list(at.values())
    for r in flat.groupBy(*names).agg(*ends).collect():
        key, n = tuple(r[g] for g in names), r["n"]
        places = [(n - 1) * p / 100 for p in wanted[key[-1]]]
        found[key] = [(math.floor(x), min(math.floor(x) + 1, n - 1), x - math.floor(x)) for x in places]
        ranks = {x for low, high, _ in found[key] for x in (low, high)}
        known[key] = {x: -math.inf if x < r["low"] else math.inf for x in ranks if x < r["low"] or x >= n - r["high"]}
        if rest := sorted(ranks - known[key].keys()):
            open_[key] = [(r["lo"], r["hi"], r["low"], n - r["low"] - r["high"], rest)]
    flat = flat.where(~infinite)
    for scan in range(ROUNDS + 1):
        plan = []
        for key, intervals in open_.items():
            for lo, hi, before, n, ranks in intervals:
                if lo == hi:
                    known[key] |= dict.fromkeys(ranks, lo)
                else:
                    plan.append((*key, lo, hi, before, n, ranks))
        if not plan:
            break
        if scan == ROUNDS:
            raise RuntimeError("percentiles need more scans than doubles can ask for")
        schema = T.StructType([*(flat.schema[g] for g in names), T.StructField("lo", T.DoubleType()), T.StructField("hi", T.DoubleType()), T.StructField("i", T.IntegerType())])
        table = _table_of(df.sparkSession, [(*x[: len(names)], x[-5], x[-4], i) for i, x in enumerate(plan)], schema)
        same = F.lit(True)
        for g in names:
            same = same & flat[g].eqNullSafe(table[g])
        inside = flat.join(F.broadcast(table), same & (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi"))).select("i", "v", "lo", "hi")
        small = [i for i, x in enumerate(plan) if x[-2] <= FEW]
        sorted_ = {r["i"]: r["v"] for r in inside.where(F.col("i").isin(small)).groupBy("i").agg(F.sort_array(F.collect_list("v")).alias("v")).collect()} if small else {}
        for i in small:
            key, before = plan[i][: len(names)], plan[i][-3]
            known[key] |= {x: sorted_[i][x - before] for x in plan[i][-1]}
        rest = {}
        if len(small) < len(plan):
            part = _part(F.col("v"), F.col("lo"), F.col("hi"), scan < EVEN_ROUNDS).alias("part")
            counted: dict[int, list] = {}
            for r in inside.where(~F.col("i").isin(small)).groupBy("i", part).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n")).collect():
                counted.setdefault(r["i"], []).append((r["lo"], r["hi"], r["n"]))
            for i, parts in counted.items():
                key, before, ranks = plan[i][: len(names)], plan[i][-3], plan[i][-1]
                for lo, hi, n in sorted(parts):
                    if own := [x for x in ranks if before <= x < before + n]:
                        rest.setdefault(key, []).append((lo, hi, before, n, own))
                    before += n
        open_ = rest
    out: dict[tuple, list[list[float | None]]] = {}
    for (*group, c), ranks in found.items():
        of = known[(*group, c)]
        out.setdefault(tuple(group), [[None] * len(x) for x in wanted])[c] = [_between(of[a], of[b], share) for a, b, share in ranks]
    return out


def _between(a: float, b: float, share: float) -> float | None:
    """Value between two neighbours; an infinite one wins, and there is none between both infinities."""
    if a == b or not share:
        return a
    value = a + (b - a) * share
    return None if math.isinf(a) and math.isinf(b) else value if not math.isnan(value) else a


def order_statistics(df: DataFrame, value: str, at: tuple[float, ...], groups: tuple[str, ...] = ()) -> dict[tuple, list[float | None]]:
    """``order_statistics_of`` one column; groups without a value are left out."""
    return {key: rows[0] for key, rows in order_statistics_of(df, {value: at}, groups).items()}


def percentile_table(df: DataFrame, at: dict[str, dict[float, str]], groups: tuple[str, ...] = ()) -> DataFrame:
    """The groups and the named percentiles of each column, all from the same scans; no value gives NULL, a group without any has no row."""
    rows = order_statistics_of(df, {c: tuple(x) for c, x in at.items()}, groups)
    rows = rows or ({} if groups else {(): [[None] * len(x) for x in at.values()]})
    schema = T.StructType([*(df.schema[g] for g in groups), *(T.StructField(name, T.DoubleType()) for x in at.values() for name in x.values())])
    return _table_of(df.sparkSession, [(*key, *(x for row in values for x in row)) for key, values in rows.items()], schema)


def percentiles(df: DataFrame, value: str, at: tuple[float, ...], positive: bool = False) -> DataFrame:
    """Columns p{at}: exact percentiles by linear interpolation, of all values or the positive ones."""
    names = {a: f"p{a:g}".replace(".", "_") for a in at}
    return percentile_table(df.where(F.col(value) > 0) if positive else df, {value: names})


def moments(df: DataFrame, value: str, groups: tuple[str, ...] = ()) -> DataFrame:
    """Minimum, maximum, mean, population deviation and their ratio (NULL for mean 0)."""
    a = [F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std")]
    return df.groupBy(*groups).agg(*a).withColumn("cv", F.try_divide("std", "mean"))


def slice_profile(df: DataFrame, axis: str, value: str) -> DataFrame:
    return df.groupBy(axis).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))


def resampled(profile: DataFrame, position: str, value: str, n: int) -> DataFrame:
    """A profile of m rows at positions 0..m-1, linearly interpolated at n even places: i, value."""
    size = profile.agg(F.count(F.lit(1)).alias("m"))
    places = profile.sparkSession.range(n).crossJoin(size).select(F.col("id").alias("i"), (F.col("id") * (F.col("m") - 1) / max(n - 1, 1)).alias("x"), "m")
    nearest = lambda c, name: profile.select(F.col(position).cast("long").alias(c), F.col(value).alias(name))
    both = places.withColumn("a", F.floor("x")).withColumn("b", F.least(F.floor("x") + 1, F.col("m") - 1)).join(nearest("a", "va"), "a").join(nearest("b", "vb"), "b")
    return both.select("i", (F.col("va") + (F.col("x") - F.col("a")) * (F.col("vb") - F.col("va"))).alias("value"))


def object_summary(df: DataFrame, size: str, radius: F.Column, groups: tuple[str, ...] = ()) -> DataFrame:
    """count, mean, median, max and total of the sizes, mean and median of the radii, of each of a few groups."""
    own = df.select(*groups, F.col(size).alias("_s"), radius.alias("_r"))
    out = own.groupBy(*groups).agg(F.count(F.lit(1)).alias("count"), F.avg("_s").alias("mean"), F.max("_s").alias("max"), F.sum("_s").alias("total"), F.avg("_r").alias("mean_radius"))
    return _with_percentiles(out, own, {"_s": {50: "median"}, "_r": {50: "median_radius"}}, groups)


def _with_percentiles(out: DataFrame, df: DataFrame, at: dict[str, dict[float, str]], groups: tuple[str, ...]) -> DataFrame:
    table = percentile_table(df, at, groups)
    table = table.toDF(*[f"_{g}" for g in groups], *table.columns[len(groups) :])
    same = F.lit(True)
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    return out.join(F.broadcast(table), same, "left").drop(*[f"_{g}" for g in groups])  # a row for each of the few groups


def described(df: DataFrame, value: str, group: str) -> DataFrame:
    """count, mean, std, min, quartiles and max of a column for each of a few groups."""
    out = df.groupBy(group).agg(F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"))
    return _with_percentiles(out, df, {value: {25: "q25", 50: "q50", 75: "q75"}}, (group,)).select(group, "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def histogram_between(df: DataFrame, value: str, lo: float, hi: float, width: float, source: DataFrame | None = None, most: int = 1 << 20) -> DataFrame:
    """Histogram between two percentiles (of ``source``, such as a coarser image, or else of ``df``) with bins of about ``width``, at most ``most`` of them."""
    low, high = order_statistics(df if source is None else source, value, (lo, hi))[()]
    return histogram(df, value, low, high, min(most, bins_by_width(low, high, width)))


def threshold_sweep(df: DataFrame, value: str, n: int = 10, lo: float = 1.0, hi: float = 99.0, groups: tuple[str, ...] = ()) -> DataFrame:
    """step, threshold, n_voxels, n_foreground and fraction of each of ``n`` thresholds, evenly between two percentiles of all values.

    Foreground is strictly above the threshold.  ``groups`` may name crops, which are counted apart.  One scan after the percentiles; no values give no rows.
    """
    low, high = order_statistics(df, value, (lo, hi)).get((), (None, None))
    if low is None:
        return df.select(*groups).limit(0).selectExpr("*", "0 as step", "0D as threshold", "0L as n_voxels", "0L as n_foreground", "0D as fraction")
    at = [low + (high - low) * i / max(n - 1, 1) for i in range(n)]
    counts = df.where(F.col(value).isNotNull()).groupBy(*groups).agg(F.count(F.lit(1)).alias("n_voxels"), F.array(*[F.count_if(F.col(value) > t) for t in at]).alias("above"))
    steps = F.posexplode(F.arrays_zip(F.array(*[F.lit(t) for t in at]).alias("threshold"), F.col("above").alias("n_foreground"))).alias("step", "s")
    out = counts.select(*groups, "n_voxels", steps).select(*groups, "step", "s.threshold", "n_voxels", "s.n_foreground")
    return out.withColumn("fraction", F.col("n_foreground") / F.col("n_voxels"))


def tuning_report(images: DataFrame, settings: tuple[str, ...], value: str, at: tuple[float, ...] = (50, 99)) -> DataFrame:
    """Moments, coefficient of variation and percentiles of the image of each combination of settings (``images`` has a row a voxel)."""
    names = {a: f"p{a:g}" for a in at}
    return _with_percentiles(moments(images, value, settings), images, {value: names}, settings)


def tuning_grid(spark: SparkSession, **choices: list) -> DataFrame:
    """All combinations of settings in the order of ``choices``, numbered from 0 as ``combo``."""
    rows = list(itertools.product(*choices.values()))
    return spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], ["combo", *choices])


def paired_by_position(left: DataFrame, right: DataFrame, order_left: list[str], order_right: list[str]) -> DataFrame:
    """The n-th row of one table beside the n-th of the other, each in its order; the longer table's rest is left out."""
    from .graph import dense_ids

    return dense_ids(left, order_left, "position").join(dense_ids(right, order_right, "position"), "position")


def block_mean(voxels: DataFrame, factor: int, value: str, axes: tuple[str, ...] = ("vx", "vy", "vz")) -> DataFrame:
    """Mean of the voxels that each block of ``factor`` voxels a side has; blocks at the edge have fewer."""
    if factor < 1:
        raise ValueError("the target level must not be finer than the source level")
    return voxels.groupBy(*[F.floor(F.col(a) / factor).cast("long").alias(a) for a in axes]).agg(F.avg(value).alias(value))


def projection(voxels: DataFrame, keep: tuple[str, ...], value: str) -> DataFrame:
    """Maximum intensity along the axes that are not kept."""
    return voxels.groupBy(*keep).agg(F.max(value).alias(value))


def accumulated(voxels: DataFrame, value: str, axes: tuple[str, ...] = ("vx", "vy", "vz")) -> DataFrame:
    """Sum of several images, voxel by voxel."""
    return voxels.groupBy(*axes).agg(F.sum(value).alias(value))


def stretched(df: DataFrame, value: str, lo: float = 1.0, hi: float = 99.5, out: str = "scaled", top: float = 255.0, positive: bool = False, log: bool = False) -> DataFrame:
    """Values between two percentiles on a scale of 0 to ``top``, rounded half to even; optionally of ln(v + 1) or with percentiles of positive values only."""
    from ..functions.expressions import clamp_unit

    source = df.withColumn("_v", F.log1p(value) if log else F.col(value))
    limits = percentiles(source, "_v", (lo, hi), positive).toDF("_lo", "_hi")  # one row
    return source.crossJoin(F.broadcast(limits)).withColumn(out, F.rint(clamp_unit(F.col("_v"), F.col("_lo"), F.col("_hi")) * top)).drop("_v", "_lo", "_hi")
