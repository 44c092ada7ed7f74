"""Group statistics of regions: contrasts, closed-form and fitted tests, reference rows and matrices."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import col, minus_log10
from ..functions.formula import Design, name_of, parse, t_two_sided, variables


@dataclass(frozen=True)
class Contrast:
    factor: str
    level_a: str
    level_b: str
    strata: dict[str, str] = field(default_factory=dict)

    @property
    def label(self) -> str:
        """``factor+AvsB``, then ``+column-value`` for each stratum."""
        return f"{self.factor}+{self.level_a}vs{self.level_b}" + "".join(f"+{k}-{v}" for k, v in self.strata.items())


def contrast_table(cohort: DataFrame, factor: str, within: tuple[str, ...] = ()) -> DataFrame:
    """factor, level_a, level_b and a column for each stratum: all pairs of levels, a < b as text, in all combinations of strata."""
    levels = cohort.select(col(factor).cast("string").alias("level")).where("level is not null").distinct()
    out = levels.withColumnRenamed("level", "level_a").join(levels.withColumnRenamed("level", "level_b"), F.col("level_a") < F.col("level_b"))
    for w in within:
        out = out.crossJoin(cohort.select(col(w).cast("string").alias(w)).where(col(w).isNotNull()).distinct())
    return out.select(F.lit(factor).alias("factor"), "level_a", "level_b", *[col(w) for w in within])


def contrasts(cohort: DataFrame, factor: str, within: tuple[str, ...] = ()) -> list[Contrast]:
    """The same as a list, for planning.  ValueError for a missing column or fewer than two levels."""
    if missing := [c for c in (factor, *within) if c not in cohort.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    rows = contrast_table(cohort, factor, within).orderBy("level_a", "level_b", *[col(w) for w in within]).collect()
    if not rows:
        raise ValueError(f"{factor} has fewer than 2 levels")
    return [Contrast(factor, r["level_a"], r["level_b"], {w: r[w] for w in within}) for r in rows]


def unpivoted(df: DataFrame, keys: list[str], metrics: list[str], extra: list[str]) -> DataFrame:
    """keys, metric, value and the extra columns: a row for each metric; a metric that is not a column is NULL."""
    value = lambda m: col(m).cast("double") if m in df.columns else F.lit(None).cast("double")
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), value(m).alias("value")) for m in metrics])
    return df.select(*[col(k) for k in (*keys, *extra)], F.inline(pairs))


def two_level_tests(long: DataFrame, keys: list[str], factor: str, pairs: DataFrame) -> DataFrame:
    """For each group of ``keys`` and pair of levels: n, means, t (variance pooled over all levels), df and Cohen's d.

    The same t as the contrast of an ordinary least-squares fit of value ~ C(factor).  NULL statistics where a level has fewer than two
    values.  One aggregation by level, then a join of the level rows; only built-in functions.
    """
    v = F.col("value")
    level = col(factor).cast("string")
    cells = long.where(v.isNotNull() & level.isNotNull()).groupBy(*keys, level.alias("level")).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.coalesce(F.var_samp(v), F.lit(0.0)).alias("var"))
    w = Window.partitionBy(*keys)
    cells = cells.withColumns({"_rest": F.sum((F.col("n") - 1) * F.col("var")).over(w), "_df": F.sum(F.col("n") - 1).over(w)})
    side = lambda s: cells.select(*keys, *[F.col(c).alias(f"{c}_{s}") for c in ("level", "n", "mean", "var")], *(["_rest", "_df"] if s == "a" else []))
    both = side("a").join(pairs.select("level_a", "level_b"), "level_a").join(side("b"), [*keys, "level_b"])
    ok = (F.col("n_a") >= 2) & (F.col("n_b") >= 2)
    scale = F.sqrt(F.try_divide("_rest", "_df") * (1 / F.col("n_a") + 1 / F.col("n_b")))
    own = F.sqrt(((F.col("n_a") - 1) * F.col("var_a") + (F.col("n_b") - 1) * F.col("var_b")) / (F.col("n_a") + F.col("n_b") - 2))
    diff = F.col("mean_a") - F.col("mean_b")
    return both.select(
        *keys, "level_a", "level_b", "n_a", "n_b", "mean_a", "mean_b", F.when(ok, F.try_divide(diff, scale)).alias("tstat"), F.col("_df").alias("df"),
        F.when(ok & (own > 0), F.try_divide(diff, own)).alias("cohensd"))


_FIT = "contrast string, n_a long, n_b long, mean_a double, mean_b double, tstat double, pval double, cohensd double, nobs long, r2 double"


def _solved(xx: np.ndarray, xy: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Coefficients, (X'X)+ and rank from X'X and X'y."""
    if not len(xx):
        return np.zeros(0), xx, 0
    scale = np.sqrt(np.where(np.diag(xx) > 0, np.diag(xx), 1.0))
    even = xx / np.outer(scale, scale)
    rank = int(np.linalg.matrix_rank(even, tol=1e-11 * len(xx), hermitian=True))
    spread = np.linalg.inv(even) / np.outer(scale, scale) if rank == len(xx) else np.linalg.pinv(xx, rcond=1e-13, hermitian=True)
    return spread @ xy, spread, rank


def fitted_contrasts(long: DataFrame, keys: list[str], formula: str, wanted: list[Contrast]) -> DataFrame:
    """Fit ``formula`` in each group of ``keys`` once and evaluate every contrast on it.

    ``long`` has the keys, value and the model's columns; the left side of the formula stands for value, whatever its name.  Covariates stand at their mean and other factors at their mode (smallest of
    ties) over the group's rows.  Rows with a missing variable are left out of the fit; levels compare as text.  Statistics are NULL where a
    level has fewer than two values, no row of a level or stratum is left in the fit, or the fit fails.  Rows are summed by group and combination of levels, with sums of products of the
    covariates and the value; only these sums meet in one task, where the normal equations of a group are solved.
    """
    _, intercept, terms = parse(formula)
    kinds = variables(terms)
    numbers = [c for c, cat in kinds.items() if not cat]
    factors = sorted({c for c, cat in kinds.items() if cat} | {c for x in wanted for c in (x.factor, *x.strata)})
    powers = sorted({(0,) * len(numbers), *(tuple(sum(name_of(p) == (c, False) for p in term) for c in numbers) for term in terms)})
    schema = T.StructType([*[long.schema[k] for k in keys], *T._parse_datatype_string(_FIT).fields])

    real = lambda c: F.when(~F.isnan(col(c).cast("double")), col(c).cast("double"))
    flat = long.select(*[col(k).alias(f"_k{i}") for i, k in enumerate(keys)], real("value").alias("_v"), *[col(c).cast("string").alias(f"_f{i}") for i, c in enumerate(factors)], *[real(c).alias(f"_q{i}") for i, c in enumerate(numbers)])
    v, q = F.col("_v"), [F.col(f"_q{i}") for i in range(len(numbers))]
    good = v.isNotNull()
    for x in [*q, *(F.col(f"_f{i}") for i, c in enumerate(factors) if c in kinds)]:
        good = good & x.isNotNull()
    part = []
    for p in powers:
        m = F.lit(1.0)
        for x, k in zip(q, p):
            for _ in range(k):
                m = m * x
        part.append(m)
    total = lambda x: F.coalesce(F.sum(F.when(good, x)), F.lit(0.0))
    sums = [total(part[i] * part[j]).alias(f"_xx{i}_{j}") for i in range(len(part)) for j in range(i, len(part))] + [total(m * v).alias(f"_xy{i}") for i, m in enumerate(part)]
    sums += [total(v * v).alias("_yy"), F.count(F.when(good, v)).alias("_good"), F.count(F.lit(1)).alias("_rows"), F.count(v).alias("_n"), F.avg(v).alias("_mean"), F.var_pop(v).alias("_var")]
    sums += [x for i, c in enumerate(q) for x in (F.count(c).alias(f"_qn{i}"), F.sum(c).alias(f"_qs{i}"))]
    heads = [f"_k{i}" for i in range(len(keys))]
    cells = flat.groupBy(*heads, *[f"_f{i}" for i in range(len(factors))]).agg(*sums)

    def moments(pdf: pd.DataFrame) -> tuple[int, float, float]:
        """n, mean and sum of squares about the mean of the values of some cells."""
        pdf = pdf[pdf["_n"] > 0]
        n = int(pdf["_n"].sum())
        mean = float((pdf["_n"] * pdf["_mean"]).sum() / n) if n else math.nan
        return n, mean, float((pdf["_n"] * (pdf["_var"] + (pdf["_mean"] - mean) ** 2)).sum())

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        head = {k: pdf[h].iloc[0] for k, h in zip(keys, heads)}
        pdf = pdf.rename(columns={f"_f{i}": c for i, c in enumerate(factors)})
        rows_of = pdf[pdf["_good"] > 0]
        result = None
        if len(rows_of):
            design = Design(rows_of, intercept, terms)
            one = design.matrix(rows_of.assign(**{c: 1.0 for c in numbers}))
            height = np.abs(one).max(axis=0, initial=0)
            power = [np.round(np.log2(np.where(height > 0, np.abs(design.matrix(rows_of.assign(**{x: 2.0 if x == c else 1.0 for x in numbers}))).max(axis=0, initial=0), 1))).astype(int) for c in numbers]
            of = [powers.index(tuple(int(p[j]) for p in power)) if height[j] > 0 else 0 for j in range(one.shape[1])]
            at = lambda i, j: rows_of[f"_xx{min(i, j)}_{max(i, j)}"].to_numpy(float)
            size = one.shape[1]
            xx = np.array([[float((one[:, a] * one[:, b] * at(of[a], of[b])).sum()) for b in range(size)] for a in range(size)]).reshape(size, size)
            xy = np.array([float((one[:, a] * rows_of[f"_xy{of[a]}"].to_numpy(float)).sum()) for a in range(size)])
            beta, spread, rank = _solved(xx, xy)
            n, yy, y = int(rows_of["_good"].sum()), float(rows_of["_yy"].sum()), float(rows_of[f"_xy{powers.index((0,) * len(numbers))}"].sum())
            rest, whole, df = max(yy - float(beta @ xy), 0.0), yy - y * y / n, n - rank
            if rest <= 1e-13 * yy:
                rest = 0.0
            result = (design, beta, spread, rest / df if df > 0 else math.nan, df, n, 1 - rest / whole if whole > 1e-13 * yy else math.nan)
        reference = {}
        for i, c in enumerate(numbers):
            reference[c] = float(pdf[f"_qs{i}"].sum() / pdf[f"_qn{i}"].sum()) if pdf[f"_qn{i}"].sum() else math.nan
        for c in (c for c, cat in kinds.items() if cat):
            many = pdf.dropna(subset=[c]).groupby(c)["_rows"].sum()
            reference[c] = min(many[many == many.max()].index) if len(many) else None
        rows = []
        for c in wanted:
            stratum = np.ones(len(pdf), bool)
            for k, x in c.strata.items():
                stratum &= (pdf[k] == x).to_numpy()
            (na, ma, sa), (nb, mb, sb) = (moments(pdf[stratum & (pdf[c.factor] == x).to_numpy()]) for x in (c.level_a, c.level_b))
            row = head | {"contrast": c.label, "n_a": na, "n_b": nb, "mean_a": ma if na else None, "mean_b": mb if nb else None}
            fitted = result and all(x in result[0].levels[k] for x in (c.level_a, c.level_b) for k, x in (c.strata | {c.factor: x}).items() if k in result[0].levels)
            if na > 1 and nb > 1 and fitted:
                design, beta, spread, variance, df, n, r2 = result
                d = design.matrix(pd.DataFrame([reference | c.strata | {c.factor: x} for x in (c.level_a, c.level_b)]))
                step = d[0] - d[1]
                error = math.sqrt(max(variance * float(step @ spread @ step), 0.0)) if df > 0 else 0.0
                pooled = math.sqrt((sa + sb) / (na + nb - 2))
                t = float(step @ beta) / error if error > 0 else math.nan
                row |= {"tstat": t, "pval": t_two_sided(t, df), "cohensd": (ma - mb) / pooled if pooled > 0 else None, "nobs": n, "r2": r2}
            rows.append(row)
        out = pd.DataFrame(rows, columns=[f.name for f in schema.fields])
        return out.astype(object).where(out.notna(), None)

    return cells.groupBy(*heads).applyInPandas(fit, schema)


def widened(stats: DataFrame, keys: list[str], metrics: list[str], level_a: str, level_b: str) -> DataFrame:
    """One row a region: ``{metric}_mean_{A}``, ``_mean_{B}``, ``_tstat``, ``_pval``, ``_cohensd``; n_{A} and n_{B} are those of the last metric."""
    pick = lambda m, c: F.max(F.when(F.col("metric") == m, F.col(c)))
    names = {"mean_a": f"mean_{level_a}", "mean_b": f"mean_{level_b}", "tstat": "tstat", "pval": "pval", "cohensd": "cohensd"}
    columns = [pick(metrics[-1], n).alias(f"n_{x}") for n, x in (("n_a", level_a), ("n_b", level_b))]
    columns += [pick(m, c).alias(f"{m}_{n}") for m in metrics for c, n in names.items() if c in stats.columns]
    return stats.groupBy(*keys).agg(*columns)


def reference_row(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Mean of numbers and mode of text (smallest of ties) of each group."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.groupBy(*keys).agg(*[(F.avg(col(c)) if isinstance(kinds[c], T.NumericType) else F.mode(col(c), True)).alias(c) for c in columns])


def heatmap_matrix(stats: DataFrame, p: str = "pval", t: str = "tstat", cap: float = 3.0) -> DataFrame:
    """Add significance, -log10(p) from 0 to ``cap``, t with 0 for missing, and the symmetric bound of t over all rows."""
    value = F.coalesce(t, F.lit(0.0))
    out = stats.withColumn("significance", F.least(minus_log10(F.col(p)), F.lit(cap))).withColumn("t_value", value)
    bound = out.agg(F.max(F.abs("t_value")).alias("t_bound"))
    return out.crossJoin(F.broadcast(bound))

