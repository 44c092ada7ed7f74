"""Model formulas and the t distribution, for fits of one small group at a time."""

from __future__ import annotations

import itertools
import math
import re

import numpy as np
import pandas as pd


_QUOTED = r"Q\(\s*(?:'[^']*'|\"[^\"]*\"|[^()'\"]*)\s*\)"
_TOKEN = re.compile(rf"C\(\s*(?:{_QUOTED}|'[^']*'|\"[^\"]*\"|[^()'\"]*)\s*\)|{_QUOTED}|[A-Za-z_][\w.]*|[-+*:01]|\s+")


def _split(tokens: list[str], mark: str) -> list[list[str]]:
    out: list[list[str]] = [[]]
    for t in tokens:
        if t == mark:
            out.append([])
        else:
            out[-1].append(t)
    return out


def name_of(part: str) -> tuple[str, bool]:
    """Column of a part of a term, ``C(..)`` and ``Q('..')`` taken off, and whether it is categorical."""
    category = re.fullmatch(r"C\((.*)\)", part)
    inner = (category[1] if category else part).strip()
    quoted = re.fullmatch(r"Q\((.*)\)", inner)
    return (quoted[1] if quoted else inner).strip().strip("'\""), bool(category)


def parse(formula: str) -> tuple[str, bool, list[tuple[str, ...]]]:
    """Response, intercept and terms of ``y ~ C(a)*C(b) + age``; a term is a tuple of factors, C(x) or a numeric column."""
    response, _, right = formula.partition("~")
    intercept, terms = True, []
    tokens = [m[0] for m in _TOKEN.finditer(right) if not m[0].isspace()]
    if "".join(m[0] for m in _TOKEN.finditer(right)) != right:
        raise ValueError(f"formula not understood: {formula!r}")
    sign, group = 1, []

    def close() -> None:
        nonlocal intercept, group
        if group in (["1"], ["0"]):
            intercept = (group == ["1"]) == (sign > 0)
        elif group:
            parts = [tuple(x for x in own if x != ":") for own in _split(group, "*")]
            for size in range(1, len(parts) + 1):
                for chosen in itertools.combinations(parts, size):
                    term = tuple(dict.fromkeys(sum(chosen, ())))
                    if sign > 0 and term not in terms:
                        terms.append(term)
                    elif sign < 0 and term in terms:
                        terms.remove(term)
        group = []

    for t in tokens:
        if t in "+-":
            close()
            sign = 1 if t == "+" else -1
        else:
            group.append(t)
    close()
    return response.strip(), intercept, sorted(terms, key=len)


def variables(terms: list[tuple[str, ...]]) -> dict[str, bool]:
    """Column names, and whether each is categorical."""
    out: dict[str, bool] = {}
    for part in itertools.chain(*terms):
        name, category = name_of(part)
        out[name] = category
    return out


class Design:
    """Treatment-coded design columns, with the levels of the rows it was made from."""

    def __init__(self, frame: pd.DataFrame, intercept: bool, terms: list[tuple[str, ...]]):
        self.intercept, self.terms, self.kinds = intercept, terms, variables(terms)
        self.levels = {k: sorted(frame[k].astype(str).unique()) for k, cat in self.kinds.items() if cat}

    def matrix(self, frame: pd.DataFrame) -> np.ndarray:
        columns = [np.ones(len(frame))] if self.intercept else []
        full = not self.intercept
        for term in self.terms:
            parts = []
            for part in term:
                name, _ = name_of(part)
                if self.kinds[name]:
                    levels = self.levels[name] if full and len(term) == 1 else self.levels[name][1:]
                    full = full and len(term) > 1
                    parts.append([(frame[name].astype(str) == x).to_numpy(float) for x in levels])
                else:
                    parts.append([frame[name].to_numpy(float)])
            columns += [np.prod(x, axis=0) for x in itertools.product(*parts)]
        return np.column_stack(columns) if columns else np.empty((len(frame), 0))


def t_two_sided(t: float, df: float) -> float:
    """Two-sided p value of Student's t, from the continued fraction of the incomplete beta function."""
    if not math.isfinite(t) or df <= 0:
        return math.nan
    a, b, x = df / 2, 0.5, df / (df + t * t)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(max(x, 1e-300)) + b * math.log(max(1 - x, 1e-300)))

    def fraction(a: float, b: float, x: float) -> float:
        tiny, c, d = 1e-300, 1.0, 1 - (a + b) * x / (a + 1)
        d = 1 / (d if abs(d) > tiny else tiny)
        h = d
        for m in range(1, 500):
            for n in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d = 1 + n * d
                d = 1 / (d if abs(d) > tiny else tiny)
                c = 1 + n / c
                c = c if abs(c) > tiny else tiny
                h *= d * c
            if abs(d * c - 1) < 1e-15:
                break
        return h

    if x == 0:
        return 0.0
    if x == 1:
        return 1.0
    return front * fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * fraction(b, a, 1 - x) / b


def least_squares(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Coefficients, (X'X)+, residual variance and residual degrees of freedom, by the pseudo-inverse."""
    inverse = np.linalg.pinv(x)
    beta = inverse @ y
    df = len(y) - int(np.linalg.matrix_rank(x))
    rest = float(((y - x @ beta) ** 2).sum())
    return beta, inverse @ inverse.T, rest / df if df > 0 else math.nan, df
