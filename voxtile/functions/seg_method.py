"""The names of segmentation methods, and thresholds from a histogram on the driver (at most as many bins as its maker allows)."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Method:
    kind: str  # threshold, otsu or gmm
    value: float = 0.0  # threshold, or deviations above the brightest mean
    classes: int = 0
    index: int = 0


def parse_method(text: str) -> Method:
    """``th<value>``, ``otsu+k<classes>i<index>`` or ``gmm+n<classes>k<deviations>``; p stands for the decimal point."""
    number = lambda x: float(x.replace("p", "."))
    if m := re.fullmatch(r"th(\d+(?:[.p]\d+)?)", text):
        return Method("threshold", number(m[1]))
    if m := re.fullmatch(r"otsu\+k(\d+)i(\d+)", text):
        return Method("otsu", classes=int(m[1]), index=int(m[2]))
    if m := re.fullmatch(r"gmm\+n(\d+)k(\d+(?:p\d+)?)", text):
        return Method("gmm", number(m[2]), int(m[1]))
    raise ValueError(f"unknown segmentation method {text!r}")


def _best_starts(gain, before: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """For each end b the start a < b with the largest before[a] + gain(a, b) (the first of equal ones), and that value; starts below ``first`` are not open.

    The best start never falls as the end grows, so the ends are halved level by level: an end looks only between the best starts of
    its neighbours that are known.  A level looks at about as many starts as there are ends, all at once.
    """
    n = len(before)
    start, value = np.full(n, -1, np.int64), np.full(n, -np.inf)
    ends = np.arange(n)
    low, high = np.array([first + 1]), np.array([n - 1])  # open ends, and between which starts they look
    from_, to = np.array([first]), np.array([n - 1])
    while len(low):
        some = low <= high
        low, high, from_, to = low[some], high[some], from_[some], to[some]
        if not len(low):
            break
        mid = (low + high) // 2
        last = np.minimum(to, mid - 1)
        size = last - from_ + 1
        head = np.cumsum(size) - size
        a = np.arange(size.sum()) - np.repeat(head, size) + np.repeat(from_, size)
        x = before[a] + gain(a, np.repeat(ends[mid], size))
        best = np.maximum.reduceat(x, head)
        at = np.flatnonzero(x == np.repeat(best, size))
        own = a[at[np.searchsorted(at, head)]]
        start[mid], value[mid] = own, best
        low, high = np.concatenate([low, mid + 1]), np.concatenate([mid - 1, high])
        from_, to = np.concatenate([from_, own]), np.concatenate([own, to])
    return start, value


def otsu_thresholds(centers: np.ndarray, counts: np.ndarray, classes: int) -> list[float]:
    """Bin centres after which a class ends, so that the variance between the classes is largest.

    Dynamic programming over the bins that have values; what a class adds is such that the best cuts move one way only, so the
    time grows as classes times n log n and the memory as n.  With fewer such bins than classes the last threshold is repeated.
    """
    if not 2 <= classes <= len(centers):
        raise ValueError("classes must be between 2 and the number of bins")
    full = np.flatnonzero(counts > 0)
    centers, counts = centers[full], counts[full]
    n = len(full)
    if n < classes:
        some = centers[: max(n - 1, 1)].tolist() or [float("nan")]
        return [*some, *[some[-1]] * (classes - 1 - len(some))]
    middle = np.average(centers, weights=counts)  # keeps the sums small
    mass, first = np.concatenate([[0.0], np.cumsum(counts)]), np.concatenate([[0.0], np.cumsum(counts * (centers - middle))])

    def gain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (first[b] - first[a]) ** 2 / (mass[b] - mass[a])

    best = np.full(n + 1, -np.inf)
    best[1:] = gain(np.zeros(n, int), np.arange(1, n + 1))
    rows = []
    for k in range(1, classes):
        start, best = _best_starts(gain, best, k)
        rows.append(start)
    cut, out = n, []
    for row in reversed(rows):
        cut = int(row[cut])
        out.append(float(centers[cut - 1]))
    return out[::-1]


def gmm_tail(centers: np.ndarray, counts: np.ndarray, components: int, deviations: float, rounds: int = 200) -> float:
    """Mean plus ``deviations`` standard deviations of the brightest component of a mixture fitted to the histogram (weighted EM)."""
    keep = counts > 0
    x, w = centers[keep].astype(float), counts[keep].astype(float)
    w = w / w.sum()
    spread = np.cumsum(w)
    mean = np.interp((np.arange(components) + 0.5) / components, spread, x)
    floor = max((x.max() - x.min()) ** 2 * 1e-8, 1e-12)
    var, part = np.full(components, max(np.average((x - np.average(x, weights=w)) ** 2, weights=w), floor)), np.full(components, 1 / components)
    for _ in range(rounds):
        log_p = np.log(part) - 0.5 * np.log(2 * np.pi * var) - 0.5 * (x[:, None] - mean) ** 2 / var
        r = np.exp(log_p - log_p.max(axis=1, keepdims=True))
        r = r / r.sum(axis=1, keepdims=True) * w[:, None]
        size = r.sum(axis=0) + 1e-300
        new = (r * x[:, None]).sum(axis=0) / size
        var = np.maximum((r * (x[:, None] - new) ** 2).sum(axis=0) / size, floor)
        part = np.maximum(size / size.sum(), 1e-12)
        done = np.abs(new - mean).max() < 1e-9 * (1 + np.abs(mean).max())
        mean = new
        if done:
            break
    top = int(mean.argmax())
    return float(mean[top] + deviations * np.sqrt(var[top]))
