"""Quantiles and extremes of groups inside a task, on arrays, with the rules of Spark's own aggregates."""

from __future__ import annotations

import numpy as np


class Groups:
    """Values of the groups 0 to ``size``, ordered once for all quantiles."""

    def __init__(self, k: np.ndarray, values: np.ndarray, size: int):
        self.values = values[np.lexsort((values, k))]
        self.n = np.bincount(k, minlength=size)
        self.begin = np.cumsum(self.n) - self.n

    def at(self, q: float) -> np.ndarray:
        """The quantile of each group, between its neighbours by their distance; NaN where a group has no value."""
        out, some = np.full(len(self.n), np.nan), self.n > 0
        place, begin = (self.n[some] - 1) * q, self.begin[some]
        low, high = np.floor(place), np.ceil(place)
        a, b = self.values[begin + low.astype(np.int64)], self.values[begin + high.astype(np.int64)]
        out[some] = np.where(a == b, a, (high - place) * a + (place - low) * b)
        return out


def most(k: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """The largest known value of each group; NaN where there is none."""
    out, known = np.full(size, -np.inf), ~np.isnan(values)
    np.maximum.at(out, k[known], values[known])
    return np.where(np.isinf(out), np.nan, out)


def rounded(x: np.ndarray, places: int) -> np.ndarray:
    """``semantics.rnd`` on an array: halves away from zero after scaling."""
    size = np.abs(x * 10.0**places)
    return np.copysign(np.floor(size) + (size - np.floor(size) >= 0.5), x) / 10.0**places
