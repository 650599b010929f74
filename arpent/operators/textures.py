"""Textures of grey levels in a square window, on halo tiles: pairs of levels at a shift, and runs of one level along rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from arpent.operators.tiles import Tile, on_tiles, shifted, shrunk, square, window_sum

SIMPLE = ("energy", "entropy", "correlation", "idm", "inertia", "cluster_shade", "cluster_prominence", "haralick_correlation")
ADVANCED = ("mean_", "variance_", "dissimilarity", "sum_average", "sum_variance", "sum_entropy", "difference_entropy", "difference_variance", "ic1", "ic2")
RUNS = ("short_runs", "long_runs", "level_nonuniformity", "run_nonuniformity", "run_percentage", "low_levels", "high_levels", "short_low", "short_high", "long_low", "long_high")

#: Pixels on a side of a tile: a step holds an array for each pair of levels.
WIDTH = 128


def levels(a: np.ndarray, bins: int, low: float, high: float) -> np.ndarray:
    """Equal bins of a span, values beyond in the outer ones; -1 for no value."""
    found = np.clip(np.floor((a - low) / (high - low) * bins), 0, bins - 1)
    return np.where(np.isnan(found), -1, found).astype(int)


def _entropy(p: np.ndarray) -> np.ndarray:
    """Along the first axis, natural logarithm; nothing for 0."""
    return -(p * np.log(np.where(p > 0, p, 1))).sum(axis=0)


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """0 where b is 0, but for rounding."""
    return np.where(np.abs(b) > 1e-12, a / np.where(np.abs(b) > 1e-12, b, 1), 0.0)


def pair_moments(p: np.ndarray, names: list[str]) -> dict[str, np.ndarray]:
    """Moments of the shares p[i, j] of level pairs."""
    n = len(p)
    i, j = (k.reshape(n, n, *[1] * (p.ndim - 2)) for k in np.mgrid[:n, :n])
    total = lambda x: (x * p).sum(axis=(0, 1))
    level = np.arange(n).reshape(n, *[1] * (p.ndim - 2))
    px, py = p.sum(axis=1), p.sum(axis=0)
    mean = total(i)
    variance = total((i - mean) ** 2)
    sums = np.stack([p[(i + j)[:, :, *[0] * (p.ndim - 2)] == k].sum(axis=0) for k in range(2 * n - 1)])
    gaps = np.stack([p[np.abs(i - j)[:, :, *[0] * (p.ndim - 2)] == k].sum(axis=0) for k in range(n)])
    up = np.arange(2 * n - 1).reshape(-1, *[1] * (p.ndim - 2))
    whole = _entropy(p.reshape(n * n, *p.shape[2:]))
    product = px[:, None] * py[None, :]
    log_product = np.log(np.where(product > 0, product, 1))
    sum_average = (up * sums).sum(axis=0)
    gap_mean = (level * gaps).sum(axis=0)
    of = {
        "energy": lambda: (p * p).sum(axis=(0, 1)),
        "entropy": lambda: whole,
        "correlation": lambda: _ratio(total((i - mean) * (j - mean)), variance),
        "idm": lambda: total(1 / (1.0 + (i - j) ** 2)),
        "inertia": lambda: total((i - j) ** 2),
        "cluster_shade": lambda: total((i + j - 2 * mean) ** 3),
        "cluster_prominence": lambda: total((i + j - 2 * mean) ** 4),
        "haralick_correlation": lambda: _ratio(total(i * j) - px.mean(axis=0) ** 2, px.var(axis=0)),
        "mean_": lambda: mean,
        "variance_": lambda: variance,
        "dissimilarity": lambda: total(np.abs(i - j)),
        "sum_average": lambda: sum_average,
        "sum_variance": lambda: ((up - sum_average) ** 2 * sums).sum(axis=0),
        "sum_entropy": lambda: _entropy(sums),
        "difference_entropy": lambda: _entropy(gaps),
        "difference_variance": lambda: ((level - gap_mean) ** 2 * gaps).sum(axis=0),
        "ic1": lambda: _ratio(whole + (p * log_product).sum(axis=(0, 1)), np.maximum(_entropy(px), _entropy(py))),
        "ic2": lambda: np.sqrt(np.maximum(0.0, 1 - np.exp(-2 * (-(product * log_product).sum(axis=(0, 1)) - whole)))),
    }
    return {k: of[k]() for k in names}


def cooccurrence(px: DataFrame, value: str, bins: int, low: float, high: float, radius: int, shift: tuple[int, int] = (0, 1), names: tuple[str, ...] = SIMPLE) -> DataFrame:
    """px with moments of grey-level pairs: of the pixels in a square window, each with the one at a shift.

    Entropies are natural. A pair needs both pixels; without pairs all moments are null. Where a variance is 0, what is
    divided by it is 0.
    """
    margin = max(abs(shift[0]), abs(shift[1]))

    def kernel(tile: Tile):
        a = levels(tile.grid(value), bins, low, high)
        first, second = shrunk(a, margin), shifted(a, *shift, margin)
        pair = np.where((first >= 0) & (second >= 0), first * bins + second, -1)
        n = shrunk(pair, radius).shape
        counts = np.zeros((bins * bins, *n))
        for k in np.unique(pair[pair >= 0]):
            counts[k] = np.rint(window_sum((pair == k).astype(float), square(radius)))
        total = counts.sum(axis=0)
        p = (counts / np.maximum(total, 1)).reshape(bins, bins, *n)
        return {k: np.where(total > 0, v, np.nan) for k, v in pair_moments(p, list(names)).items()}

    return on_tiles(px, [value], radius + margin, kernel, dict.fromkeys(names, "double"), WIDTH)


def run_lengths(px: DataFrame, value: str, bins: int, low: float, high: float, radius: int, names: tuple[str, ...] = RUNS) -> DataFrame:
    """px with moments of the runs of one grey level along the rows of a square window, cut at the window.

    Levels and lengths count from 1; run_percentage is runs over pixels of the window.
    """

    def kernel(tile: Tile):
        a = levels(tile.grid(value), bins, low, high)
        rows, width = a.shape[0], a.shape[1] - 2 * radius
        end = np.broadcast_to(np.arange(a.shape[1]), a.shape).copy()
        for x in range(a.shape[1] - 2, -1, -1):
            same = a[:, x] == a[:, x + 1]
            end[same, x] = end[same, x + 1]
        last = np.arange(width) + 2 * radius
        sums = {k: np.zeros((rows, width)) for k in ("runs", "pixels", *names)}
        by_level, by_length = np.zeros((bins, rows, width)), np.zeros((2 * radius + 1, rows, width))
        for o in range(2 * radius + 1):
            own = a[:, o : o + width]
            start = own >= 0
            sums["pixels"] += start
            if o:
                start = start & (own != a[:, o - 1 : o - 1 + width])
            i, j = np.maximum(own, 0) + 1.0, np.minimum(end[:, o : o + width], last) - np.arange(o, o + width) + 1.0
            sums["runs"] += start
            for k, x in (("short_runs", j**-2), ("long_runs", j**2), ("low_levels", i**-2), ("high_levels", i**2), ("short_low", (i * j) ** -2), ("short_high", (i / j) ** 2), ("long_low", (j / i) ** 2), ("long_high", (i * j) ** 2)):
                sums[k] += np.where(start, x, 0)
            for k in range(bins):
                by_level[k] += start & (own == k)
            for k in range(2 * radius + 1):
                by_length[k] += start & (j == k + 1)
        down = lambda x: window_sum(np.pad(x, ((0, 0), (radius, radius))), [(d, 0) for d in range(-radius, radius + 1)])
        n = np.rint(down(sums["runs"]))
        some = np.maximum(n, 1)
        out = {k: down(sums[k]) / some for k in names}
        out["level_nonuniformity"] = sum(down(x) ** 2 for x in by_level) / some
        out["run_nonuniformity"] = sum(down(x) ** 2 for x in by_length) / some
        out["run_percentage"] = n / np.maximum(down(sums["pixels"]), 1)
        return {k: np.where(n > 0, out[k], np.nan) for k in names}

    return on_tiles(px, [value], radius, kernel, dict.fromkeys(names, "double"), WIDTH)
