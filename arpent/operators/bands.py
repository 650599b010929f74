"""Bands of a raster together: resampling to another lattice, pansharpening, components of all bands, clusters of all classes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arpent.operators.joins import sample_bilinear
from arpent.operators.lineage import stored
from arpent.operators.tiles import Tile, mean_and_variance, on_tiles, square


def lattice(px: DataFrame, ratio: float) -> DataFrame:
    """(i, j, x, y): centres of the pixels of a lattice over the raster (r, c of unit pixels), `ratio` of them along one pixel.

    Each source pixel gives the centres that lie in it, so ratios need not be whole, above or below one.
    """
    span = lambda c: F.sequence(F.ceil(F.col(c) * ratio - 0.5), F.ceil((F.col(c) + 1) * ratio - 0.5) - 1)
    some = lambda c: F.when(F.ceil((F.col(c) + 1) * ratio - 0.5) > F.ceil(F.col(c) * ratio - 0.5), span(c)).otherwise(F.array().cast("array<bigint>"))
    own = px.select("r", F.explode(some("c")).alias("j"))
    return own.select(F.explode(some("r")).alias("i"), "j").select("i", "j", ((F.col("j") + 0.5) / ratio).alias("x"), ((F.col("i") + 0.5) / ratio).alias("y"))


def superimpose_bilinear(px: DataFrame, band: str, ratio: float) -> DataFrame:
    """(i, j, value): the band on a lattice of `ratio` pixels to one, bilinear between the four centres around; the nearest
    pixel's value where one of them is missing. Rows grow downwards, so y is measured along them."""
    points = lattice(px, ratio).withColumn("fid", F.struct("i", "j"))
    near = sample_bilinear(points.select("fid", "x", (-F.col("y")).alias("y")), px.select("r", "c", band), band, 0.0, 0.0)
    return near.select("fid.i", "fid.j", "value")


def local_moment_sharpen(px: DataFrame, pan: str, xs: list[str], radius: int) -> DataFrame:
    """px with sharp_<band>: the panchromatic band with the mean and deviation that the band has in the window around.

    Where the panchromatic band does not vary there, the band's local mean.
    """

    def kernel(tile: Tile):
        p = tile.grid(pan)
        _, mean, variance = mean_and_variance(p, square(radius))
        own = p[radius:-radius, radius:-radius] if radius else p
        out = {}
        for b in xs:
            _, m, v = mean_and_variance(tile.grid(b), square(radius))
            out[f"sharp_{b}"] = np.where(variance > 1e-9, (own - mean) * np.sqrt(v / np.where(variance > 1e-9, variance, 1)) + m, m)
        return out

    return on_tiles(px, [pan, *xs], radius, kernel, {f"sharp_{b}": "double" for b in xs})


def moments(df: DataFrame, columns: list[str | Column]) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, means, covariance) of columns over rows where none is null, by one aggregation."""
    named = df.select(*[(F.col(c) if isinstance(c, str) else c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)]).dropna()
    k = len(columns)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = named.agg(F.count("*"), *[F.avg(f"_{i}") for i in range(k)], *[F.covar_pop(f"_{i}", f"_{j}") for i, j in pairs]).first()
    cov = np.zeros((k, k))
    for (i, j), v in zip(pairs, row[1 + k :], strict=True):
        cov[i, j] = cov[j, i] = v or 0.0
    return row[0], np.array([v or 0.0 for v in row[1 : 1 + k]]), cov


def bayes_sharpen(px: DataFrame, pan: str, xs: list[str], weight: float = 0.9999, trust: float = 1.0) -> DataFrame:
    """px with sharp_<band>: bands between what was seen and what a linear sensor model says of the panchromatic band.

    The model pan = a . xs + b is fitted by least squares over the raster, with a residual variance v. With the bands'
    covariance C, each pixel takes the least of weight * (z - xs)' C^-1 (z - xs) + (1 - weight) * trust * (pan - b - a . z)^2 / v.
    """
    _, mean, cov = moments(px, [*xs, pan])
    c, side = cov[:-1, :-1], cov[:-1, -1]
    a = np.linalg.pinv(c) @ side
    b, v = float(mean[-1] - a @ mean[:-1]), max(float(cov[-1, -1] - a @ side), 1e-12)
    ca = c @ a
    t = (1 - weight) * trust / v
    gain = ca * t / (weight + t * float(a @ ca))
    rest = F.col(pan) - b - sum((float(k) * F.col(x) for k, x in zip(a, xs, strict=True)), F.lit(0.0))
    return px.withColumns({f"sharp_{x}": F.col(x) + float(g) * rest for x, g in zip(xs, gain, strict=True)})


def _projected(px: DataFrame, bands: list[str], mean: np.ndarray, weights: np.ndarray, name: str = "component") -> DataFrame:
    """px with component_0, ...: the rows of weights on the centred bands."""
    return px.withColumns({f"{name}_{k}": sum(((F.col(b) - float(m)) * float(w) for b, m, w in zip(bands, mean, row, strict=True)), F.lit(0.0)) for k, row in enumerate(weights)})


def _signed(w: np.ndarray) -> np.ndarray:
    """Rows with their largest entry above 0."""
    return w * np.sign(w[np.arange(len(w)), np.abs(w).argmax(axis=1)])[:, None]


def generalised(noise: np.ndarray, cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ratios ascending, rows w of unit variance) with noise w = ratio * cov w."""
    value, vector = np.linalg.eigh(cov)
    keep = value > 1e-12 * max(value.max(), 1e-300)
    white = vector[:, keep] / np.sqrt(value[keep])
    ratio, turn = np.linalg.eigh(white.T @ noise @ white)
    return ratio, _signed((white @ turn).T)


def autocorrelation_factors(px: DataFrame, bands: list[str], k: int | None = None) -> tuple[DataFrame, list[float]]:
    """(px with components, ratios): components of unit variance, the ones that vary least between neighbours first.

    ratios: variance of the differences between neighbours in a row or a column over the variance, of each component.
    """
    steps = F.inline(F.array(*[F.struct(F.lit(i).alias("_i"), F.lit(j).alias("_j")) for i, j in ((0, 1), (1, 0))]))
    moved = px.select("r", "c", *[F.col(b).alias(f"_{b}") for b in bands], steps).select((F.col("r") - F.col("_i")).alias("r"), (F.col("c") - F.col("_j")).alias("c"), *[f"_{b}" for b in bands])
    pairs = moved.join(px.select("r", "c", *bands), ["r", "c"])
    _, _, noise = moments(pairs, [F.col(b) - F.col(f"_{b}") for b in bands])
    _, mean, cov = moments(px, bands)
    ratio, weights = generalised(noise, cov)
    return _projected(px, bands, mean, weights[:k]), ratio[:k].tolist()


def noise_adjusted_components(px: DataFrame, bands: list[str], radius: int, k: int | None = None) -> tuple[DataFrame, list[float]]:
    """(px with components, ratios): components of unit variance, those of the least share of noise first, where noise is
    what a pixel differs by from the mean of the window around."""

    def kernel(tile: Tile):
        out = {}
        for b in bands:
            a = tile.grid(b)
            out[f"_n_{b}"] = (a[radius:-radius, radius:-radius] if radius else a) - mean_and_variance(a, square(radius))[1]
        return out

    _, _, noise = moments(on_tiles(px.select("r", "c", *bands), bands, radius, kernel, {f"_n_{b}": "double" for b in bands}), [f"_n_{b}" for b in bands])
    _, mean, cov = moments(px, bands)
    ratio, weights = generalised(noise, cov)
    return _projected(px, bands, mean, weights[:k]), ratio[:k].tolist()


def independent_components(px: DataFrame, bands: list[str], k: int | None = None, rounds: int = 20, seed: int = 1) -> DataFrame:
    """px with components as independent as a fixed-point search makes them (contrast tanh, all at once).

    Bands are whitened; each round is one aggregation over all pixels, then the k x k weights are made orthogonal.
    """
    _, mean, cov = moments(px, bands)
    value, vector = np.linalg.eigh(cov)
    order = np.argsort(-value)[:k]
    order = order[value[order] > 1e-12 * max(value.max(), 1e-300)]
    white = (vector[:, order] / np.sqrt(value[order])).T
    z = stored(_projected(px.select(*bands).dropna(), bands, mean, white, "z").select(*[f"z_{i}" for i in range(len(order))]))
    n = len(order)
    w = np.linalg.qr(np.random.default_rng(seed).standard_normal((n, n)))[0]
    for _ in range(rounds):
        g = [F.tanh(sum((float(v) * F.col(f"z_{j}") for j, v in enumerate(row)), F.lit(0.0))) for row in w]
        got = z.agg(*[F.avg(g[i] * F.col(f"z_{j}")) for i in range(n) for j in range(n)], *[F.avg(1 - g[i] * g[i]) for i in range(n)]).first()
        new = np.array(got[: n * n]).reshape(n, n) - np.array(got[n * n :])[:, None] * w
        u, _, vt = np.linalg.svd(new)
        done = np.abs(np.abs((u @ vt * w).sum(axis=1)) - 1).max() < 1e-7
        w = u @ vt
        if done:
            break
    return _projected(px, bands, mean, _signed(w @ white))


def kmeans_by_class(px: DataFrame, cls: str, bands: list[str], k: int, rounds: int = 10, key: str = "pid") -> DataFrame:
    """px with `cluster` from 0: k-means within every class at once, by one aggregation a round over (class, cluster).

    Centres start at the k pixels of least key of a class; a class of fewer has as many clusters. Ties go to the lower
    cluster. It ends after the rounds, or when no centre moves. Centres are k rows a class and joined by class.
    """
    point = F.array(*[F.col(b).cast("double") for b in bands])
    rank = F.row_number().over(Window.partitionBy(cls).orderBy(key))
    starts = px.select(cls, key, point.alias("v")).withColumn("_n", rank).where(F.col("_n") <= k)
    centres = stored(starts.select(cls, (F.col("_n") - 1).cast("int").alias("cluster"), "v"))

    def assigned(centres: DataFrame) -> DataFrame:
        lists = centres.groupBy(F.col(cls).alias("_cls")).agg(F.array_sort(F.collect_list(F.struct("cluster", "v"))).alias("_c"))  # k at most
        apart = lambda c: F.aggregate(F.zip_with(c["v"], point, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
        best = F.array_min(F.transform("_c", lambda c: F.struct(apart(c).alias("d"), c["cluster"].alias("k"))))["k"]
        return px.join(lists, F.col(cls).eqNullSafe(F.col("_cls"))).withColumn("cluster", best).select(*px.columns, "cluster")

    for _ in range(rounds):
        new = stored(assigned(centres).groupBy(cls, "cluster").agg(F.array(*[F.avg(b) for b in bands]).alias("v")))
        if new.exceptAll(centres).isEmpty():
            break
        centres = new
    return assigned(centres)
