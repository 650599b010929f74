"""Halo tiles and lines in segments against plain loops, with tiles small enough that windows cross them and pixels missing."""

import math
from collections import Counter

import numpy as np
import pytest

from arpent.operators import focal as fo
from arpent.operators import textures as tx
from arpent.operators import tiles

N = 23


@pytest.fixture(scope="module")
def raster():
    rng = np.random.default_rng(4)
    return {(r - 7, c - 5): (int(rng.integers(0, 4)), float(rng.integers(0, 50))) for r in range(N) for c in range(N) if rng.random() > 0.1}


@pytest.fixture(scope="module")
def px(spark, raster):
    return spark.createDataFrame([(r, c, k, v, f"p{r},{c}", None) for (r, c), (k, v) in raster.items()], "r long, c long, k int, v double, name string, _own int").drop("_own")


@pytest.fixture(autouse=True)
def narrow(monkeypatch):
    monkeypatch.setattr(tiles, "WIDTH", 5)
    monkeypatch.setattr(tx, "WIDTH", 5)
    monkeypatch.setattr(fo, "SEGMENT", 4)


def around(raster, r, c, cells):
    return [raster[r + i, c + j] for i, j in cells if (r + i, c + j) in raster]


def ball(n):
    return [(i, j) for i in range(-n, n + 1) for j in range(-n, n + 1) if i * i + j * j <= n * n]


@pytest.mark.parametrize("radius", [1, 3, 6])
def test_majority_and_morphology(px, raster, radius):
    got = {(r["r"], r["c"]): r for r in fo.opening(fo.erode(fo.majority_filter(px, "k", radius), "v", radius, "low"), "v", radius, "open").collect()}
    assert got.keys() == raster.keys() and all(x["name"] == f"p{r},{c}" for (r, c), x in got.items())
    low = {}
    for (r, c), (k, _) in raster.items():
        near = around(raster, r, c, ball(radius))
        count = Counter(x[0] for x in near)
        assert got[r, c]["majority"] == min(count, key=lambda x: (-count[x], x != k, x))
        low[r, c] = (0, min(x[1] for x in near))
        assert got[r, c]["low"] == low[r, c][1]
    for r, c in raster:
        assert got[r, c]["open"] == max(x[1] for x in around(low, r, c, ball(radius)))


def test_labels_may_be_text_or_null(spark):
    df = spark.createDataFrame([(0, 0, "b"), (0, 1, None), (1, 0, "a"), (1, 1, "b")], "r int, c int, k string")
    assert {(r["r"], r["c"]): r["majority"] for r in fo.majority_filter(df, "k", 1).collect()} == {(0, 0): "b", (0, 1): "b", (1, 0): "b", (1, 1): "b"}
    assert fo.majority_filter(df.limit(0), "k", 2).count() == 0


def test_mean_and_variance(px, raster):
    square = [(i, j) for i in range(-2, 3) for j in range(-2, 3)]
    for x in fo.local_mean_variance(px, "v", 2).collect():
        near = [v for _, v in around(raster, x["r"], x["c"], square)]
        assert math.isclose(x["mean"], np.mean(near), abs_tol=1e-9) and math.isclose(x["variance"], np.var(near), abs_tol=1e-9)


@pytest.mark.parametrize("directions, radius", [(4, None), (8, 5), (8, None), (3, 4)])
def test_sky_view(px, raster, directions, radius):
    reach = radius or 40
    got = {(x["r"], x["c"]): x["svf"] for x in fo.sky_view_factor(px, "v", radius, directions).collect()}
    for (r, c), (_, h) in raster.items():
        total = 0
        for k in range(directions):
            steep = 0.0
            for s in range(1, reach + 1):
                at = r + fo._step(2 * math.pi * k / directions, s)[0], c + fo._step(2 * math.pi * k / directions, s)[1]
                if at in raster:
                    steep = max(steep, (raster[at][1] - h) / s)
            total += math.cos(math.atan(steep)) ** 2
        assert math.isclose(got[r, c], total / directions, abs_tol=1e-9)


@pytest.mark.parametrize("azimuth, elevation", [(0, 40), (90, 70), (180, 55), (270, 80), (33, 60), (200, 75)])
def test_shadows(px, raster, azimuth, elevation):
    got = {(x["r"], x["c"]): x["shadow"] for x in fo.shadow_mask(px, "v", azimuth, elevation).collect()}
    dr, dc, slope = -math.cos(math.radians(azimuth)), math.sin(math.radians(azimuth)), math.tan(math.radians(elevation))
    for (r, c), (_, h) in raster.items():
        hit = any((at := (r + round(dr * s), c + round(dc * s))) in raster and raster[at][1] - h > s * slope for s in range(1, 40))
        assert got[r, c] == int(hit)


def test_textures(px, raster):
    moments = {(x["r"], x["c"]): x for x in tx.cooccurrence(px, "v", 3, 0, 50, 2, (1, -1), tx.SIMPLE + tx.ADVANCED).collect()}
    level = lambda v: min(2, int(v / 50 * 3))
    for r, c in raster:
        pairs = [(level(raster[a][1]), level(raster[b][1])) for i in range(-2, 3) for j in range(-2, 3) if (a := (r + i, c + j)) in raster and (b := (r + i + 1, c + j - 1)) in raster]
        x = moments[r, c]
        if not pairs:
            assert x["energy"] is None
            continue
        p = {k: n / len(pairs) for k, n in Counter(pairs).items()}
        mean = sum(i * q for (i, _), q in p.items())
        assert math.isclose(x["energy"], sum(q * q for q in p.values()), abs_tol=1e-9)
        assert math.isclose(x["cluster_shade"], sum((i + j - 2 * mean) ** 3 * q for (i, j), q in p.items()), abs_tol=1e-9)
        assert math.isclose(x["dissimilarity"], sum(abs(i - j) * q for (i, j), q in p.items()), abs_tol=1e-9)
        sums = Counter()
        for (i, j), q in p.items():
            sums[i + j] += q
        assert math.isclose(x["sum_entropy"], -sum(q * math.log(q) for q in sums.values()), abs_tol=1e-9)
    runs = {(x["r"], x["c"]): x for x in tx.run_lengths(px, "v", 3, 0, 50, 2).collect()}
    for r, c in raster:
        found = []
        for i in range(-2, 3):
            row = [level(raster[r + i, c + j][1]) if (r + i, c + j) in raster else None for j in range(-2, 3)]
            at = 0
            while at < 5:
                n = 1
                while at + n < 5 and row[at + n] == row[at]:
                    n += 1
                if row[at] is not None:
                    found.append((row[at] + 1, n))
                at += n
        x = runs[r, c]
        assert math.isclose(x["long_low"], np.mean([(n / k) ** 2 for k, n in found]), abs_tol=1e-9)
        assert math.isclose(x["run_nonuniformity"], sum(n * n for n in Counter(n for _, n in found).values()) / len(found), abs_tol=1e-9)
        assert math.isclose(x["run_percentage"], len(found) / sum(n for _, n in found), abs_tol=1e-9)
